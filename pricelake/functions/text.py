"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise(c: Column | str) -> Column:
    """Trim, then title-case word by word (words split on spaces only).

    ``initcap`` lower-cases the rest of each word, so ``Tur (Arhar)`` becomes
    ``Tur (arhar)``; dimension keys joined against cleaned data must go through
    this same function.
    """
    return F.initcap(F.trim(c))


def is_blank(c: Column | str) -> Column:
    """True when the value is null or only whitespace."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | (F.trim(col) == F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(c if isinstance(c, Column) else F.col(c), F.lit(""))
