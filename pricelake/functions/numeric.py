"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column | str, places: int = 2) -> Column:
    """Round a double half-up on its decimal value and return a double.

    The value goes through ``decimal(38,10)`` first so that every engine rounds
    the same number (rounding the raw binary double can land 1.005 on 1.0).
    A value that no decimal(38,10) holds fails the query (ANSI cast) rather than leave a hole in a result.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("decimal(38,10)"), places).cast("double")

