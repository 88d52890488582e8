"""Date parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_arrival_date(c: Column | str, fmt: str = "dd/MM/yyyy") -> Column:
    """Strict parse; anything that does not match the pattern becomes null.

    ``try_to_date`` keeps ANSI mode on for the rest of the query while turning
    bad strings (``1/2/2020``, ``2020-02-01``, ``31/02/2020``) into nulls.
    """
    return F.try_to_date(c if isinstance(c, Column) else F.col(c), fmt)
