"""Display labels for report frames, built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.constants import MONEY_SYMBOL, MONEY_UNITS


def fixed1(c: Column | str) -> Column:
    """One decimal place as text, half-up on the decimal value (0.25 -> 0.3)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("decimal(38,10)").cast("decimal(38,1)").cast("string")


def money_label(c: Column | str) -> Column:
    """``₹1.2B`` / ``₹3.4M`` for large amounts, else ``₹12,345``."""
    col = F.col(c) if isinstance(c, str) else c
    expr = F.concat(F.lit(MONEY_SYMBOL), F.format_number(col, 0))
    for threshold, suffix in reversed(MONEY_UNITS):
        expr = F.when(col >= F.lit(threshold), F.concat(F.lit(MONEY_SYMBOL), fixed1(col / F.lit(threshold)), F.lit(suffix))).otherwise(expr)
    return expr


def pct_label(c: Column | str) -> Column:
    """``12.3%``."""
    return F.concat(fixed1(c), F.lit("%"))
