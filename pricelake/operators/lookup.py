"""Point look-ups in the processed table: one commodity's rows, with as little of the table read as its layout allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import normalise


def commodity_lookup(df: DataFrame, commodity: str, market: str | None = None) -> DataFrame:
    """Rows of one commodity, and of one market where given; names are normalised like the data.

    The names are constants, so they reach the Parquet reader as equality predicates. A table written with
    ``cluster_by=("commodity", ...)`` lets it skip pages and row groups by their range, one written with ``bloom`` skips
    row groups that cannot hold the name although their range does.
    """
    rows = df.where(F.col("commodity") == normalise(F.lit(commodity)))
    return rows if market is None else rows.where(F.col("market") == normalise(F.lit(market)))
