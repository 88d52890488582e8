"""Reconciling state names in results with the names used by region shapes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.constants import LEGACY_PRICE_INDEX_COLUMN, REGION_RENAME
from pricelake.functions import normalise


def region_map_frame(spark: SparkSession, pairs: Iterable[tuple[str, str]] = REGION_RENAME) -> DataFrame:
    """(state, name) rename pairs; the state side goes through the cleaning normaliser.

    Cleaning title-cases states (``Jammu and Kashmir`` -> ``Jammu And Kashmir``),
    so the map key is normalised the same way or it would never match.
    """
    raw = spark.createDataFrame(list(pairs), "state string, name string")
    return raw.select(normalise("state").alias("state"), F.col("name"))


def with_price_index(df: DataFrame) -> DataFrame:
    """Accept the legacy ``total_price_sum`` column in place of ``price_index_sum``."""
    if "price_index_sum" not in df.columns and LEGACY_PRICE_INDEX_COLUMN in df.columns:
        return df.withColumnRenamed(LEGACY_PRICE_INDEX_COLUMN, "price_index_sum")
    return df


def region_rename(summary: DataFrame, region_map: DataFrame, regions: DataFrame) -> DataFrame:
    """Replace a state by its mapped name when the state itself is not a region name.

    The rename applies even when the mapped name is not a region either; such
    rows then show up in :func:`unmatched_regions`. Catalyst decides how to move
    both sides; a map it knows to be small is broadcast without a hint.
    """
    known = regions.select(F.col("name").alias("state")).distinct().withColumn("_is_region", F.lit(True))
    m = region_map.select("state", F.col("name").alias("_mapped"))
    out = summary.join(m, "state", "left").join(known, "state", "left")
    renamed = F.when(F.col("_is_region").isNull() & F.col("_mapped").isNotNull(), F.col("_mapped")).otherwise(F.col("state"))
    return out.select(*[renamed.alias("state") if c == "state" else F.col(c) for c in summary.columns])


def unmatched_regions(renamed: DataFrame, regions: DataFrame) -> DataFrame:
    """State values (after renaming) that match no region name."""
    return renamed.select("state").join(regions.select(F.col("name").alias("state")), "state", "left_anti")


def region_summary(renamed: DataFrame, regions: DataFrame) -> DataFrame:
    """Every region with the summary of its matching state (nulls when no data)."""
    r = regions.select(F.col("name").alias("region")).distinct()
    s = with_price_index(renamed).select(
        F.col("state").alias("region"), "record_count", "avg_modal_price", "price_index_sum"
    )
    return r.join(s, "region", "left")
