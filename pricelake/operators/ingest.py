"""Resumable partition landing: which partitions still need to be pulled."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.constants import STATES
from pricelake.schema import MANIFEST_SCHEMA
from pricelake.session import path_exists


def partition_frame(spark: SparkSession, names: Iterable[str] = STATES, only: str | None = None) -> DataFrame:
    """The partition list (one column ``state``): all names, or just ``only``."""
    rows = [(only,)] if only else [(n,) for n in names]
    return spark.createDataFrame(rows, "state string")


def manifest_entries(landed: DataFrame, key: str = "state") -> DataFrame:
    """Manifest rows (state, rows, completed_at) from landed records: one row per partition."""
    return landed.groupBy(F.col(key).alias("state")).agg(
        F.count(F.lit(1)).alias("rows"), F.current_timestamp().alias("completed_at")
    )


def record_manifest(entries: DataFrame, path: str) -> None:
    """Append completed partitions to the manifest table (one small file per run)."""
    entries.select("state", "rows", "completed_at").coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest table, or an empty one before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def pending_partitions(partitions: DataFrame, manifest: DataFrame, require_rows: bool = True) -> DataFrame:
    """Partitions without a completed manifest entry.

    With ``require_rows`` a partition recorded with zero rows stays pending
    (an empty pull is more often a failure than an empty state). Extra columns
    of ``partitions`` are kept.
    """
    done = manifest.filter(F.col("rows") > 0) if require_rows else manifest
    return partitions.join(done.select("state").distinct(), "state", "left_anti")
