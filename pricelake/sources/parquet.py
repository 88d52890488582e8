"""The processed price table: Parquet partitioned by year, state and the write that brought the rows.

Every write has a name, its ``ingest_batch``, and puts its rows under a partition of that name (below year and
state). It goes through Spark's dynamic partition overwrite: executors write into a staging folder of
the job and Spark's committer publishes the partitions, so a write that is repeated under its name replaces itself and
writes under different names never touch each other's files.

Beside the data a small append-only log holds the latest arrival date of each write. A write enters itself
as pending first and with its date afterwards: whoever finds a pending entry (the write died in between, or is
running) looks that batch's date up in the data.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schema import BATCH_COLUMN, CLEAN_COLUMNS, CLEAN_SCHEMA, PARTITION_COLUMNS
from pricelake.session import path_exists

# Order of rows inside each written partition (after the partition columns).
SORT_COLUMNS = ("arrival_date", "commodity")
BASE_BATCH = "base"  # the write that replaces the whole table
WHOLE_TABLE = "*"  # log entry of a table that was found without a log
TABLE_SCHEMA = T.StructType(CLEAN_SCHEMA.fields + [T.StructField(BATCH_COLUMN, T.StringType(), True)])
_LOG_SCHEMA = "batch string, at long, pending boolean, latest date"


def write_processed(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    dynamic_overwrite: bool = False,
    max_records_per_file: int | None = None,
    batch: str | None = None,
    cluster_by: tuple[str, ...] = SORT_COLUMNS,
    bloom: tuple[str, ...] = (),
    bloom_values: int = 1 << 16,
    page_rows: int | None = None,
) -> None:
    """Parquet, Hive-style ``year=/state=/ingest_batch=`` directories, snappy.

    A ``rebalance`` hint on the partition columns groups rows of one
    (year, state) into few tasks -- few files per directory -- while AQE splits
    a partition that a large state would otherwise skew into one huge task.
    Within a task rows are sorted by the partition columns (which the writer
    needs anyway) and then by date and commodity, so every row group carries
    tight min/max statistics and date or commodity predicates skip row groups.

    ``mode="overwrite"`` replaces the whole table, ``"append"`` adds a batch under a new name.
    With ``batch`` (append) or ``dynamic_overwrite`` the partitions of that batch (default ``base``) which ``df`` holds are
    replaced and everything else stays.

    ``cluster_by`` orders rows by other columns, for tables that are looked up by those. ``bloom`` names columns that get
    a Parquet bloom filter per row group (sized for ``bloom_values`` distinct ones), which skips row groups on an
    equality where ranges overlap. ``page_rows`` bounds a Parquet page, the least that a look-up reads of a column.

    The latest arrival date is observed by the write itself and kept beside
    the data (:func:`read_anchor`).
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    spark, seen = df.sparkSession, Observation(f"anchor-{uuid.uuid4().hex}")
    whole = mode == "overwrite" and not dynamic_overwrite
    fresh = mode == "append" and batch is None
    batch = batch or (uuid.uuid4().hex if fresh else BASE_BATCH)
    laid_out = (
        df.select(*CLEAN_COLUMNS)
        .hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, *cluster_by)
        .withColumn(BATCH_COLUMN, F.lit(batch))
        .observe(seen, F.max("arrival_date").alias("latest"))  # on top: below, AQE drops it when no row comes up
    )
    if not whole:
        read_anchor(spark, path)  # a table without a log gets one before it changes
        _log(spark, path, batch, pending=True)
    w = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    for column in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(bloom_values))
    if page_rows:
        w = w.option("parquet.page.row.count.limit", str(page_rows))
    w.partitionBy(*PARTITION_COLUMNS, BATCH_COLUMN).option("compression", "snappy").parquet(path)
    if whole or fresh:
        _log(spark, path, batch, latest=seen.get["latest"])
    else:
        read_anchor(spark, path)  # partitions of the batch that stayed may hold a later date: look them up once


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}/_anchor"  # readers of the table skip names that begin with "_"


def _log(spark: SparkSession, path: str, batch: str, pending: bool = False, latest: dt.date | None = None) -> None:
    row = spark.createDataFrame([(batch, time.time_ns(), pending, latest)], _LOG_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(_log_path(path))


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """``batch, at``: every finished write of the table and when it was last made (a number that grows).

    ``WHOLE_TABLE`` stands for what was there before the table had a log.
    """
    read_anchor(spark, path)  # finishes what others left open
    entries = spark.read.schema(_LOG_SCHEMA).parquet(_log_path(path))
    last = entries.groupBy("batch").agg(F.max("at").alias("at"), F.max_by("pending", "at").alias("pending"))
    return last.where("not pending").select("batch", "at")


def read_anchor(spark: SparkSession, path: str) -> dt.date | None:
    """Latest arrival date of the processed table at ``path``; ``None`` when it has no rows or does not exist.

    Normally one small read. Entries of writes that did not finish, and a table without a log, are looked up in the
    data (only the batches concerned) and entered.
    """
    if not path_exists(spark, path):
        return None
    log = None
    if path_exists(spark, _log_path(path)):
        entries = spark.read.schema(_LOG_SCHEMA).parquet(_log_path(path))
        log = entries.groupBy("batch").agg(F.max_by(F.struct("pending", "latest"), "at").alias("e"), F.max("at").alias("at"))
        # One row per write that is or was under way.
        state = log.agg(F.max("e.latest").alias("latest"), F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("e.pending"), F.col("batch"))).alias("open")).first()
    if log is None or not state["n"]:
        latest = read_table(spark, path).agg(F.max("arrival_date")).first()[0]
        _log(spark, path, WHOLE_TABLE, latest=latest)
        return latest
    found = [state["latest"]]
    for batch in state["open"]:
        found.append(read_table(spark, path).where(F.col(BATCH_COLUMN) == batch).agg(F.max("arrival_date")).first()[0])
        _log(spark, path, batch, latest=found[-1])
    return max(filter(None, found), default=None)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table with ``ingest_batch``, the name of the write that brought each row."""
    return spark.read.schema(TABLE_SCHEMA).parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Read back with the declared schema and the clean column order.

    Giving the schema fixes partition column types (a state named like a
    number stays a string) and avoids schema inference over all footers.
    A blank or null state comes back as null.
    """
    return read_table(spark, path).select(*CLEAN_COLUMNS)


def register_view(df: DataFrame, name: str = "price_records") -> None:
    """Session view for SQL users."""
    df.createOrReplaceTempView(name)


def sample_records(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """M2: Bernoulli sample for smoke runs (write its output to its own path)."""
    return df.sample(fraction=fraction, seed=seed)

