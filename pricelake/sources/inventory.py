"""Landing inventory: files, bytes and content per partition directory, compared across two roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.schema import RAW_FIELDS


def _partition(path: Column) -> Column:
    """The ``key=value`` directory that holds a file."""
    return F.regexp_extract(path, r"/([^/=]+=[^/]*)/[^/]+$", 1)


def landing_inventory(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(partition, files, bytes) for every matching file below ``root``.

    ``binaryFile`` only lists when ``content`` is not selected; file contents
    are never read. ``partition`` is the ``key=value`` directory holding the file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return files.groupBy(_partition(F.col("path")).alias("partition")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def compare_inventories(before: DataFrame, after: DataFrame) -> DataFrame:
    """Full outer join of two inventories with a ``matches`` flag per partition."""
    b = before.select("partition", F.col("files").alias("files_before"), F.col("bytes").alias("bytes_before"))
    a = after.select("partition", F.col("files").alias("files_after"), F.col("bytes").alias("bytes_after"))
    j = b.join(a, "partition", "full_outer")
    return j.withColumn(
        "matches",
        F.coalesce((F.col("files_before") == F.col("files_after")) & (F.col("bytes_before") == F.col("bytes_after")), F.lit(False)),
    )


def content_inventory(spark: SparkSession, root: str, glob: str = "*.csv", header: str | None = ",".join(RAW_FIELDS)) -> DataFrame:
    """(partition, files, bytes, lines, content) for every matching file below ``root``.

    ``content`` is a hash of the multiset of lines, whatever their order and however they are dealt to files: two
    sums of independent 64-bit line hashes. Sums are combined before the shuffle, a row per file and task, and paths are
    taken apart after it. Lines equal to ``header`` do not count.
    """
    lines = spark.read.text(root, recursiveFileLookup=True, pathGlobFilter=glob).select("value", F.col("_metadata.file_path").alias("path"))
    if header is not None:
        lines = lines.where(F.col("value") != header)
    wide = "decimal(38,0)"
    sums = {name: F.sum(F.xxhash64("value", *seed).cast(wide)) for name, seed in (("one", ()), ("two", (F.lit("second"),)))}
    files = lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines"), *(s.alias(name) for name, s in sums.items()))
    found = files.groupBy(F.url_decode(_partition(F.col("path"))).alias("partition")).agg(
        F.sum("lines").alias("lines"), F.sha2(F.concat_ws(":", *(F.sum(name).cast("string") for name in sums)), 256).alias("content")
    )
    listed = landing_inventory(spark, root, glob)
    return listed.join(found, "partition", "left").select("partition", "files", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), "content")


def compare_contents(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two content inventories side by side with a ``status`` per partition.

    ``equal``, ``missing`` (only before), ``extra`` (only after), ``grown`` or ``shrunk`` (more or fewer lines), ``changed``
    (as many lines, others). ``matches`` is whether the partition is equal.
    """
    side = lambda df, name: df.select("partition", *(F.col(c).alias(f"{c}_{name}") for c in ("files", "bytes", "lines", "content")))
    both = side(before, "before").join(side(after, "after"), "partition", "full_outer")
    status = (
        F.when(F.col("files_after").isNull(), "missing")
        .when(F.col("files_before").isNull(), "extra")
        .when(F.col("lines_after") > F.col("lines_before"), "grown")
        .when(F.col("lines_after") < F.col("lines_before"), "shrunk")
        .when(F.col("content_before").eqNullSafe(F.col("content_after")), "equal")
        .otherwise("changed")
    )
    return both.withColumn("status", status).withColumn("matches", F.col("status") == "equal")


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """One row: partitions, files and bytes."""
    return inventory.agg(
        F.count(F.lit(1)).alias("partitions"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )
