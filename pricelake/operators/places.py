"""Numbering the rows of a table in a global order without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.session import written


def placed(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``place``, their number from 0 in the order of ``by`` over all partitions (written).

    Rows are sorted by range; each is numbered in its partition and the counts of the partitions before are added.
    Ties are numbered in any order among themselves, and may go to several tasks.
    """
    spark = rows.sparkSession
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    dealt = salted.repartitionByRange(*by, "_salt").sortWithinPartitions(*by, "_salt").drop("_salt")
    part = F.spark_partition_id()
    numbered = dealt.select("*", part.alias("_part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("_at"))
    numbered = written(spark, numbered, name)
    # One row a partition: the window is as long as there were tasks.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = numbered.join(F.broadcast(starts), "_part")  # as many rows as tasks
    return joined.withColumn("place", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
