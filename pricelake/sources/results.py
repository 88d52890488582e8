"""Result tables: one CSV directory per query, and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelake.session import path_exists


def write_result_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header row, overwrite. ``single_file`` is for results whose rows are
    bounded by a k or by the number of states or months: one task writes them
    as one file, and they never pass through the driver. A result that grows
    with the data keeps its partitions (the default)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def read_result_csv(spark: SparkSession, path: str, fallback: str | None = None, schema: str | None = None) -> DataFrame | None:
    """Read a result back, with ``schema`` or inferred types; ``None`` when neither path exists."""
    for p in (path, fallback):
        if p and path_exists(spark, p):
            reader = spark.read.option("header", "true")
            return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(p)
    return None
