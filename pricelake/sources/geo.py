"""Region names from a GeoJSON feature collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.constants import REGION_NAME_KEYS


def read_features(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per feature with its ``properties`` as a string map.

    ``multiline=True`` reads classic FeatureCollection files (one document per
    file; a region-shape file is a small dimension). ``multiline=False`` reads
    newline-delimited features (GeoJSON text sequences), which split across
    tasks for large shape sets. Geometry is not parsed.
    """
    props = T.MapType(T.StringType(), T.StringType())
    if multiline:
        schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("properties", props)])))])
        doc = spark.read.schema(schema).option("multiLine", "true").json(path)
        return doc.select(F.explode("features").alias("f")).select(F.col("f.properties").alias("properties"))
    schema = T.StructType([T.StructField("properties", props)])
    return spark.read.schema(schema).json(path).select("properties")


def name_keys(features: DataFrame, candidates: tuple[str, ...] = REGION_NAME_KEYS) -> list[str]:
    """Properties that name regions, best first, decided over all features.

    Only the known name properties and those that mention ``name`` (but not
    ``name_0``, the country) or ``state`` qualify. The property that more
    features fill comes first; ties go to the known ones in their order, then
    by name. Property names are few; their counts are combined before the shuffle.
    """
    filled = features.select(F.explode("properties").alias("key", "value")).filter(F.trim("value") != "")
    low = F.lower("key")
    named = F.col("key").isin(*candidates) | (low.contains("name") & (low != "name_0")) | low.contains("state")
    counts = filled.filter(named).groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()
    rank = {c: i for i, c in enumerate(candidates)}
    return [r["key"] for r in sorted(counts, key=lambda r: (-r["n"], rank.get(r["key"], len(rank)), r["key"]))]


def feature_names(features: DataFrame, keys: list[str]) -> DataFrame:
    """One row per feature: its first non-blank property of ``keys``, trimmed; null when it has none."""
    values = [F.nullif(F.trim(F.col("properties")[k]), F.lit("")) for k in keys]
    return features.select((F.coalesce(*values) if values else F.lit(None).cast("string")).alias("name"))


def region_names(spark: SparkSession, path: str, multiline: bool = True, key: str | None = None) -> DataFrame:
    """Distinct trimmed region names (column ``name``).

    A feature that lacks the usual property is named by the next best one.
    Features with no name at all are left out here and counted by
    :func:`unnamed_features`.
    """
    features = read_features(spark, path, multiline)
    keys = [key] if key else name_keys(features)
    return feature_names(features, keys).filter(F.col("name").isNotNull()).distinct()


def unnamed_features(spark: SparkSession, path: str, multiline: bool = True, key: str | None = None) -> DataFrame:
    """One row: features read, and those without any name."""
    features = read_features(spark, path, multiline)
    named = feature_names(features, [key] if key else name_keys(features))
    return named.agg(F.count(F.lit(1)).alias("features"), F.count_if(F.col("name").isNull()).alias("unnamed"))
