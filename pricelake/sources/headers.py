"""Raw CSV files whose headers name the columns in any order: bound by name, file by file.

The first line of every file is its header. A header is good when it names each raw field exactly once (case, blanks
around a name and a byte-order mark do not count; further columns are allowed and dropped). Lines are parsed by Spark's
CSV parser and bound to the fields by their own file's header. All lines of a file with another
header, and lines that do not fit theirs, are kept apart as text instead of failing the run.

The header that most files have is a constant of the plan. Only files with another one are looked up, in a table of
their paths, so the usual landing is one scan without a shuffle beside the pass over the files' first splits that finds the headers.

Records must not hold line feeds. An empty file has no header and no lines. A line that repeats its file's header is a header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.schema import RAW_FIELDS, RAW_SCHEMA
from pricelake.session import written

UNKNOWN_HEADER, MALFORMED_LINE = "unknown_header", "malformed_line"
_CORRUPT = "_broken"


def read_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """``value, path, block``: every line below ``path`` with its file and the offset of the split it was read in."""
    lines = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter=glob)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _names(header: Column) -> Column:
    tokens = F.split(F.regexp_replace(header, "^﻿", ""), ",", -1)
    return F.transform(tokens, lambda t: F.lower(F.trim(F.regexp_replace(t, '^\\s*"|"\\s*$', ""))))


def file_headers(lines: DataFrame) -> DataFrame:
    """``path, header, width, places`` per file; ``places`` has the column of each raw field, null for a header that is not good."""
    first = lines.where("block = 0").withColumn("_n", F.monotonically_increasing_id())
    # Combined before the shuffle: a row per file and task.
    headers = first.groupBy("path").agg(F.min_by("value", "_n").alias("header"))
    names = headers.withColumn("_names", _names(F.col("header")))
    # As many known names as fields, each of them once.
    known = F.filter("_names", lambda n: n.isin(*RAW_FIELDS))
    good = (F.size(known) == len(RAW_FIELDS)) & (F.size(F.array_distinct(known)) == len(RAW_FIELDS))
    places = F.array(*(F.array_position("_names", f).cast("int") - 1 for f in RAW_FIELDS))
    return names.select("path", "header", F.size("_names").alias("width"), F.when(good, places).alias("places"))


def bind_by_name(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Every data line of every file once: the raw fields, ``path``, and for lines that are not bound ``line`` and ``reason``."""
    lines = read_lines(spark, path, glob)
    headers = written(spark, file_headers(lines), "headers")  # one row per file
    usual = headers.where("places is not null").groupBy("header", "width", "places").count().orderBy(F.desc("count"), "header").first()
    if usual is None:
        header, width, places, most = None, 0, None, 0
    else:
        header, width, places = usual["header"], usual["width"], usual["places"]
        most = headers.where("places is not null").agg(F.max("width")).first()[0]
    same = F.col("header").eqNullSafe(F.lit(header))
    others = headers.where(~same | F.col("places").isNull()).select("path", F.col("header").alias("_header"), F.col("width").alias("_width"), F.col("places").alias("_places"))
    rows = lines.join(others, "path", "left")
    listed = F.col("_header").isNotNull()
    own_places = F.when(listed, F.col("_places")).otherwise(F.lit(places).cast("array<int>"))
    own_width = F.when(listed, F.col("_width")).otherwise(F.lit(width))
    rows = rows.where(~F.when(listed, F.col("value") == F.col("_header")).otherwise(F.col("value").eqNullSafe(F.lit(header))))
    rows = rows.where(F.col("value") != "")  # the CSV reader skips empty lines too
    rows = rows.select("value", "path", own_places.alias("_at"), own_width.alias("_wide"))
    # All files are parsed with as many columns as the widest good header has; narrower lines are filled up on the right.
    schema = ", ".join([*(f"c{i} string" for i in range(most)), f"{_CORRUPT} string"])
    filled = F.concat("value", F.repeat(F.lit(","), F.lit(most) - F.col("_wide")))
    parsed = F.from_csv(F.when(F.col("_at").isNotNull(), filled), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = rows.withColumn("_p", parsed).withColumn("_c", F.array(*(F.col(f"_p.c{i}") for i in range(most))).cast("array<string>"))
    texts = {f: F.get("_c", F.get("_at", i)) for i, f in enumerate(RAW_FIELDS)}
    typed = {f: t if RAW_SCHEMA[f].dataType.simpleString() == "string" else t.try_cast(RAW_SCHEMA[f].dataType) for f, t in texts.items()}
    broken = F.col(f"_p.{_CORRUPT}").isNotNull()
    for f in RAW_FIELDS:
        broken |= texts[f].isNotNull() & typed[f].isNull()
    reason = F.when(F.col("_at").isNull(), UNKNOWN_HEADER).when(broken, MALFORMED_LINE)
    rows = rows.select("*", reason.alias("reason"))
    fields = [F.when(F.col("reason").isNull(), typed[f]).alias(f) for f in RAW_FIELDS]
    return rows.select(*fields, "path", F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"), "reason")


def read_mixed_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """(bound raw rows, lines kept apart with ``path, line, reason``)."""
    rows = bind_by_name(spark, path, glob)
    return rows.where("reason is null").select(*RAW_FIELDS), rows.where("reason is not null").select("path", "line", "reason")


def header_report(apart: DataFrame) -> DataFrame:
    """Lines kept apart by reason, with the number of files they are in."""
    return apart.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("path").alias("files"))
