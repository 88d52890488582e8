"""Raw CSV landing (write) and scan (read), with malformed-row quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schema import CORRUPT_COLUMN, RAW_FIELDS, RAW_SCHEMA

RAW_SCHEMA_WITH_CORRUPT = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])

# Keep padding and blanks exactly as landed: the CSV writer trims by default.
_WRITE_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def land_raw_csv(
    df: DataFrame,
    path: str,
    partition_col: str = "src_state",
    key: Column | None = None,
    mode: str = "overwrite",
    dynamic_overwrite: bool = False,
    compression: str | None = None,
    dealt: bool = False,
) -> None:
    """Write raw rows as CSV files under ``<partition_col>=<value>/``.

    The partition value is a *copy* of the state (``key``, default the raw
    state) so the state stays inside every file as well. A ``rebalance`` on
    the partition value sends each state's rows to few tasks, so a directory
    gets a few large files rather than one file per input task, while AQE
    still splits a state that holds a large share of the rows.
    ``dynamic_overwrite`` replaces only the partitions present in ``df``.
    With ``compression`` (``gzip``, ...) files are named ``*.csv.gz`` and so on, and readers take such a glob.
    ``dealt`` says that ``df`` comes balanced by its key already, so its rows are not shuffled once more.
    """
    key = F.col("state") if key is None else key
    rows = df.select(*RAW_FIELDS, key.alias(partition_col))
    (
        (rows if dealt else rows.hint("rebalance", partition_col))
        .write.mode(mode)
        .options(**_WRITE_OPTIONS)
        .option("partitionOverwriteMode", "dynamic" if dynamic_overwrite else "static")
        .partitionBy(partition_col)
        .csv(path, compression=compression)
    )


def csv_options(header: bool = True, enforce_schema: bool = False, glob: str = "*.csv") -> dict[str, str]:
    """Options of every raw CSV scan, batch or streaming.

    ``recursiveFileLookup`` ignores ``state=`` directory names (the state is a
    column inside the files). With ``enforce_schema=False`` a file whose header
    names the columns in another order fails the read instead of being bound
    by position into the wrong fields. A row that does not fit the schema keeps
    its text in ``_corrupt_record``; asking for that column also makes Spark
    check every field of a row, whatever columns a query needs.
    """
    return {
        "header": str(header).lower(),
        "enforceSchema": str(enforce_schema).lower(),
        "recursiveFileLookup": "true",
        "pathGlobFilter": glob,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    }


def read_raw_csv_with_corrupt(
    spark: SparkSession, path: str, header: bool = True, enforce_schema: bool = False, glob: str = "*.csv"
) -> DataFrame:
    """S3: PERMISSIVE scan; a row that does not fit the schema keeps its text in ``_corrupt_record``.

    Spark refuses a query that reads only the corrupt-record column, so keep
    the data columns in the projection (as :func:`split_malformed` does).
    """
    return spark.read.schema(RAW_SCHEMA_WITH_CORRUPT).options(**csv_options(header, enforce_schema, glob)).csv(path)


def read_raw_csv(
    spark: SparkSession, path: str, header: bool = True, enforce_schema: bool = False, glob: str = "*.csv"
) -> DataFrame:
    """The well-formed rows of every ``*.csv`` below ``path``, explicit schema, no inference.

    This is the good side of :func:`split_malformed`, so every action sees the
    same rows, whichever columns it reads.
    """
    return split_malformed(read_raw_csv_with_corrupt(spark, path, header, enforce_schema, glob))[0]


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows with their raw text)."""
    # Spark refuses a scan of the corrupt-record column alone, which a bare count would be: always true, but reads a field.
    reads_field = F.octet_length(F.coalesce(F.col(RAW_FIELDS[0]), F.lit(""))) >= 0
    good = df.filter(F.col(CORRUPT_COLUMN).isNull() & reads_field).select(*RAW_FIELDS)
    bad = df.filter(F.col(CORRUPT_COLUMN).isNotNull() & reads_field).select(*RAW_FIELDS, CORRUPT_COLUMN)
    return good, bad


def quarantine_view(df: DataFrame) -> DataFrame:
    """Every row once, flagged; a malformed row's fields are not trusted and come back null."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return df.select(
        *[F.when(bad, F.lit(None).cast(RAW_SCHEMA[c].dataType)).otherwise(F.col(c)).alias(c) for c in RAW_FIELDS],
        bad.alias("is_malformed"),
    )


def raw_csv_lines(df: DataFrame, defects: Column | None = None) -> DataFrame:
    """Raw rows rendered as unquoted CSV text lines (column ``value``), for text landing.

    ``defects`` (optional) is a string column that, when non-null, replaces
    the rendered line; used to land deliberately broken lines.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_FIELDS]
    line = F.concat_ws(",", *fields)
    if defects is not None:
        line = F.coalesce(defects, line)
    return df.select(line.alias("value"))
