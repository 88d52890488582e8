"""API pages (JSON text with a ``records`` array) -> canonical raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.schema import RAW_FIELDS

PAGE_SCHEMA = "struct<records: array<map<string,string>>>"


def _field(record: Column, name: str) -> Column:
    """Value of ``name``; when that key is absent, the underscore-free alias; else ``''``.

    A key that is present with a null value wins over its alias and yields
    ``''`` (a plain ``coalesce`` of the two would wrongly fall through).
    """
    alias = name.replace("_", "")
    primary = F.coalesce(record[name], F.lit(""))
    if alias == name:
        return primary
    return F.when(F.map_contains_key(record, F.lit(name)), primary).otherwise(F.coalesce(record[alias], F.lit("")))


def records_of(value: Column) -> Column:
    """The ``records`` list of a page's text; null where the text does not parse or has none."""
    return F.from_json(value, PAGE_SCHEMA)["records"]


def page_fields(record: Column) -> list[Column]:
    """The ten raw fields of a record, in order."""
    return [_field(record, f).alias(f) for f in RAW_FIELDS]


def split_pages(pages: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(pages with their parsed ``records``, pages that do not parse or have no ``records`` list, as raw text)."""
    parsed = pages.select(F.col(value_col).alias("value"), records_of(F.col(value_col)).alias("records"))
    return parsed.filter(F.col("records").isNotNull()).select("records"), parsed.filter(F.col("records").isNull()).select("value")


def flatten_pages(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """One output row per record of every page, ten string fields, unknown keys dropped.

    Pages are parsed in the task that reads them and exploded there; a page
    holds at most one API page of records, so no step gathers pages together.
    Pages that do not parse are the other side of :func:`split_pages`.
    """
    records = split_pages(pages, value_col)[0].select(F.explode("records").alias("_r"))
    return records.select(*page_fields(F.col("_r")))


def flatten_records(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """S7, record by record: the ten fields of every record, and ``odd``, the JSON of list elements that are no records.

    Pages are parsed as VARIANT, so an element that is no object (a number, a list) costs itself and not its page, as it
    does where the whole list has one type. Numbers and booleans become text as VARIANT spells them (all digits of a
    decimal, without zeros at its end), nested values stay as JSON text. A page that does not parse, or has
    no ``records`` list, gives no rows (:func:`odd_pages`).
    """
    each = pages.select(F.explode(_variant_records(F.col(value_col))).alias("_r"))
    each = each.select("_r", F.try_variant_get("_r", "$", "map<string,variant>").alias("_m"))

    def text(name: str) -> Column:
        return F.coalesce(F.try_variant_get(F.col("_m")[name], "$", "string"), F.lit(""))

    fields = []
    for f in RAW_FIELDS:
        alias = f.replace("_", "")
        value = text(f) if alias == f else F.when(F.map_contains_key("_m", F.lit(f)), text(f)).otherwise(text(alias))
        fields.append(F.when(F.col("_m").isNotNull(), value).alias(f))
    return each.select(*fields, F.when(F.col("_m").isNull(), F.to_json("_r")).alias("odd"))


def odd_pages(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """Text of the pages that do not parse or have no ``records`` list."""
    return pages.where(_variant_records(F.col(value_col)).isNull()).select(F.col(value_col).alias("value"))


def _variant_records(value: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(value), "$.records", "array<variant>")


def dry_run(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """Field names and JSON of the first record of the first non-empty page; nothing is written."""
    first = pages.select(F.get(records_of(F.col(value_col)), 0).alias("_r"))  # null for an empty page (no ANSI index error)
    return first.filter(F.col("_r").isNotNull()).select(
        F.array_sort(F.map_keys("_r")).alias("fields"), F.to_json("_r").alias("record")
    ).limit(1)


def read_pages(spark, path: str, one_per_line: bool = False) -> DataFrame:
    """Page files as text (``value``): a file is one page, however it is laid out, or holds one page per line."""
    return spark.read.text(path, wholetext=not one_per_line, recursiveFileLookup=True)


def _file_columns() -> tuple[Column, ...]:
    names = (("file_path", "path"), ("file_size", "size"), ("file_modification_time", "modified"))
    return tuple(F.col(f"_metadata.{hidden}").alias(name) for hidden, name in names)


def list_page_files(spark, path: str) -> DataFrame:
    """``path, size, modified`` of every page file, by listing only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(*_file_columns())


def read_pages_of(spark, path: str, files: DataFrame, one_per_line: bool = False) -> DataFrame:
    """``value, path, size, modified`` of the pages in ``files (path, size, modified)`` below ``path``.

    The files' time span is a predicate on file metadata, so Spark opens no file outside it; within it, files that are
    not listed are left out by a join.
    """
    span = files.agg(F.min(F.unix_micros("modified")).alias("low"), F.max(F.unix_micros("modified")).alias("high")).first()
    pages = read_pages(spark, path, one_per_line).select("value", *_file_columns())
    pages = pages.where(F.col("modified").between(*(F.timestamp_micros(F.lit(t)) for t in span)))
    return pages.join(files.select("path", "size", "modified"), ["path", "size", "modified"], "left_semi")
