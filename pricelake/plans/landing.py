"""Batch job: API page files -> landed raw CSV by state, resumable through a manifest and a ledger of files.

The manifest lists the states that are landed. The ledger lists every page file that was parsed (path, size and
modification time) with the rows it holds of each state, so a run parses only files that are new or changed, plus
those it must land a state from that an earlier run left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.ingest import partition_frame, pending_partitions, read_manifest, record_manifest
from pricelake.schema import RAW_FIELDS
from pricelake.session import path_exists, written
from pricelake.sources.csv import land_raw_csv
from pricelake.sources.pages import list_page_files, page_fields, read_pages_of, records_of

PARTITION = "state_partition"
NO_STATE = "_no_state"  # partition of rows with a blank state; the state inside the file stays as it is
FILE = ("path", "size", "modified")
LEDGER_SCHEMA = "path string, size long, modified timestamp, state string, rows long, bad_pages long, run string"


@dataclass
class LandingResult:
    partitions: int
    rows: int
    bad_pages: int


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows and bad pages per parsed file and state, or nothing before the first run; a file without any has a row of zeros."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def parsed(pages: DataFrame) -> DataFrame:
    """Every record of ``pages (value, path, size, modified)`` with its partition, and every bad page as a row with ``bad`` text."""
    records = records_of(F.col("value"))
    whole = pages.select(*FILE, "value", records.alias("records"))
    each = whole.select(*FILE, F.when(F.col("records").isNull(), F.col("value")).alias("bad"), F.explode_outer("records").alias("_r"))
    each = each.where(F.col("bad").isNotNull() | F.col("_r").isNotNull())
    rows = each.select(*FILE, "bad", *(F.when(F.col("bad").isNull(), v).alias(f) for f, v in zip(RAW_FIELDS, page_fields(F.col("_r")), strict=True)))
    state = F.coalesce(F.nullif(F.trim("state"), F.lit("")), F.lit(NO_STATE))
    return rows.withColumn(PARTITION, F.when(F.col("bad").isNull(), state))


def _entries(files: DataFrame, rows: DataFrame, run: str) -> DataFrame:
    counts = rows.groupBy(*FILE, F.col(PARTITION).alias("state")).agg(
        F.count(F.when(F.col("bad").isNull(), 1)).alias("rows"), F.count("bad").alias("bad_pages")
    )
    empty = files.join(counts.select("path").distinct(), "path", "left_anti")
    zeros = empty.select(*FILE, F.lit(None).cast("string").alias("state"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("bad_pages"))
    return counts.unionByName(zeros).withColumn("run", F.lit(run))


def land_pages(
    spark: SparkSession,
    pages_path: str,
    landing: str,
    manifest: str,
    quarantine: str | None = None,
    states: Iterable[str] | None = None,
    only: str | None = None,
    one_per_line: bool = False,
    ledger: str | None = None,
    reopen: bool = False,
) -> LandingResult:
    """Land the pages' rows of every partition that the manifest does not list as complete.

    ``only`` takes one state (S10), ``states`` a list; by default every state
    that the pages hold. With ``reopen`` a complete state of which the files now hold more rows is landed again.
    Without new files and pending states no page is read.

    A partition's directory is replaced as a whole and entered into the manifest after that, and parsed files into the ledger
    at last: a run that died is repeated without doubling a row, and a finished one leaves nothing to do.

    Pages that do not parse are counted (over all files that are there) and, with ``quarantine``, written there as
    text, a folder for each run; :func:`read_bad_pages` gives those of finished runs.
    """
    ledger = ledger or f"{manifest.rstrip('/')}_files"
    listing = list_page_files(spark, pages_path)
    known = read_ledger(spark, ledger).join(listing, list(FILE), "left_semi")
    new = written(spark, listing.join(known.select(*FILE).distinct(), list(FILE), "left_anti"), "new-pages")
    run = uuid.uuid4().hex
    sources, entries = [], None
    if not new.isEmpty():
        fresh = written(spark, parsed(read_pages_of(spark, pages_path, new, one_per_line)), "parsed-pages", compression="zstd")
        entries = written(spark, _entries(new, fresh, run), "page-entries")
        sources.append(fresh.where(F.col("bad").isNull()))
    held = known if entries is None else known.unionByName(entries)
    totals = held.where("rows > 0").groupBy("state").agg(F.sum("rows").alias("rows"), F.current_timestamp().alias("completed_at"))
    if only or states is not None:
        totals = totals.join(partition_frame(spark, states or (), only), "state", "left_semi")
    complete = read_manifest(spark, manifest)
    if reopen:
        landed = complete.groupBy("state").agg(F.max_by("rows", "completed_at").alias("landed"))
        complete = totals.join(landed, "state").where("rows <= landed").select("state", "rows", "completed_at")
    # One row per state.
    pending = written(spark, pending_partitions(totals, complete).select("state", "rows", "completed_at"), "pending")
    done = pending.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    if done["n"]:
        old = written(spark, known.where("rows > 0").join(pending, "state", "left_semi").select(*FILE).distinct(), "old-pages")
        if not old.isEmpty():
            sources.append(parsed(read_pages_of(spark, pages_path, old, one_per_line)).where(F.col("bad").isNull()))
        rows = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
        todo = rows.join(pending.select(F.col("state").alias(PARTITION)), PARTITION, "left_semi")
        land_raw_csv(todo, landing, partition_col=PARTITION, key=F.col(PARTITION), dynamic_overwrite=True)
        record_manifest(pending, manifest)
    if entries is not None:
        if quarantine:
            fresh.where(F.col("bad").isNotNull()).select(F.col("bad").alias("value")).write.option("compression", "zstd").parquet(f"{quarantine.rstrip('/')}/run={run}")
        entries.write.mode("append").parquet(ledger)
    bad = held.agg(F.coalesce(F.sum("bad_pages"), F.lit(0)).alias("n")).first()["n"]
    return LandingResult(done["n"], done["rows"], bad)


def read_bad_pages(spark: SparkSession, quarantine: str, ledger: str) -> DataFrame:
    """Text of the pages that did not parse, as finished runs left them."""
    if not path_exists(spark, quarantine):
        return spark.createDataFrame([], "value string")
    runs = read_ledger(spark, ledger).select("run").distinct()
    return spark.read.schema("value string, run string").parquet(quarantine).join(runs, "run", "left_semi").select("value")
