"""Mergeable states of the processed table: exact answers, refreshed from new batches only.

Every batch of the table (see :mod:`pricelake.sources.parquet`) contributes rows of state that merge without loss:

- ``commodities``: per commodity the row count and, over all and over positive modal prices, n, sum, mean, M2 (the sum
  of squared deviations), minimum and maximum; means and M2 merge by the pairwise formula of Chan, Golub and LeVeque;
- ``states``: per state the rows, the price sum, the date range and how many markets and commodities are null;
- ``values``: per state bitmaps of the markets and commodities that occur. A dictionary gives every distinct
  name a dense number that never changes, so an OR of bitmaps and a count of bits is an exact distinct count.

A refresh reads the batches that the table's log names and the rollup does not hold in that version, by a filter on the batch
partition. States of batches that were replaced or are gone are no longer read. A refresh that dies is repeated: states are
replaced batch by batch and a batch counts as held only when all three tables have it. One refresh runs at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.functions import round_half_up
from pricelake.operators.places import placed
from pricelake.schema import BATCH_COLUMN
from pricelake.session import path_exists, written
from pricelake.sources.parquet import WHOLE_TABLE, batch_log, read_table

KINDS = ("market", "commodity")
HELD_SCHEMA = "batch string, at long"
NAMES_SCHEMA = "kind string, value string, id long"
COMMODITY_SCHEMA = (
    "commodity string, record_count long, n long, sum double, min double, max double, "
    "pos_n long, pos_mean double, pos_m2 double, pos_min double, pos_max double, batch string"
)
STATE_SCHEMA = "state string, rows long, n long, sum double, first_date date, last_date date, null_market long, null_commodity long, batch string"
VALUE_SCHEMA = "state string, kind string, bucket long, bits binary, batch string"


@dataclass
class Refreshed:
    batches: int
    rows: int


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _held(spark: SparkSession, rollup: str) -> DataFrame:
    return _read(spark, f"{rollup}/held", HELD_SCHEMA).groupBy("batch").agg(F.max("at").alias("at"))


def new_rows(spark: SparkSession, processed: str, batches: list[str], named: list[str]) -> DataFrame:
    """The rows of ``batches`` with ``batch``; other batches' folders are not opened.

    Rows that no logged write brought (``named``) belong to the batch ``WHOLE_TABLE``.
    """
    own = F.col(BATCH_COLUMN)
    chosen = own.isin([b for b in batches if b != WHOLE_TABLE])
    if WHOLE_TABLE in batches:
        chosen |= own.isNull() | ~own.isin(named)
    batch = F.when(own.isin(named), own).otherwise(F.lit(WHOLE_TABLE))
    return read_table(spark, processed).where(chosen).select(batch.alias("batch"), "state", "market", "commodity", "arrival_date", "modal_price")


def commodity_states(rows: DataFrame) -> DataFrame:
    pos = F.when(F.col("modal_price") > 0, F.col("modal_price"))
    return rows.where("commodity is not null").groupBy("batch", "commodity").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count("modal_price").alias("n"),
        F.sum("modal_price").alias("sum"),
        F.min("modal_price").alias("min"),
        F.max("modal_price").alias("max"),
        F.count(pos).alias("pos_n"),
        F.avg(pos).alias("pos_mean"),
        (F.var_pop(pos) * F.count(pos)).alias("pos_m2"),
        F.min(pos).alias("pos_min"),
        F.max(pos).alias("pos_max"),
    )


def state_states(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch", "state").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("modal_price").alias("n"),
        F.sum("modal_price").alias("sum"),
        F.min("arrival_date").alias("first_date"),
        F.max("arrival_date").alias("last_date"),
        *(F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in KINDS),
    )


def _named(spark: SparkSession, rows: DataFrame, rollup: str) -> DataFrame:
    """The distinct ``batch, state, kind, value`` of the rows with the number of each value; new values get the next ones."""
    each = rows.select("batch", "state", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in KINDS))).alias("v"))
    each = written(spark, each.select("batch", "state", "v.kind", "v.value").where("value is not null").distinct(), "rollup-values")
    known = _read(spark, f"{rollup}/names", NAMES_SCHEMA)
    fresh = each.select("kind", "value").distinct().join(known, ["kind", "value"], "left_anti")
    next_id = known.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("n")).first()["n"]
    numbered = placed(fresh, ["kind", "value"], "rollup-names").select("kind", "value", (F.col("place") + next_id).alias("id"))
    numbered = written(spark, numbered, "rollup-names")
    if not numbered.isEmpty():
        numbered.write.mode("append").parquet(f"{rollup}/names")
    return each.join(_read(spark, f"{rollup}/names", NAMES_SCHEMA), ["kind", "value"])


def value_states(named: DataFrame) -> DataFrame:
    """Bitmaps of 32,768 numbers each, per batch, state and kind."""
    bucket, bit = F.bitmap_bucket_number("id"), F.bitmap_bit_position("id")
    return named.select("batch", "state", "kind", bucket.alias("bucket"), bit.alias("bit")).groupBy("batch", "state", "kind", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )


def refresh(spark: SparkSession, processed: str, rollup: str) -> Refreshed:
    """Bring the states at ``rollup`` up to the table at ``processed``; how many batches and rows were read."""
    rollup = rollup.rstrip("/")
    log = batch_log(spark, processed)
    todo = written(spark, log.join(_held(spark, rollup), ["batch", "at"], "left_anti"), "rollup-todo")
    batches = [r["batch"] for r in todo.select("batch").collect()]  # names of writes
    if not batches:
        return Refreshed(0, 0)
    rows = new_rows(spark, processed, batches, [r["batch"] for r in log.collect() if r["batch"] != WHOLE_TABLE])

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{rollup}/{name}")

    put(commodity_states(rows), "commodities")
    put(value_states(_named(spark, rows, rollup)), "values")
    states = written(spark, state_states(rows), "rollup-states")
    put(states, "states")
    todo.coalesce(1).write.mode("append").parquet(f"{rollup}/held")
    return Refreshed(len(batches), states.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"])


def _current(spark: SparkSession, processed: str, rollup: str, name: str, schema: str) -> DataFrame:
    """The states of batches that are in the table and held in their latest version."""
    rollup = rollup.rstrip("/")
    valid = batch_log(spark, processed).join(_held(spark, rollup), ["batch", "at"], "left_semi").select("batch")
    return _read(spark, f"{rollup}/{name}", schema).join(valid, "batch", "left_semi")


def merged_commodity_stats(spark: SparkSession, processed: str, rollup: str) -> DataFrame:
    """The table of :func:`~pricelake.operators.summaries.commodity_stats`, merged from the states."""
    parts = _current(spark, processed, rollup, "commodities", COMMODITY_SCHEMA)
    # A partition holds one row per batch. M2 = sum of own M2 and of n * (own mean - mean) squared.
    own = Window.partitionBy("commodity")
    mean = F.sum(F.col("pos_n") * F.col("pos_mean")).over(own) / F.nullif(F.sum("pos_n").over(own), F.lit(0))
    parts = parts.withColumn("_mean", mean)
    spread = F.sum(F.col("pos_m2") + F.col("pos_n") * F.pow(F.col("pos_mean") - F.col("_mean"), F.lit(2)))
    n = F.sum("pos_n")
    return parts.groupBy("commodity").agg(
        F.sum("record_count").alias("record_count"),
        (F.sum("sum") / F.nullif(F.sum("n"), F.lit(0))).alias("avg_all"),
        F.min("min").alias("min_all"),
        F.max("max").alias("max_all"),
        n.alias("pos_count"),
        F.max("_mean").alias("pos_avg"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("pos_sd"),
        F.min("pos_min").alias("pos_min"),
        F.max("pos_max").alias("pos_max"),
    )


def _distinct(spark: SparkSession, processed: str, rollup: str, by: tuple[str, ...]) -> DataFrame:
    """Exact distinct counts per ``by`` and kind: bitmaps ORed per bucket, then their bits."""
    bits = _current(spark, processed, rollup, "values", VALUE_SCHEMA)
    merged = bits.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("k"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("k"))), F.lit(0)).alias(kind)
    return merged.groupBy(*by).agg(*(of(k) for k in KINDS))


def merged_state_summary(spark: SparkSession, processed: str, rollup: str) -> DataFrame:
    """The table of :func:`~pricelake.operators.summaries.all_states_summary`, merged from the states."""
    totals = _current(spark, processed, rollup, "states", STATE_SCHEMA).where("state is not null").groupBy("state").agg(
        F.sum("rows").alias("record_count"),
        round_half_up(F.sum("sum") / F.nullif(F.sum("n"), F.lit(0))).alias("avg_modal_price"),
        round_half_up(F.sum("sum"), 0).alias("price_index_sum"),
    )
    found = _distinct(spark, processed, rollup, ("state",))
    counts = [F.coalesce(F.col(k), F.lit(0)).alias(name) for k, name in zip(KINDS, ("unique_markets", "unique_commodities"), strict=True)]
    rows = totals.join(found, "state", "left").select("state", "record_count", "avg_modal_price", "price_index_sum", *counts)
    return rows.orderBy(F.desc("price_index_sum"), F.asc("state"))


def merged_profile(spark: SparkSession, processed: str, rollup: str) -> DataFrame:
    """The row of :func:`~pricelake.operators.summaries.dataset_profile`, merged from the states."""
    states = _current(spark, processed, rollup, "states", STATE_SCHEMA)
    null = lambda c: F.coalesce(F.max((c > 0).cast("int")), F.lit(0))
    totals = states.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"),
        F.min("first_date").alias("min_arrival_date"),
        F.max("last_date").alias("max_arrival_date"),
        (F.count_distinct("state") + F.coalesce(F.max(F.col("state").isNull().cast("int")), F.lit(0))).alias("unique_states"),
        *(null(F.col(f"null_{k}")).alias(f"_null_{k}") for k in KINDS),
    )
    found = _distinct(spark, processed, rollup, ())  # one row
    return totals.select(
        "total_records",
        "min_arrival_date",
        "max_arrival_date",
        (found.select("commodity").scalar() + F.col("_null_commodity")).alias("unique_commodities"),
        "unique_states",
        (found.select("market").scalar() + F.col("_null_market")).alias("unique_markets"),
    )
