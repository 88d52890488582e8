"""Grouped summaries of the clean price table (top commodities, states, volatility, spread, profile).

All of these are single ``groupBy`` aggregations: Spark runs a partial
aggregate before the shuffle, so a key that holds a large share of the rows is
combined map-side and never reaches one task as raw rows. Top-k results use
``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``; every sort
appends the group keys so that ties resolve the same way in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import round_half_up
from pricelake.schema import Config


def _top(df: DataFrame, k: int | None, *order) -> DataFrame:
    out = df.orderBy(*order)
    return out.limit(k) if k is not None else out


def commodity_counts(df: DataFrame) -> DataFrame:
    """commodity -> record_count (non-null commodities)."""
    return df.filter(F.col("commodity").isNotNull()).groupBy("commodity").agg(F.count(F.lit(1)).alias("record_count"))


def top_commodity_names(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent commodities (one column, at most ``k`` rows).

    ``df`` is either price records or a :func:`commodity_stats` table.
    """
    counts = df if "pos_count" in df.columns else commodity_counts(df)
    return _top(counts, k, F.desc("record_count"), F.asc("commodity")).select("commodity")


def commodity_stats(df: DataFrame) -> DataFrame:
    """One aggregation per commodity feeding Q1, Q3's top-k list and Q5.

    All-row statistics (Q1) and statistics over positive modal prices (Q5)
    are computed side by side, so a job that needs all three reads the table
    once. One row per commodity; unrounded.
    """
    pos = F.when(F.col("modal_price") > 0, F.col("modal_price"))
    return (
        df.filter(F.col("commodity").isNotNull())
        .groupBy("commodity")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.avg("modal_price").alias("avg_all"),
            F.min("modal_price").alias("min_all"),
            F.max("modal_price").alias("max_all"),
            F.count(pos).alias("pos_count"),
            F.avg(pos).alias("pos_avg"),
            F.stddev_samp(pos).alias("pos_sd"),
            F.min(pos).alias("pos_min"),
            F.max(pos).alias("pos_max"),
        )
    )


def _stats(df: DataFrame) -> DataFrame:
    return df if "pos_count" in df.columns else commodity_stats(df)


def top_commodities(df: DataFrame, cfg: Config | None = None, k: int | None = None) -> DataFrame:
    """Q1: most-recorded commodities with average / min / max modal price.

    ``df`` is either price records or a :func:`commodity_stats` table.
    """
    cfg = cfg or Config()
    k = cfg.top_commodities_k if k is None else k
    agg = _stats(df).select(
        "commodity",
        "record_count",
        round_half_up("avg_all").alias("avg_modal_price"),
        round_half_up("min_all").alias("min_modal_price"),
        round_half_up("max_all").alias("max_modal_price"),
    )
    return _top(agg, k, F.desc("record_count"), F.asc("commodity"))


def state_summary(df: DataFrame) -> DataFrame:
    """Per state: rows, average and summed modal price, distinct markets and commodities.

    The two distinct counts are planned with an ``Expand``: rows are first
    de-duplicated per (state, market) and (state, commodity) with partial
    aggregation, so a state holding most of the data is still spread over tasks.
    """
    return (
        df.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            round_half_up(F.avg("modal_price")).alias("avg_modal_price"),
            round_half_up(F.sum("modal_price"), 0).alias("price_index_sum"),
            F.count_distinct("market").alias("unique_markets"),
            F.count_distinct("commodity").alias("unique_commodities"),
        )
    )


def all_states_summary(df: DataFrame) -> DataFrame:
    """Q8: every state, largest price index sum first."""
    return state_summary(df).orderBy(F.desc("price_index_sum"), F.asc("state"))


def top_states(df: DataFrame, cfg: Config | None = None, k: int | None = None) -> DataFrame:
    """Q4: the first ``k`` rows of :func:`all_states_summary`."""
    cfg = cfg or Config()
    k = cfg.top_states_k if k is None else k
    return _top(state_summary(df), k, F.desc("price_index_sum"), F.asc("state"))


def price_volatility(df: DataFrame, cfg: Config | None = None, k: int | None = None) -> DataFrame:
    """Q5: sample standard deviation and coefficient of variation of modal price per commodity.

    Only positive modal prices count. A single-row commodity has no sample
    deviation; it reports 0.0. ``df`` is price records or a
    :func:`commodity_stats` table.
    """
    cfg = cfg or Config()
    k = cfg.volatility_k if k is None else k
    sd, mean = F.col("pos_sd"), F.col("pos_avg")
    agg = (
        _stats(df)
        .filter(F.col("pos_count") >= max(cfg.min_records, 1))
        .select(
            "commodity",
            F.col("pos_count").alias("record_count"),
            round_half_up(mean).alias("avg_modal_price"),
            round_half_up(F.coalesce(sd, F.lit(0.0))).alias("stddev_modal_price"),
            round_half_up(F.coalesce(sd / mean * F.lit(100), F.lit(0.0))).alias("coeff_variation_pct"),
            round_half_up("pos_min").alias("min_price_ever"),
            round_half_up("pos_max").alias("max_price_ever"),
        )
    )
    return _top(agg, k, F.desc("stddev_modal_price"), F.asc("commodity"))


def market_inefficiency(df: DataFrame, cfg: Config | None = None, k: int | None = None) -> DataFrame:
    """Q6: mean max-min spread per (state, market), absolute and as % of modal price.

    The percentage is the mean of per-row percentages, not a ratio of means.
    State may be null (a record with a blank state still has a market).
    """
    cfg = cfg or Config()
    k = cfg.inefficiency_k if k is None else k
    spread = F.col("max_price") - F.col("min_price")
    agg = (
        df.filter((F.col("min_price") > 0) & (F.col("max_price") > 0) & (F.col("modal_price") > 0))
        .groupBy("state", "market")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            round_half_up(F.avg(spread)).alias("avg_price_spread"),
            round_half_up(F.avg(spread / F.col("modal_price") * F.lit(100))).alias("avg_spread_pct"),
            round_half_up(F.avg("modal_price")).alias("avg_modal_price"),
        )
        .filter(F.col("record_count") >= cfg.min_records)
    )
    return _top(agg, k, F.desc("avg_spread_pct"), F.asc_nulls_first("state"), F.asc_nulls_first("market"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Q9: one row -- rows, date range, distinct commodities / states / markets.

    Distinct counts follow ``distinct().count()``: a null is counted as one
    more value. All five numbers come from one aggregation job.
    """

    def n_distinct(c: str):
        return F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("arrival_date").alias("min_arrival_date"),
        F.max("arrival_date").alias("max_arrival_date"),
        n_distinct("commodity").alias("unique_commodities"),
        n_distinct("state").alias("unique_states"),
        n_distinct("market").alias("unique_markets"),
    )
