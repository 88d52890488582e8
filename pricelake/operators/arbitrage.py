"""National average per (commodity, day) and the state-vs-nation arbitrage signal.

The national average is row-weighted: every price record of the day counts
once, the state's own records included. A (commodity, day) group can be very
large (one popular commodity on one busy day), so neither operator evaluates a
window over raw rows:

* :func:`national_average` aggregates (commodity, day) with map-side partial
  aggregation and joins the one-row-per-key result back. AQE turns that join
  into a broadcast when the daily table is small at run time, or splits a hot
  key across tasks (skew join) when it is not.
* :func:`arbitrage_signal` first collapses raw rows to (state, commodity, day)
  sums; the national-average window then runs over at most one row per state
  in each (commodity, day) partition, and the per-row deviation terms are
  recovered exactly from the sums (for a positive average, ``(x - a) / a`` is
  monotone in ``x``, so the largest deviation comes from the largest price).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import round_half_up
from pricelake.schema import Config


def _eligible(df: DataFrame) -> DataFrame:
    return df.filter(F.col("commodity").isNotNull() & (F.col("modal_price") > 0))


def daily_prices(df: DataFrame) -> DataFrame:
    """(commodity, arrival_date) -> daily_avg (row-weighted), record_count; combined before the shuffle."""
    return (
        _eligible(df)
        .groupBy("commodity", "arrival_date")
        .agg(F.avg("modal_price").alias("daily_avg"), F.count(F.lit(1)).alias("record_count"))
    )


def national_average(df: DataFrame, daily: DataFrame | None = None) -> DataFrame:
    """Each eligible row with ``national_avg`` and ``deviation_pct``.

    ``daily`` is :func:`daily_prices` of the same rows. Pass it as a table that
    was written and read back: both sides of the join then stand directly on a
    shuffle of their own, which is what AQE needs to split a (commodity, day)
    that holds a large share of the rows. Computed in place, the daily side
    reuses its aggregate's shuffle and a hot day stays in one task.
    """
    per_day = daily_prices(df) if daily is None else daily
    per_day = per_day.select("commodity", "arrival_date", F.col("daily_avg").alias("national_avg"))
    rows = _eligible(df).join(per_day, ["commodity", "arrival_date"], "inner")
    return rows.withColumn(
        "deviation_pct", (F.col("modal_price") - F.col("national_avg")) / F.col("national_avg") * F.lit(100)
    )


def state_day_deviation(df: DataFrame) -> DataFrame:
    """(state, commodity, day) rows with the national average and summed deviation terms.

    ``dev_sum`` is the sum over the group's rows of ``(price - avg) / avg * 100``
    and ``dev_max`` its maximum.
    """
    per_state_day = (
        _eligible(df)
        .groupBy("state", "commodity", "arrival_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("modal_price").alias("s"),
            F.max("modal_price").alias("mx"),
        )
    )
    day = Window.partitionBy("commodity", "arrival_date")
    with_nat = per_state_day.withColumn("national_avg", F.sum("s").over(day) / F.sum("n").over(day))
    nat = F.col("national_avg")
    return with_nat.select(
        "state",
        "commodity",
        "arrival_date",
        "n",
        "s",
        nat.alias("national_avg"),
        ((F.col("s") - F.col("n") * nat) / nat * F.lit(100)).alias("dev_sum"),
        ((F.col("mx") - nat) / nat * F.lit(100)).alias("dev_max"),
    )


def arbitrage_signal(df: DataFrame, cfg: Config | None = None, k: int | None = None) -> DataFrame:
    """Q7: per (state, commodity) mean deviation from the same-day national average.

    ``avg_national_price`` is the mean of the national average over the state's
    own rows. ``k=None`` on the config path keeps the top ``cfg.arbitrage_k``;
    pass ``k=0`` for every (state, commodity) pair.
    """
    cfg = cfg or Config()
    k = cfg.arbitrage_k if k is None else k
    g = state_day_deviation(df)
    n = F.sum("n")
    agg = (
        g.groupBy("state", "commodity")
        .agg(
            n.alias("record_count"),
            round_half_up(F.sum("s") / n).alias("avg_state_price"),
            round_half_up(F.sum(F.col("n") * F.col("national_avg")) / n).alias("avg_national_price"),
            round_half_up(F.sum("dev_sum") / n).alias("avg_deviation_pct"),
            round_half_up(F.max("dev_max")).alias("max_deviation_pct"),
        )
        .filter(F.col("record_count") >= cfg.min_records)
        .orderBy(F.desc("avg_deviation_pct"), F.asc_nulls_first("state"), F.asc("commodity"))
    )
    return agg.limit(k) if k else agg
