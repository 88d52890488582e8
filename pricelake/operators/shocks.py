"""Price shocks: a commodity's daily average far from its own trailing level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions import round_half_up
from pricelake.operators.arbitrage import daily_prices
from pricelake.schema import Config


def price_shocks(df: DataFrame, cfg: Config | None = None, daily: DataFrame | None = None) -> DataFrame:
    """Days whose average lies more than ``shock_z`` trailing standard deviations from the trailing mean.

    The trailing window covers the ``shock_window_days`` calendar days before
    the day (the day itself excluded), over days that have records; at least
    ``shock_min_days`` such days and a positive deviation are required.

    Raw rows are first reduced to one row per (commodity, day) with a map-side
    combined aggregation, so each window partition holds at most one row per
    calendar day of a commodity, however many records that commodity has. A
    written :func:`~pricelake.operators.arbitrage.daily_prices` table can be
    passed as ``daily``. Rows come in no particular order: the result grows
    with the data, and a global sort would compute it twice.
    """
    cfg = cfg or Config()
    daily = (daily_prices(df) if daily is None else daily).withColumn("_day", F.unix_date("arrival_date"))
    w = Window.partitionBy("commodity").orderBy("_day").rangeBetween(-cfg.shock_window_days, -1)
    t = daily.select(
        "commodity",
        "arrival_date",
        "record_count",
        "daily_avg",
        F.avg("daily_avg").over(w).alias("trailing_avg"),
        F.stddev_samp("daily_avg").over(w).alias("trailing_sd"),
        F.count("daily_avg").over(w).alias("trailing_days"),
    )
    z = (F.col("daily_avg") - F.col("trailing_avg")) / F.col("trailing_sd")
    return (
        t.filter((F.col("trailing_days") >= cfg.shock_min_days) & (F.col("trailing_sd") > 0))
        .withColumn("_z", z)
        .filter(F.abs("_z") > F.lit(cfg.shock_z))
        .select(
            "commodity",
            "arrival_date",
            "record_count",
            round_half_up("daily_avg").alias("daily_avg_price"),
            round_half_up("trailing_avg").alias("trailing_avg_price"),
            round_half_up("trailing_sd").alias("trailing_stddev"),
            "trailing_days",
            round_half_up("_z").alias("z_score"),
            F.when(F.col("_z") > 0, F.lit("spike")).otherwise(F.lit("drop")).alias("direction"),
        )
    )
