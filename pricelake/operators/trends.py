"""Monthly trends over the trailing, data-relative twelve months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions import round_half_up
from pricelake.operators.summaries import top_commodity_names
from pricelake.schema import Config


def trailing_cutoff(df: DataFrame, months: int = 12, anchor: dt.date | None = None) -> Column:
    """Latest arrival date of the whole table minus ``months``.

    ``add_months`` clamps to month end (31 Mar -> 28/29 Feb); the lower bound is
    inclusive, so twelve months usually span thirteen calendar months.

    ``anchor`` is the latest date where it is known (the processed table keeps
    it, :func:`~pricelake.sources.parquet.read_anchor`): the cut-off is then a
    constant and no scan looks for it. Otherwise it is a scalar subquery.
    """
    if anchor is not None:
        return F.add_months(F.lit(anchor), -months)
    return df.select(F.add_months(F.max("arrival_date"), -months)).scalar()


def trailing_window(df: DataFrame, cfg: Config | None = None, prune_years: bool = True, anchor: dt.date | None = None) -> DataFrame:
    """Rows on or after the cut-off.

    The redundant ``year >=`` predicate lets a table partitioned by ``year``
    skip whole directories (it shows up as a PartitionFilter on the scan);
    ``prune_years=False`` leaves it out, for comparison.
    """
    cfg = cfg or Config()
    cutoff = trailing_cutoff(df, cfg.trailing_months, anchor)
    cond = F.col("arrival_date") >= cutoff
    if prune_years and "year" in df.columns:
        cond = (F.col("year") >= F.year(cutoff)) & cond
    return df.filter(cond)


def _year_month(year: str = "year", month: str = "month") -> Column:
    return F.format_string("%04d-%02d", F.col(year), F.col(month))


def monthly_price_trend(
    df: DataFrame, cfg: Config | None = None, prune_years: bool = True, anchor: dt.date | None = None
) -> DataFrame:
    """Q2: national monthly average modal price, oldest month first."""
    cfg = cfg or Config()
    recent = trailing_window(df, cfg, prune_years, anchor)
    return (
        recent.groupBy("year", "month")
        .agg(
            F.avg("modal_price").alias("_avg"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .select(
            "year",
            "month",
            _year_month().alias("year_month"),
            round_half_up("_avg").alias("avg_modal_price"),
            "record_count",
        )
        .orderBy("year_month")
    )


def monthly_price_by_commodity(
    df: DataFrame, cfg: Config | None = None, stats: DataFrame | None = None, anchor: dt.date | None = None
) -> DataFrame:
    """Q3: monthly average per top-k commodity (top-k over all dates, then the trailing window).

    The top-k list is a semi-join against a frame of at most ``k`` rows, so it
    is broadcast without a size check and the fact side is never shuffled for it.
    A precomputed :func:`commodity_stats` table can supply the list.
    """
    cfg = cfg or Config()
    top = F.broadcast(top_commodity_names(df if stats is None else stats, cfg.top_commodities_k))
    recent = trailing_window(df, cfg, anchor=anchor).join(top, "commodity", "left_semi")
    return (
        recent.groupBy("commodity", "year", "month")
        .agg(F.avg("modal_price").alias("_avg"), F.count(F.lit(1)).alias("record_count"))
        .select(
            "commodity",
            _year_month().alias("year_month"),
            round_half_up("_avg").alias("avg_modal_price"),
            "record_count",
        )
        .orderBy("commodity", "year_month")
    )
