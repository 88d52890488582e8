"""Chart-ready frames: ordering, labels, pivot and long form of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import money_label, pct_label
from pricelake.operators.regions import with_price_index


def price_trend_feed(trend: DataFrame) -> DataFrame:
    """V1: x = year_month, y = avg_modal_price."""
    return trend.select("year_month", "avg_modal_price").orderBy("year_month")


def top_commodities_feed(top: DataFrame) -> DataFrame:
    """V2: smallest record count first (bar charts draw bottom-up)."""
    return top.orderBy(F.asc("record_count"), F.asc("commodity"))


def state_labels(states: DataFrame) -> DataFrame:
    """State, price index sum and its money label."""
    s = with_price_index(states)
    return s.select("state", "price_index_sum", money_label("price_index_sum").alias("price_label"))


def state_activity_long(states: DataFrame) -> DataFrame:
    """V3 second panel: (state, metric, value) for distinct markets and commodities."""
    return states.select("state", "unique_markets", "unique_commodities").unpivot(
        "state", ["unique_markets", "unique_commodities"], "metric", "value"
    )


def volatility_feed(volatility: DataFrame) -> DataFrame:
    """Volatility rows, lowest coefficient of variation first, with a % label."""
    return volatility.withColumn("cv_label", pct_label("coeff_variation_pct")).orderBy(
        F.asc("coeff_variation_pct"), F.asc("commodity")
    )


def inefficiency_feed(ineff: DataFrame) -> DataFrame:
    """V5: scatter columns as-is."""
    return ineff.select("state", "market", "avg_modal_price", "avg_spread_pct", "avg_price_spread", "record_count")


def arbitrage_matrix(signal: DataFrame, commodities: list[str] | None = None) -> DataFrame:
    """State x commodity matrix of mean ``avg_deviation_pct``, empty cells 0.

    ``signal`` is the written, limited arbitrage signal (at most its k rows), so
    a 0 mostly means "not in the top rows" rather than "no deviation". Without
    ``commodities`` Spark first looks up the distinct ones of ``signal``, which
    reads it twice: pass a table that was written, not the query.
    """
    grouped = signal.groupBy("state")
    pivoted = grouped.pivot("commodity", commodities) if commodities is not None else grouped.pivot("commodity")
    out = pivoted.agg(F.avg("avg_deviation_pct"))
    value_cols = [c for c in out.columns if c != "state"]
    return out.na.fill(0.0, subset=value_cols) if value_cols else out


def matrix_cells(matrix: DataFrame) -> DataFrame:
    """The matrix in long form, one row per cell with zeros kept: (state, commodity, avg_deviation_pct)."""
    commodities = [c for c in matrix.columns if c != "state"]
    return matrix.unpivot("state", commodities, "commodity", "avg_deviation_pct")
