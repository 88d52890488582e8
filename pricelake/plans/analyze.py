"""Batch job: processed table -> every market question and report feed, written as result tables.

Nothing is collected to the driver: each result is written by Spark. Work
shared between questions is written once and read back: per-commodity
statistics feed Q1, Q5 and Q3's top-k list, and the state summary (Q8)
feeds the top-states table (Q4) and its labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import arbitrage, feeds, msp, regions, shocks, summaries, trends
from pricelake.schema import Config
from pricelake.sources.geo import region_names
from pricelake.plans.sqlfunctions import register_functions
from pricelake.sources.parquet import read_anchor, read_processed, register_view
from pricelake.sources.results import read_result_csv, write_result_csv

STATE_SUMMARY_SCHEMA = (
    "state string, record_count long, avg_modal_price double, price_index_sum double, unique_markets long, unique_commodities long"
)


def run_analyze(
    spark: SparkSession,
    processed_path: str,
    results_path: str,
    cfg: Config,
    geojson_path: str | None = None,
    msp_pairs=None,
) -> dict[str, str]:
    """Write every result under ``results_path/<name>``; returns name -> path."""
    df = read_processed(spark, processed_path)
    anchor = read_anchor(spark, processed_path)
    out: dict[str, str] = {}

    def save(name: str, frame: DataFrame, single_file: bool = True) -> str:
        path = f"{results_path.rstrip('/')}/{name}"
        write_result_csv(frame, path, single_file=single_file)
        out[name] = path
        return path

    def shared(name: str, frame: DataFrame) -> DataFrame:
        path = f"{results_path.rstrip('/')}/_{name}"
        frame.write.mode("overwrite").parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    # Per-commodity statistics: one scan feeds Q1, Q5 and Q3's top-k list.
    stats = shared("commodity_stats", summaries.commodity_stats(df))
    top = save("top_commodities", summaries.top_commodities(stats, cfg))
    vol = save("price_volatility", summaries.price_volatility(stats, cfg))
    save("monthly_price_by_commodity", trends.monthly_price_by_commodity(df, cfg, stats=stats, anchor=anchor))
    trend = save("monthly_price_trend", trends.monthly_price_trend(df, cfg, anchor=anchor))
    spread = save("market_inefficiency", summaries.market_inefficiency(df, cfg))
    save("dataset_profile", summaries.dataset_profile(df))

    # Daily averages: shared by the price shocks and, where it is asked for, the national average per row.
    daily = shared("daily_prices", arbitrage.daily_prices(df))
    save("price_shocks", shocks.price_shocks(df, cfg, daily=daily), single_file=False)

    # Shared state summary: Q4 and its feeds come from the written Q8 table.
    summary = save("all_states_summary", summaries.all_states_summary(df))
    states = read_result_csv(spark, summary, schema=STATE_SUMMARY_SCHEMA)
    top_states = states.orderBy(F.desc("price_index_sum"), F.asc("state")).limit(cfg.top_states_k)
    save("top_states", top_states)

    signal = shared("arbitrage_signal", arbitrage.arbitrage_signal(df, cfg))
    save("arbitrage_signal", signal)

    # What each chart draws.
    save("price_trend_feed", feeds.price_trend_feed(read_result_csv(spark, trend)))
    save("top_commodities_feed", feeds.top_commodities_feed(read_result_csv(spark, top)))
    save("state_labels", feeds.state_labels(top_states))
    save("state_activity_long", feeds.state_activity_long(top_states))
    save("volatility_feed", feeds.volatility_feed(read_result_csv(spark, vol)))
    save("inefficiency_feed", feeds.inefficiency_feed(read_result_csv(spark, spread)))
    save("arbitrage_matrix", feeds.arbitrage_matrix(signal))

    if msp_pairs is not None:
        m = msp.msp_frame(spark, msp_pairs)
        save("msp_violations", msp.msp_violations(df, m), single_file=False)
        save("msp_compliance_monthly", msp.msp_compliance_monthly(df, m), single_file=False)

    if geojson_path:
        out.update(run_region_map(spark, results_path, geojson_path))
    return out


def run_region_map(spark: SparkSession, results_path: str, geojson_path: str) -> dict[str, str]:
    """The regional map (V7) from written results: the state summary, or the top states where that is absent."""
    base = results_path.rstrip("/")
    states = read_result_csv(spark, f"{base}/all_states_summary", f"{base}/top_states", schema=STATE_SUMMARY_SCHEMA)
    if states is None:
        raise FileNotFoundError(f"neither all_states_summary nor top_states is under {base}")
    regs = region_names(spark, geojson_path)
    renamed = regions.region_rename(states, regions.region_map_frame(spark), regs)
    frames = {
        "region_rename": renamed,
        "unmatched_regions": regions.unmatched_regions(renamed, regs),
        "region_summary": regions.region_summary(renamed, regs),
    }
    for name, frame in frames.items():
        write_result_csv(frame, f"{base}/{name}", single_file=True)
    return {name: f"{base}/{name}" for name in frames}


def run_sql(spark: SparkSession, processed_path: str, query: str, out: str) -> None:
    """One SQL query over the processed table, registered as the view ``price_records``; the result as CSV.

    The functions of :mod:`pricelake.plans.sqlfunctions` are there too.
    """
    register_view(read_processed(spark, processed_path))
    register_functions(spark)
    write_result_csv(spark.sql(query), out)
