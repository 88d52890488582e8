"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the raw price records that Spark derives from the
test tables in ``sf_dir`` (see :mod:`pricelake.sources.fixtures`), so its work
grows with the data. As in production, the market questions read the cleaned,
partitioned Parquet table: each application writes it once per input folder
under the session's shared ``spark.checkpoint.dir`` and reuses it for its
later queries. Cleaning queries start from the raw
records; file-format queries write their own input to a fresh folder there
and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import arbitrage, clean, feeds, ingest, lookup, msp, regions, rollups, shocks, summaries, trends
from pricelake.constants import LEGACY_PRICE_INDEX_COLUMN
from pricelake.plans import sqlfunctions
from pricelake.plans.landing import land_pages
from pricelake.schema import RAW_FIELDS, Config
from pricelake.session import application_scratch, drop_paths, scratch_path, scratch_scope, shuffles_dropped, written
from pricelake.sources import csv as csv_src
from pricelake.sources import fixtures as fx
from pricelake.sources import geo, headers, inventory, results
from pricelake.sources import pages as pages_src
from pricelake.sources import parquet as pq
from pricelake.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

CFG = Config(min_year=fx.FIXTURE_MIN_YEAR, max_year=fx.FIXTURE_MAX_YEAR)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_records(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_records(_raw(spark, sf_dir), CFG)


_SOURCE_TABLES = ("lineitem", "part", "supplier", "nation", "region")
_materialized: set[str] = set()


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Source files' sizes and times (one small aggregate, no file contents) and the config."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in _SOURCE_TABLES]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    stats = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first()
    return hashlib.sha1(repr((sf_dir, tuple(stats), CFG)).encode()).hexdigest()[:16]


def materialize_processed(spark: SparkSession, sf_dir: str) -> str:
    """Write the cleaned table for ``sf_dir`` where later queries of this application look for it.

    The folder is named by the application and the source fingerprint, so
    applications never write into each other's copy and a changed source gets
    a copy of its own.
    """
    path = f"{application_scratch(spark)}/processed-{_fingerprint(spark, sf_dir)}"
    if path not in _materialized:
        pq.write_processed(_clean(spark, sf_dir), path)
        _materialized.add(path)
    return path


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table for ``sf_dir`` as partitioned Parquet, written on first use; the source is looked at on each."""
    return pq.read_processed(spark, materialize_processed(spark, sf_dir))


def _anchor(spark: SparkSession, sf_dir: str):
    return pq.read_anchor(spark, materialize_processed(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, arbitrage.daily_prices(_processed(spark, sf_dir)), "daily-prices")


def _renamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    regs = fx.regions(spark, sf_dir)
    rmap = regions.region_map_frame(spark, fx.FIXTURE_REGION_MAP)
    summary = summaries.all_states_summary(_processed(spark, sf_dir))
    return regions.region_rename(summary, rmap, regs), regs


# ----------------------------------------------------------------------------- cleaning

def q_clean_records(spark, sf_dir):
    return _clean(spark, sf_dir)


def q_clean_audit(spark, sf_dir):
    return clean.clean_audit(_raw(spark, sf_dir), CFG)


def q_audit_totals(spark, sf_dir):
    return clean.audit_totals(clean.clean_audit(_raw(spark, sf_dir), CFG))


def q_critical_filter(spark, sf_dir):
    return clean.critical_filter(_raw(spark, sf_dir))


def q_valid_prices(spark, sf_dir):
    return clean.valid_prices(_raw(spark, sf_dir))


def q_parse_dates(spark, sf_dir):
    return clean.parse_dates(_raw(spark, sf_dir), CFG.date_format)


def q_normalise_text(spark, sf_dir):
    return clean.normalise_text(_raw(spark, sf_dir))


# ----------------------------------------------------------------------------- market questions

def q_trailing_window(spark, sf_dir):
    return trends.trailing_window(_processed(spark, sf_dir), CFG, anchor=_anchor(spark, sf_dir))


def q_top_commodities(spark, sf_dir):
    return summaries.top_commodities(_processed(spark, sf_dir), CFG)


def q_monthly_price_trend(spark, sf_dir):
    return trends.monthly_price_trend(_processed(spark, sf_dir), CFG, anchor=_anchor(spark, sf_dir))


def q_monthly_price_by_commodity(spark, sf_dir):
    return trends.monthly_price_by_commodity(_processed(spark, sf_dir), CFG, anchor=_anchor(spark, sf_dir))


def q_top_states(spark, sf_dir):
    return summaries.top_states(_processed(spark, sf_dir), CFG)


def q_price_volatility(spark, sf_dir):
    return summaries.price_volatility(_processed(spark, sf_dir), CFG)


def q_market_inefficiency(spark, sf_dir):
    return summaries.market_inefficiency(_processed(spark, sf_dir), CFG)


def q_national_average(spark, sf_dir):
    from pricelake.functions import round_half_up

    rows = arbitrage.national_average(_processed(spark, sf_dir), _daily(spark, sf_dir))
    return rows.select(
        "state",
        "market",
        "commodity",
        "arrival_date",
        "modal_price",
        round_half_up("national_avg").alias("national_avg"),
        round_half_up("deviation_pct").alias("deviation_pct"),
    )


def q_arbitrage_signal(spark, sf_dir):
    return arbitrage.arbitrage_signal(_processed(spark, sf_dir), CFG)


def q_all_states_summary(spark, sf_dir):
    return summaries.all_states_summary(_processed(spark, sf_dir))


def q_dataset_profile(spark, sf_dir):
    return summaries.dataset_profile(_processed(spark, sf_dir))


# ----------------------------------------------------------------------------- regions and report feeds

def q_region_rename(spark, sf_dir):
    return _renamed(spark, sf_dir)[0]


def q_unmatched_regions(spark, sf_dir):
    renamed, regs = _renamed(spark, sf_dir)
    return regions.unmatched_regions(renamed, regs)


def q_region_summary(spark, sf_dir):
    renamed, regs = _renamed(spark, sf_dir)
    return regions.region_summary(renamed, regs)


def q_arbitrage_matrix(spark, sf_dir):
    signal = written(spark, arbitrage.arbitrage_signal(_processed(spark, sf_dir), CFG), "arbitrage-signal")
    return feeds.matrix_cells(feeds.arbitrage_matrix(signal))


def q_price_trend_feed(spark, sf_dir):
    return feeds.price_trend_feed(q_monthly_price_trend(spark, sf_dir))


def q_top_commodities_feed(spark, sf_dir):
    return feeds.top_commodities_feed(q_top_commodities(spark, sf_dir))


def q_inefficiency_feed(spark, sf_dir):
    return feeds.inefficiency_feed(q_market_inefficiency(spark, sf_dir))


def q_legacy_state_labels(spark, sf_dir):
    legacy = q_top_states(spark, sf_dir).withColumnRenamed("price_index_sum", LEGACY_PRICE_INDEX_COLUMN)
    return feeds.state_labels(legacy)


def q_result_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "result")
    results.write_result_csv(q_all_states_summary(spark, sf_dir), path)
    return results.read_result_csv(spark, f"{path}-absent", fallback=path)


def q_region_names(spark, sf_dir):
    path = scratch_path(spark, "shapes")
    fx.region_shapes(spark, sf_dir).write.text(path)
    return geo.region_names(spark, path, multiline=False)


def q_state_labels(spark, sf_dir):
    return feeds.state_labels(summaries.top_states(_processed(spark, sf_dir), CFG))


def q_state_activity_long(spark, sf_dir):
    return feeds.state_activity_long(summaries.top_states(_processed(spark, sf_dir), CFG))


def q_volatility_feed(spark, sf_dir):
    return feeds.volatility_feed(summaries.price_volatility(_processed(spark, sf_dir), CFG))


# ----------------------------------------------------------------------------- sources, sinks, landing

def _pages(spark, sf_dir):
    """Pages made from the raw records, with broken ones beside them."""
    return fx.broken_pages(fx.pages_from_records(fx.raw_with_key(spark, sf_dir)))


def q_flatten_pages(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return pages_src.flatten_pages(pages)


def q_record_quarantine(spark, sf_dir):
    """Every record of pages of which each third holds a list element that is no record, and those elements."""
    return pages_src.flatten_records(fx.broken_pages(fx.pages_from_records(fx.raw_with_key(spark, sf_dir), odd_every=3)))


def q_page_quarantine(spark, sf_dir):
    """Pages and records that parse, and pages that do not."""
    pages = written(spark, _pages(spark, sf_dir), "pages")  # read twice
    good, bad = pages_src.split_pages(pages)
    has_bad = bad.agg(F.count(F.lit(1)) > 0).scalar()
    counts = good.agg(F.count(F.lit(1)).alias("good_pages"), F.coalesce(F.sum(F.size("records")), F.lit(0)).alias("records"))
    return counts.select("*", has_bad.alias("has_bad_pages"))


def q_land_pages(spark, sf_dir):
    """Pages landed by state, one state first, then the others, then nothing left; read back as raw rows."""
    path = scratch_path(spark, "landed")
    _pages(spark, sf_dir).write.option("compression", "gzip").text(f"{path}/pages")
    for only in (fx.ONE_STATE, None, None):
        land_pages(spark, f"{path}/pages", f"{path}/landing", f"{path}/manifest", f"{path}/bad", only=only, one_per_line=True)
    return csv_src.read_raw_csv(spark, f"{path}/landing")


def q_landing_inventory(spark, sf_dir):
    """Every landed partition, compared by content with a second landing that lacks, adds and changes some.

    Only the inventory of a landing is kept: the first has left the disk when the second, dealt to other files, is written.
    """
    path, other, glob = scratch_path(spark, "listed"), scratch_path(spark, "listed-again"), "*.csv.gz"
    with shuffles_dropped(spark), scratch_scope(spark) as scratch:
        scratch += [path, other]
        keyed = written(spark, fx.raw_with_key(spark, sf_dir), "keyed", compression="zstd")
        csv_src.land_raw_csv(keyed, path, key=fx.landing_key(), compression="gzip")
        before = written(spark, inventory.content_inventory(spark, path, glob), "inventory", keep=True)
        drop_paths(spark, [path])
        # One shuffle deals the rows by state and key: those of a state go to a quarter of its tasks at most.
        deals = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
        again = fx.second_landing(keyed).withColumn("deal", F.pmod(F.xxhash64("k"), F.lit(deals))).repartition(fx.landing_key(), "deal")
        csv_src.land_raw_csv(again, other, key=fx.landing_key(), compression="gzip", dealt=True)
        after = written(spark, inventory.content_inventory(spark, other, glob), "inventory", keep=True)
    found = inventory.compare_contents(before, after)
    return found.select("partition", "lines_before", "lines_after", "status", "matches")


def _headed(keyed: DataFrame, path: str, order: list[str], **renamed: str) -> None:
    """Raw records as CSV files with their columns in ``order``, some under another name."""
    columns = [F.col(c).alias(renamed.get(c, c)) for c in order]
    keyed.select(*columns).write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def q_read_mixed_headers(spark, sf_dir):
    """A landing whose files name their columns in three orders, and some files with an unknown header; every line once."""
    keyed, path = written(spark, fx.raw_with_key(spark, sf_dir), "keyed"), scratch_path(spark, "mixed")
    part = lambda i: keyed.where(F.col("k") % 4 == i)
    _land_with_broken_lines(spark, part(0), f"{path}/usual")
    _headed(part(1), f"{path}/reversed", RAW_FIELDS[::-1])
    _headed(part(2).withColumn("note", F.lit("a, b")), f"{path}/sorted", sorted([*RAW_FIELDS, "note"]))
    _headed(part(3), f"{path}/unknown", RAW_FIELDS, commodity="crop")
    return headers.bind_by_name(spark, path).select(*RAW_FIELDS, "reason")


def q_commodity_lookup(spark, sf_dir):
    """One commodity's rows from a table clustered by commodity, with bloom filters on commodity and market."""
    path = scratch_path(spark, "clustered")
    pq.write_processed(_clean(spark, sf_dir), path, cluster_by=("commodity", "market", "arrival_date"), bloom=("commodity", "market"), page_rows=4096)
    return lookup.commodity_lookup(pq.read_processed(spark, path), fx.ONE_COMMODITY)


_rolled: dict[str, tuple[str, str]] = {}


def materialize_rollup(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A table written in four batches and its states, refreshed after each; made once per application and source."""
    mark = f"{application_scratch(spark)}/rolled-{_fingerprint(spark, sf_dir)}"
    if mark not in _rolled:
        table, states = f"{mark}/table", f"{mark}/states"
        for i in range(4):
            part = clean.clean_records(fx.raw_with_key(spark, sf_dir, share=(i, 4)).select(*RAW_FIELDS), CFG)
            pq.write_processed(part, table, mode="append" if i else "overwrite")
            rollups.refresh(spark, table, states)
        _rolled[mark] = (table, states)
    return _rolled[mark]


def q_rollup_states_summary(spark, sf_dir):
    return rollups.merged_state_summary(spark, *materialize_rollup(spark, sf_dir))


def q_rollup_profile(spark, sf_dir):
    return rollups.merged_profile(spark, *materialize_rollup(spark, sf_dir))


def q_rollup_top_commodities(spark, sf_dir):
    return summaries.top_commodities(rollups.merged_commodity_stats(spark, *materialize_rollup(spark, sf_dir)), CFG)


def q_rollup_volatility(spark, sf_dir):
    return summaries.price_volatility(rollups.merged_commodity_stats(spark, *materialize_rollup(spark, sf_dir)), CFG)


def _sql_functions(spark, sf_dir, query):
    pq.register_view(_processed(spark, sf_dir))
    sqlfunctions.register_functions(spark)
    return spark.sql(query)


def q_sql_top_commodities(spark, sf_dir):
    return _sql_functions(spark, sf_dir, f"SELECT * FROM top_commodities({CFG.top_commodities_k})")


def q_sql_monthly_trend(spark, sf_dir):
    return _sql_functions(spark, sf_dir, f"SELECT * FROM monthly_trend({CFG.trailing_months})")


def q_sql_trailing_prices(spark, sf_dir):
    return _sql_functions(spark, sf_dir, f"SELECT * FROM trailing_prices({CFG.trailing_months})")


def q_sql_arbitrage(spark, sf_dir):
    return _sql_functions(spark, sf_dir, f"SELECT * FROM arbitrage({CFG.arbitrage_k})")


def q_sql_view(spark, sf_dir):
    pq.register_view(_processed(spark, sf_dir))
    return spark.sql("SELECT state, year, count(*) AS record_count, max(modal_price) AS top_price FROM price_records GROUP BY state, year")


def q_pending_partitions(spark, sf_dir):
    landed = fx.raw_records(spark, sf_dir).select(fx.landing_key().alias("state")).filter(F.col("state").isNotNull())
    entries = written(spark, ingest.manifest_entries(landed), "partitions")  # one row per state
    manifest = entries.join(fx.done_partitions(spark, sf_dir), "state", "left_semi")
    return ingest.pending_partitions(entries.select("state", F.col("rows").alias("raw_rows")), manifest)


def q_read_raw_csv(spark, sf_dir):
    path = scratch_path(spark, "landing")
    csv_src.land_raw_csv(_raw(spark, sf_dir), path, key=fx.landing_key())
    return csv_src.read_raw_csv(spark, path)


def q_malformed_quarantine(spark, sf_dir):
    path = scratch_path(spark, "malformed")
    fx.malformed_lines(fx.raw_with_key(spark, sf_dir)).write.mode("overwrite").text(path)
    scanned = csv_src.read_raw_csv_with_corrupt(spark, path, header=False, glob="*.txt")
    return csv_src.quarantine_view(scanned)


def q_processed_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "processed")
    pq.write_processed(_clean(spark, sf_dir), path)
    return pq.read_processed(spark, path)


def _land_with_broken_lines(spark, keyed, path):
    """Raw records as headed CSV files, some lines broken (those of :func:`fx.malformed_lines`)."""
    # A line is one unquoted column here; the header option puts the field names into every file.
    lines = fx.malformed_lines(keyed).select(F.col("value").alias(",".join(RAW_FIELDS)))
    options = {"header": "true", "quote": "", "sep": "\u0001", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.write.options(**options).csv(path)
    return path


def q_stream_ingest(spark, sf_dir):
    landing_dir = _land_with_broken_lines(spark, fx.raw_with_key(spark, sf_dir), scratch_path(spark, "stream-landing"))
    out, ckpt = scratch_path(spark, "stream-processed"), scratch_path(spark, "stream-checkpoint")
    landing.run_clean_stream(spark, landing_dir, out, ckpt, CFG)
    return pq.read_processed(spark, out)


def q_batch_then_stream(spark, sf_dir):
    """Half of the records by the batch job, the others by the stream, a batch append at last: one table."""
    out, ckpt = scratch_path(spark, "both-processed"), scratch_path(spark, "both-checkpoint")
    first, second, third = (fx.raw_with_key(spark, sf_dir, share=(i, 3)) for i in range(3))
    pq.write_processed(clean.clean_records(first.select(*RAW_FIELDS), CFG), out)
    path = scratch_path(spark, "both-landing")
    csv_src.land_raw_csv(second, path, key=fx.landing_key())
    landing.run_clean_stream(spark, path, out, ckpt, CFG)
    landing.run_clean_stream(spark, path, out, ckpt, CFG)
    pq.write_processed(clean.clean_records(third.select(*RAW_FIELDS), CFG), out, mode="append")
    return pq.read_processed(spark, out)


# ----------------------------------------------------------------------------- declared purposes

def q_msp_violations(spark, sf_dir):
    return msp.msp_violations(_processed(spark, sf_dir), msp.msp_frame(spark, fx.FIXTURE_MSP))


def q_msp_compliance_monthly(spark, sf_dir):
    return msp.msp_compliance_monthly(_processed(spark, sf_dir), msp.msp_frame(spark, fx.FIXTURE_MSP))


def q_price_shocks(spark, sf_dir):
    return shocks.price_shocks(_processed(spark, sf_dir), CFG, daily=_daily(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "clean_records": q_clean_records,
    "clean_audit": q_clean_audit,
    "audit_totals": q_audit_totals,
    "critical_filter": q_critical_filter,
    "valid_prices": q_valid_prices,
    "parse_dates": q_parse_dates,
    "normalise_text": q_normalise_text,
    "trailing_window": q_trailing_window,
    "top_commodities": q_top_commodities,
    "monthly_price_trend": q_monthly_price_trend,
    "monthly_price_by_commodity": q_monthly_price_by_commodity,
    "top_states": q_top_states,
    "price_volatility": q_price_volatility,
    "market_inefficiency": q_market_inefficiency,
    "national_average": q_national_average,
    "arbitrage_signal": q_arbitrage_signal,
    "all_states_summary": q_all_states_summary,
    "dataset_profile": q_dataset_profile,
    "region_rename": q_region_rename,
    "unmatched_regions": q_unmatched_regions,
    "region_summary": q_region_summary,
    "arbitrage_matrix": q_arbitrage_matrix,
    "price_trend_feed": q_price_trend_feed,
    "top_commodities_feed": q_top_commodities_feed,
    "inefficiency_feed": q_inefficiency_feed,
    "legacy_state_labels": q_legacy_state_labels,
    "result_roundtrip": q_result_roundtrip,
    "region_names": q_region_names,
    "state_labels": q_state_labels,
    "state_activity_long": q_state_activity_long,
    "volatility_feed": q_volatility_feed,
    "flatten_pages": q_flatten_pages,
    "page_quarantine": q_page_quarantine,
    "record_quarantine": q_record_quarantine,
    "land_pages": q_land_pages,
    "landing_inventory": q_landing_inventory,
    "read_mixed_headers": q_read_mixed_headers,
    "commodity_lookup": q_commodity_lookup,
    "rollup_states_summary": q_rollup_states_summary,
    "rollup_profile": q_rollup_profile,
    "rollup_top_commodities": q_rollup_top_commodities,
    "rollup_volatility": q_rollup_volatility,
    "sql_top_commodities": q_sql_top_commodities,
    "sql_monthly_trend": q_sql_monthly_trend,
    "sql_trailing_prices": q_sql_trailing_prices,
    "sql_arbitrage": q_sql_arbitrage,
    "sql_view": q_sql_view,
    "pending_partitions": q_pending_partitions,
    "read_raw_csv": q_read_raw_csv,
    "malformed_quarantine": q_malformed_quarantine,
    "processed_roundtrip": q_processed_roundtrip,
    "stream_ingest": q_stream_ingest,
    "batch_then_stream": q_batch_then_stream,
    "msp_violations": q_msp_violations,
    "price_shocks": q_price_shocks,
    "msp_compliance_monthly": q_msp_compliance_monthly,
}
