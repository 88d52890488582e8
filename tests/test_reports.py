import datetime as dt
import random

import pandas as pd

from pricelake.operators import feeds, ingest, msp, regions, shocks
from pricelake.schema import CLEAN_SCHEMA, Config


def test_money_and_percent_labels(spark):
    df = spark.createDataFrame(
        [("a", 2.25e9), ("b", 1.35e6), ("c", 999999.0), ("d", 1250.0)], "state string, price_index_sum double"
    )
    got = {r.state: r.price_label for r in feeds.state_labels(df).collect()}
    assert got == {"a": "₹2.3B", "b": "₹1.4M", "c": "₹999,999", "d": "₹1,250"}
    v = spark.createDataFrame([("x", 0.25), ("y", 0.35), ("z", 12.0)], "commodity string, coeff_variation_pct double")
    labels = {r.commodity: r.cv_label for r in feeds.volatility_feed(v).collect()}
    assert labels == {"x": "0.3%", "y": "0.4%", "z": "12.0%"}


def test_legacy_metric_column(spark):
    df = spark.createDataFrame([("a", 5.0)], "state string, total_price_sum double")
    assert feeds.state_labels(df).collect()[0].price_label == "₹5"


def test_arbitrage_matrix_fills_zero(spark):
    sig = spark.createDataFrame(
        [("A", "Rice", 1.5), ("B", "Gram", -2.0), ("A", "Gram", 3.0)], "state string, commodity string, avg_deviation_pct double"
    )
    m = {r.state: r.asDict() for r in feeds.arbitrage_matrix(sig).collect()}
    assert m["B"]["Rice"] == 0.0 and m["A"]["Gram"] == 3.0
    fixed = feeds.arbitrage_matrix(sig, ["Rice", "Gram", "Wheat"])
    assert fixed.columns == ["state", "Rice", "Gram", "Wheat"]


def test_state_activity_long(spark):
    df = spark.createDataFrame([("A", 3, 4)], "state string, unique_markets long, unique_commodities long")
    got = sorted((r.metric, r.value) for r in feeds.state_activity_long(df).collect())
    assert got == [("unique_commodities", 4), ("unique_markets", 3)]


def test_region_rename_rules(spark):
    summary = spark.createDataFrame(
        [(f"Nation_{i}", 1, 1.0, 1.0, 1, 1) for i in range(25)],
        "state string, record_count long, avg_modal_price double, price_index_sum double, unique_markets long, unique_commodities long",
    )
    regs = spark.createDataFrame(
        [("Old Nation 1",), ("Old Nation 2",)] + [(f"Nation_{i}",) for i in range(23) if i not in (1, 2)], "name string"
    )
    rmap = regions.region_map_frame(
        spark, [("Nation_1", "Old Nation 1"), ("Nation_2", "Old Nation 2"), ("Nation_3", "Never Used"), ("Nation_24", "Gone")]
    )
    renamed = regions.region_rename(summary, rmap, regs)
    states = {r.state for r in renamed.collect()}
    assert {"Old Nation 1", "Old Nation 2", "Gone", "Nation_3"} <= states and "Nation_1" not in states
    assert sorted(r.state for r in regions.unmatched_regions(renamed, regs).collect()) == ["Gone", "Nation_23"]
    rs = regions.region_summary(renamed, regs)
    assert rs.count() == 23 and rs.filter("record_count IS NULL").count() == 0


def test_reference_rename_keys_are_normalised(spark):
    keys = {r.state for r in regions.region_map_frame(spark).collect()}
    assert "Jammu And Kashmir" in keys and "Odisha" in keys


def test_msp_violations(spark):
    d = dt.date(2020, 1, 1)
    rows = [
        ("A", "d", "m", "Tur (arhar)", "v", "g", d, 1.0, 2.0, 7000.0, 2020, 1),
        ("A", "d", "m", "Tur (arhar)", "v", "g", d, 1.0, 2.0, 8000.0, 2020, 1),
        ("A", "d", "m", "Rice", "v", "g", d, 1.0, 2.0, 1.0, 2020, 1),
    ]
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    out = msp.msp_violations(df, msp.msp_frame(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.commodity, r.record_count, r.violations, r.violation_pct, r.avg_shortfall) == ("Tur (arhar)", 2, 1, 50.0, 550.0)
    monthly = msp.msp_compliance_monthly(df, msp.msp_frame(spark)).collect()
    assert [(m.year_month, m.violations) for m in monthly] == [("2020-01", 1)]


def test_price_shocks_against_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(120):
        day = base + dt.timedelta(days=rnd.randint(0, 90))
        price = 100.0 + rnd.gauss(0, 3)
        if rnd.random() < 0.05:
            price *= 3
        rows.append(("A", "d", "m", rnd.choice(["Rice", "Gram"]), "v", "g", day, 1.0, 1e6, price, day.year, day.month))
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    cfg = Config(min_year=2013, max_year=2025, shock_z=2.0, shock_min_days=3)
    got = {(r.commodity, r.arrival_date): r.z_score for r in shocks.price_shocks(df, cfg).collect()}

    pdf = pd.DataFrame(rows, columns=[f.name for f in CLEAN_SCHEMA.fields])
    daily = pdf.groupby(["commodity", "arrival_date"])["modal_price"].mean()
    want = {}
    for (c, d), v in daily.items():
        prev = [x for (c2, d2), x in daily.items() if c2 == c and 1 <= (d - d2).days <= 30]
        if len(prev) < 3:
            continue
        sd = pd.Series(prev).std()
        if not sd > 0:
            continue
        z = (v - sum(prev) / len(prev)) / sd
        if abs(z) > 2.0:
            want[(c, d)] = z
    assert set(got) == set(want)
    for k, z in want.items():
        assert abs(got[k] - z) < 0.006


def test_pending_partitions_zero_rows_stay_pending(spark):
    parts = ingest.partition_frame(spark, ["Goa", "Assam", "Bihar"])
    manifest = spark.createDataFrame(
        [("Goa", 10, None), ("Assam", 0, None)], "state string, rows long, completed_at timestamp"
    )
    assert sorted(r.state for r in ingest.pending_partitions(parts, manifest).collect()) == ["Assam", "Bihar"]
    assert [r.state for r in ingest.pending_partitions(parts, manifest, require_rows=False).collect()] == ["Bihar"]
    assert ingest.partition_frame(spark, only="Punjab").count() == 1
    assert ingest.partition_frame(spark).count() == 37


def test_manifest_roundtrip_drives_pending(spark, tmp_dir):
    import os

    path = os.path.join(tmp_dir, "manifest")
    parts = ingest.partition_frame(spark, ["Goa", "Assam"])
    assert ingest.read_manifest(spark, path).count() == 0
    assert ingest.pending_partitions(parts, ingest.read_manifest(spark, path)).count() == 2
    landed = spark.createDataFrame([("Goa",), ("Goa",)], "state string")
    ingest.record_manifest(ingest.manifest_entries(landed), path)
    m = ingest.read_manifest(spark, path).collect()
    assert [(r.state, r.rows) for r in m] == [("Goa", 2)]
    assert [r.state for r in ingest.pending_partitions(parts, ingest.read_manifest(spark, path)).collect()] == ["Assam"]


def test_chart_feeds(spark):
    from pricelake.sources.parquet import register_view

    top = spark.createDataFrame([("Rice", 5, 1.0), ("Gram", 2, 3.0)], "commodity string, record_count long, avg_modal_price double")
    assert [r.commodity for r in feeds.top_commodities_feed(top).collect()] == ["Gram", "Rice"]
    trend = spark.createDataFrame([(2020, 2, "2020-02", 2.0, 1), (2020, 1, "2020-01", 1.0, 1)],
                                  "year int, month int, year_month string, avg_modal_price double, record_count long")
    assert [r.year_month for r in feeds.price_trend_feed(trend).collect()] == ["2020-01", "2020-02"]
    ineff = spark.createDataFrame([("A", "m", 1, 2.0, 3.0, 4.0)],
                                  "state string, market string, record_count long, avg_price_spread double, avg_spread_pct double, avg_modal_price double")
    assert feeds.inefficiency_feed(ineff).columns[:2] == ["state", "market"]
    register_view(top, "price_records_test")
    assert spark.sql("SELECT SUM(record_count) AS n FROM price_records_test").collect()[0].n == 7
