import contextlib
import datetime as dt
import io
import random
import statistics

from pyspark.sql import functions as F

from pricelake.operators import arbitrage, summaries, trends
from pricelake.schema import CLEAN_SCHEMA, Config

CFG = Config(min_year=2013, max_year=2025)


def clean_frame(spark, rows):
    """rows: (state, market, commodity, date, min, max, modal)."""
    full = [
        (s, "d", m, c, "v", "g", d, mn, mx, md, d.year, d.month)
        for (s, m, c, d, mn, mx, md) in rows
    ]
    return spark.createDataFrame(full, CLEAN_SCHEMA)


D = dt.date


def test_top_commodities_tie_break_and_rounding(spark):
    rows = [
        ("A", "m1", "Rice", D(2020, 1, 1), 1.0, 2.0, 1.005),
        ("A", "m1", "Rice", D(2020, 1, 2), 1.0, 2.0, 1.005),
        ("A", "m1", "Wheat", D(2020, 1, 1), 1.0, 2.0, 3.0),
        ("A", "m1", "Wheat", D(2020, 1, 2), 1.0, 2.0, 5.0),
        ("A", "m1", "Bajra", D(2020, 1, 1), 1.0, 2.0, 3.0),
    ]
    out = summaries.top_commodities(clean_frame(spark, rows), CFG, k=2).collect()
    assert [r.commodity for r in out] == ["Rice", "Wheat"]
    assert out[0].avg_modal_price == 1.01  # half-up on the decimal value
    assert out[1].avg_modal_price == 4.0


def test_state_summary_distincts_and_topk(spark):
    rows = [
        ("A", "m1", "Rice", D(2020, 1, 1), 1.0, 2.0, 10.0),
        ("A", "m2", "Rice", D(2020, 1, 1), 1.0, 2.0, 10.0),
        ("A", "m2", "Wheat", D(2020, 1, 1), 1.0, 2.0, 10.4),
        ("B", "m3", "Rice", D(2020, 1, 1), 1.0, 2.0, 5.0),
        (None, "m4", "Rice", D(2020, 1, 1), 1.0, 2.0, 100.0),
    ]
    df = clean_frame(spark, rows)
    full = summaries.all_states_summary(df).collect()
    assert [r.state for r in full] == ["A", "B"]
    a = full[0]
    assert (a.record_count, a.unique_markets, a.unique_commodities, a.price_index_sum) == (3, 2, 2, 30.0)
    assert [r.state for r in summaries.top_states(df, CFG, k=1).collect()] == ["A"]


def test_volatility_single_row_is_zero(spark):
    rows = [
        ("A", "m1", "Rice", D(2020, 1, 1), 1.0, 2.0, 10.0),
        ("A", "m1", "Gram", D(2020, 1, 1), 1.0, 2.0, 10.0),
        ("A", "m1", "Gram", D(2020, 1, 2), 1.0, 2.0, 20.0),
    ]
    out = {r.commodity: r for r in summaries.price_volatility(clean_frame(spark, rows), CFG).collect()}
    assert out["Rice"].stddev_modal_price == 0.0 and out["Rice"].coeff_variation_pct == 0.0
    sd = statistics.stdev([10.0, 20.0])
    assert out["Gram"].stddev_modal_price == round(sd, 2)
    assert out["Gram"].coeff_variation_pct == round(sd / 15.0 * 100, 2)


def test_market_inefficiency_mean_of_ratios(spark):
    rows = [
        (None, "m1", "Rice", D(2020, 1, 1), 10.0, 20.0, 10.0),
        (None, "m1", "Rice", D(2020, 1, 2), 10.0, 20.0, 40.0),
    ]
    out = summaries.market_inefficiency(clean_frame(spark, rows), CFG).collect()
    assert len(out) == 1 and out[0].state is None
    assert out[0].avg_spread_pct == 62.5  # mean(100, 25), not 10/25*100
    assert out[0].avg_price_spread == 10.0


def test_trailing_window_is_inclusive_and_13_months(spark):
    rows = [
        ("A", "m", "Rice", D(2020, 3, 31), 1.0, 2.0, 1.0),
        ("A", "m", "Rice", D(2019, 3, 31), 1.0, 2.0, 2.0),
        ("A", "m", "Rice", D(2019, 3, 30), 1.0, 2.0, 3.0),
        ("A", "m", "Rice", D(2018, 1, 1), 1.0, 2.0, 4.0),
    ]
    df = clean_frame(spark, rows)
    assert sorted(r.modal_price for r in trends.trailing_window(df, CFG).collect()) == [1.0, 2.0]
    trend = trends.monthly_price_trend(df, CFG).collect()
    assert [r.year_month for r in trend] == ["2019-03", "2020-03"]


def test_monthly_by_commodity_uses_all_time_top(spark):
    rows = [("A", "m", "Old", D(2015, 1, d), 1.0, 2.0, 1.0) for d in range(1, 10)]
    rows += [("A", "m", "New", D(2020, 1, 1), 1.0, 2.0, 5.0), ("A", "m", "Old", D(2020, 1, 2), 1.0, 2.0, 7.0)]
    out = trends.monthly_price_by_commodity(clean_frame(spark, rows), Config(top_commodities_k=1)).collect()
    assert [(r.commodity, r.year_month, r.record_count) for r in out] == [("Old", "2020-01", 1)]


def _brute_arbitrage(rows):
    """Per-row national average and deviation, as the definition states."""
    groups = {}
    for s, m, c, d, mn, mx, md in rows:
        groups.setdefault((c, d), []).append(md)
    per = {}
    for s, m, c, d, mn, mx, md in rows:
        nat = sum(groups[(c, d)]) / len(groups[(c, d)])
        dev = (md - nat) / nat * 100
        per.setdefault((s, c), []).append((md, nat, dev))
    out = {}
    for key, vals in per.items():
        n = len(vals)
        out[key] = (
            n,
            sum(v[0] for v in vals) / n,
            sum(v[1] for v in vals) / n,
            sum(v[2] for v in vals) / n,
            max(v[2] for v in vals),
        )
    return out


def test_arbitrage_matches_per_row_definition_under_skew(spark):
    rnd = random.Random(7)
    rows = []
    # One (commodity, day) holds most rows, spread over a few states.
    for i in range(600):
        rows.append((rnd.choice("ABC"), f"m{i % 7}", "Hot", D(2020, 1, 1), 1.0, 1e5, float(rnd.randint(50, 150))))
    for i in range(300):
        rows.append((rnd.choice("ABCDE"), "m", rnd.choice(["Rice", "Gram"]), D(2020, 1, 1 + i % 20), 1.0, 1e5, float(rnd.randint(10, 99))))
    got = {(r.state, r.commodity): r for r in arbitrage.arbitrage_signal(clean_frame(spark, rows), CFG, k=0).collect()}
    want = _brute_arbitrage(rows)
    assert set(got) == set(want)
    for key, (n, sp, npr, dev, mxdev) in want.items():
        r = got[key]
        assert r.record_count == n
        assert abs(r.avg_state_price - sp) <= 0.0051
        assert abs(r.avg_national_price - npr) <= 0.0051
        assert abs(r.avg_deviation_pct - dev) <= 0.0051
        assert abs(r.max_deviation_pct - mxdev) <= 0.0051


def test_national_average_rows(spark):
    rows = [
        ("A", "m", "Rice", D(2020, 1, 1), 1.0, 2.0, 10.0),
        ("B", "m", "Rice", D(2020, 1, 1), 1.0, 2.0, 30.0),
        ("B", "m", "Rice", D(2020, 1, 2), 1.0, 2.0, 7.0),
    ]
    out = {(r.state, r.arrival_date): r for r in arbitrage.national_average(clean_frame(spark, rows)).collect()}
    assert out[("A", D(2020, 1, 1))].national_avg == 20.0
    assert out[("A", D(2020, 1, 1))].deviation_pct == -50.0
    assert out[("B", D(2020, 1, 2))].deviation_pct == 0.0


def test_dataset_profile_counts_null_as_value(spark):
    rows = [
        ("A", "m", "Rice", D(2020, 1, 1), 1.0, 2.0, 10.0),
        (None, "m", "Rice", D(2021, 1, 1), 1.0, 2.0, 10.0),
    ]
    p = summaries.dataset_profile(clean_frame(spark, rows)).collect()[0]
    assert (p.total_records, p.unique_states, p.unique_markets, p.unique_commodities) == (2, 2, 1, 1)
    assert (p.min_arrival_date, p.max_arrival_date) == (D(2020, 1, 1), D(2021, 1, 1))


def test_trailing_window_prunes_year_partitions(spark, tmp_dir):
    from pricelake.sources.parquet import read_processed, write_processed

    rows = [("A", "m", "Rice", D(y, 6, 1), 1.0, 2.0, 1.0) for y in range(2014, 2021)]
    write_processed(clean_frame(spark, rows), tmp_dir)
    df = read_processed(spark, tmp_dir)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        trends.trailing_window(df, CFG).explain("formatted")
    assert "PartitionFilters: [isnotnull(year" in buf.getvalue() and ">= year(Subquery" in buf.getvalue()
    assert trends.trailing_window(df, CFG).count() == 2
    assert df.filter(F.col("state").isNull()).count() == 0


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_skew_safe_plan_shapes(spark):
    rows = [("A", "m", "Rice", D(2020, 1, 1 + i % 5), 1.0, 2.0, float(i + 1)) for i in range(20)]
    df = clean_frame(spark, rows)
    # Arbitrage: the national-average window runs over (state, commodity, day) aggregates, not rows.
    plan = _plan(arbitrage.arbitrage_signal(df, CFG))
    window_at = plan.index("Window [")
    assert "HashAggregate" in plan[window_at:]
    # Top-k commodities reach the fact side only as a broadcast semi-join of at most k rows.
    plan = _plan(trends.monthly_price_by_commodity(df, CFG))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "TakeOrderedAndProject" in plan
    # Processed write: rebalance on the partition columns (AQE splits a hot state).
    from pricelake.sources.parquet import PARTITION_COLUMNS, SORT_COLUMNS

    laid = df.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS, *SORT_COLUMNS)
    assert "RebalancePartitions" in laid._jdf.queryExecution().analyzed().toString()


def test_hot_day_of_the_national_average_is_split(spark, tmp_dir):
    """With the daily table written, AQE splits a (commodity, day) that holds 90 % of the rows."""
    rows = spark.range(60_000).select(
        F.lit("A").alias("state"), F.lit("m").alias("market"),
        F.when(F.col("id") % 10 > 0, F.lit("Hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("commodity"),
        F.lit(D(2020, 1, 1)).alias("arrival_date"), (F.col("id") % 97 + 1).cast("double").alias("modal_price"),
        F.sha2(F.col("id").cast("string"), 256).alias("district"),
    )
    rows.repartition(8).write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    arbitrage.daily_prices(rows).write.parquet(f"{tmp_dir}/daily")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = arbitrage.national_average(rows, spark.read.parquet(f"{tmp_dir}/daily"))
        out.collect()
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            out.explain()
        assert "skew=true" in text.getvalue()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_profile_of_an_empty_table(spark):
    assert tuple(summaries.dataset_profile(clean_frame(spark, [])).first()) == (0, None, None, 0, 0, 0)


def test_round_half_up_does_not_hide_a_value(spark):
    import pytest

    from pricelake.functions import round_half_up

    with pytest.raises(Exception):
        spark.range(1).select(round_half_up(F.lit(1e30))).collect()


def test_anchor_replaces_the_scan_for_the_latest_date(spark):
    rows = [("A", "m", "Rice", D(y, 3, 31), 1.0, 2.0, 1.5) for y in (2018, 2019, 2020)]
    df = clean_frame(spark, rows)
    with_anchor = trends.trailing_window(df, CFG, anchor=D(2020, 3, 31))
    assert sorted(r.arrival_date for r in with_anchor.collect()) == sorted(r.arrival_date for r in trends.trailing_window(df, CFG).collect())
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        with_anchor.explain()
    assert "Subquery" not in text.getvalue()


def test_every_ordered_result_comes_in_order(spark):
    rnd = random.Random(4)
    rows = [
        (rnd.choice("ABCDE"), rnd.choice("mno"), rnd.choice(["Rice", "Gram", "Tur", "Bajra"]), D(2020, rnd.randint(1, 12), rnd.randint(1, 28)), 1.0, 9.0, float(rnd.randint(1, 8)))
        for _ in range(400)
    ]
    df = clean_frame(spark, rows)

    def check(frame, key):
        got = [key(r) for r in frame.collect()]
        assert len(got) > 1 and got == sorted(got)

    check(summaries.top_commodities(df, CFG), lambda r: (-r.record_count, r.commodity))
    check(summaries.top_states(df, CFG), lambda r: (-r.price_index_sum, r.state))
    check(summaries.all_states_summary(df), lambda r: (-r.price_index_sum, r.state))
    check(summaries.price_volatility(df, CFG), lambda r: (-r.stddev_modal_price, r.commodity))
    check(summaries.market_inefficiency(df, CFG), lambda r: (-r.avg_spread_pct, r.state, r.market))
    check(arbitrage.arbitrage_signal(df, CFG), lambda r: (-r.avg_deviation_pct, r.state, r.commodity))
    check(trends.monthly_price_trend(df, CFG), lambda r: r.year_month)
    check(trends.monthly_price_by_commodity(df, CFG), lambda r: (r.commodity, r.year_month))
