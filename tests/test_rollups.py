"""Mergeable states, look-ups, mixed headers, content inventory and SQL functions."""

import math
import os
import statistics

import pytest
from conftest import raw_frame, row
from test_ingest import measured

from pricelake.operators import lookup, rollups, summaries
from pricelake.operators.clean import clean_records
from pricelake.plans import sqlfunctions
from pricelake.schema import RAW_FIELDS, Config
from pricelake.sources import csv as csv_src
from pricelake.sources import headers, inventory, parquet

CFG = Config(min_year=2013, max_year=2025)
HEADER = ",".join(RAW_FIELDS)


def cleaned(spark, rows):
    return clean_records(raw_frame(spark, rows), CFG)


def batch(i, n=6):
    states, markets, goods = ["Goa", "Assam", "  ", "Bihar"], [f"m{k}" for k in range(9)], ["Rice", "Gram", "Tur"]
    return [
        row(state=states[(i + k) % 4], market=markets[(i * k) % 9], commodity=goods[(i + 2 * k) % 3], arrival_date=f"{1 + k:02d}/0{1 + i}/2020",
            min_price=1.0, max_price=10.0**6, modal_price=1000.0 + 7.25 * k + 100 * i)
        for k in range(n)
    ]


def same(spark, path, states):
    """The merged answers equal those over the whole table."""
    table = parquet.read_processed(spark, path)

    def equal(got, want):
        rows = [[r.asDict() for r in df.collect()] for df in (got, want)]
        assert len(rows[0]) == len(rows[1])
        for g, w in zip(*(sorted(r, key=lambda x: repr(x.get("state", x.get("commodity")))) for r in rows), strict=True):
            assert g.keys() == w.keys()
            for k in w:
                assert g[k] == w[k] or (isinstance(w[k], float) and math.isclose(g[k], w[k], rel_tol=1e-12)), (k, g[k], w[k])

    equal(rollups.merged_state_summary(spark, path, states), summaries.all_states_summary(table))
    equal(rollups.merged_profile(spark, path, states), summaries.dataset_profile(table))
    equal(rollups.merged_commodity_stats(spark, path, states).select(*summaries.commodity_stats(table).columns), summaries.commodity_stats(table))


def test_states_follow_appends_replacements_and_overwrites(spark, tmp_dir):
    path, states = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    parquet.write_processed(cleaned(spark, batch(0)), path)
    assert rollups.refresh(spark, path, states) == rollups.Refreshed(1, 6)
    for i in (1, 2, 3):
        parquet.write_processed(cleaned(spark, batch(i, 4)), path, mode="append", batch=f"b{i}")
        assert rollups.refresh(spark, path, states) == rollups.Refreshed(1, 4)  # the new batch's rows only
    assert rollups.refresh(spark, path, states) == rollups.Refreshed(0, 0)
    same(spark, path, states)
    parquet.write_processed(cleaned(spark, batch(2, 4)[:4]), path, mode="append", batch="b2")
    assert rollups.refresh(spark, path, states).batches == 1
    same(spark, path, states)
    parquet.write_processed(cleaned(spark, batch(5, 3)), path)  # the whole table
    rollups.refresh(spark, path, states)
    same(spark, path, states)


def test_only_the_new_batches_folders_are_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    parquet.write_processed(cleaned(spark, batch(0)), path)
    parquet.write_processed(cleaned(spark, batch(1, 2)), path, mode="append", batch="b1")
    rows = rollups.new_rows(spark, path, ["b1"], ["base", "b1"])
    assert len(rows.collect()) == 2
    assert measured(rows, "numOutputRows", "modal_price") == [2]


def test_a_refresh_that_died_is_repeated(spark, tmp_dir, monkeypatch):
    path, states = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    parquet.write_processed(cleaned(spark, batch(0)), path)
    rollups.refresh(spark, path, states)
    parquet.write_processed(cleaned(spark, batch(1)), path, mode="append")
    for step in ("value_states", "state_states"):
        with monkeypatch.context() as m:
            m.setattr(rollups, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                rollups.refresh(spark, path, states)
    assert rollups.refresh(spark, path, states) == rollups.Refreshed(1, 6)
    same(spark, path, states)
    names = spark.read.parquet(f"{states}/names")
    assert names.count() == names.select("id").distinct().count() == names.select("kind", "value").distinct().count()


def test_a_table_without_a_log_and_an_empty_one(spark, tmp_dir):
    path, states = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    rows = cleaned(spark, batch(0)).selectExpr("*", "'x' as ingest_batch")
    rows.write.partitionBy("year", "state", "ingest_batch").parquet(path)
    rollups.refresh(spark, path, states)
    parquet.write_processed(cleaned(spark, batch(1)), path, mode="append")
    rollups.refresh(spark, path, states)
    same(spark, path, states)
    empty = os.path.join(tmp_dir, "e")
    parquet.write_processed(cleaned(spark, batch(0)).limit(0), empty)
    rollups.refresh(spark, empty, f"{empty}-s")
    same(spark, empty, f"{empty}-s")


def test_moments_merge_far_from_zero(spark, tmp_dir):
    """Chan's formula keeps a small spread of large prices, where sums of squares would not."""
    path, states = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "s")
    prices = [1e9 + 0.25 * k for k in range(12)]
    for i in range(4):
        rows = [row(modal_price=p, min_price=1.0, max_price=1e10) for p in prices[3 * i : 3 * i + 3]]
        parquet.write_processed(cleaned(spark, rows), path, mode="append")
        rollups.refresh(spark, path, states)
    got = rollups.merged_commodity_stats(spark, path, states).first()
    assert math.isclose(got.pos_sd, statistics.stdev(prices), rel_tol=1e-9)


# ----------------------------------------------------------------------------- look-ups


def test_lookup_reads_a_small_part_of_a_clustered_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(300_000).selectExpr(
        "'Goa' as state", "'d' as district", "concat('Market ', pmod(xxhash64(id), 997)) as market", "concat('Good ', pmod(xxhash64(id, 7), 500)) as commodity",
        "'v' as variety", "'g' as grade", "date'2020-01-01' as arrival_date", "1D as min_price", "9D as max_price", "cast(id as double) as modal_price",
        "2020 as year", "1 as month",
    )
    parquet.write_processed(rows, path, cluster_by=("commodity", "market"), bloom=("commodity", "market"), page_rows=2000)
    found = lookup.commodity_lookup(parquet.read_processed(spark, path), " good 17")
    got = found.collect()
    assert len(got) == rows.where("commodity = 'Good 17'").count() > 400
    (read,) = measured(found, "numOutputRows", "commodity")
    assert read < 0.05 * 300_000
    one = lookup.commodity_lookup(parquet.read_processed(spark, path), "good 17", got[0].market)
    assert {r.market for r in one.collect()} == {got[0].market}
    assert lookup.commodity_lookup(parquet.read_processed(spark, path), "no such good").count() == 0


# ----------------------------------------------------------------------------- headers


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_files_are_bound_by_their_own_header(spark, tmp_dir):
    put(tmp_dir, "a.csv", [HEADER, "Goa,d,m,Rice,v,g,01/02/2020,1,3,2", "", 'Goa,d,"m, 2",Rice,v,g,01/02/2020,1,3,2.5'])
    put(tmp_dir, "b.csv", [HEADER, "Goa,d,m,Tur,v,g,01/02/2020,1,3,abc", "Goa,d,m,Tur", "Goa,d,m,Tur,v,g,01/02/2020,1,3,2,9", HEADER])
    put(os.path.join(tmp_dir, "state=Assam"), "c.csv", ["modal_price, Note,State,DISTRICT,market,commodity,variety,grade,arrival_date,min_price,max_price", "7,x,Assam,d,,Gram,v,g,01/02/2020,1,3", "7,x,Assam"])
    put(tmp_dir, "d.csv", ["﻿" + HEADER.replace("state,district", "district,state"), "d,Goa,m,Jute,v,g,01/02/2020,1,3,2"])
    put(tmp_dir, "e.csv", [HEADER.replace("commodity", "crop"), "Goa,d,m,Rice,v,g,01/02/2020,1,3,2"])
    put(tmp_dir, "f.csv", [HEADER + ",state", "Goa,d,m,Rice,v,g,01/02/2020,1,3,2,Goa"])
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    good, apart = headers.read_mixed_headers(spark, tmp_dir)
    assert good.dtypes == spark.createDataFrame([], csv_src.RAW_SCHEMA).dtypes
    got = sorted((r.state, r.district, r.market, r.commodity, r.modal_price) for r in good.na.fill("-").collect())
    assert got == [("Assam", "d", "-", "Gram", 7.0), ("Goa", "d", "m", "Jute", 2.0), ("Goa", "d", "m", "Rice", 2.0), ("Goa", "d", "m, 2", "Rice", 2.5)]
    assert sorted((os.path.basename(r.path), r.reason) for r in apart.collect()) == [
        ("b.csv", "malformed_line"), ("b.csv", "malformed_line"), ("b.csv", "malformed_line"), ("c.csv", "malformed_line"),
        ("e.csv", "unknown_header"), ("f.csv", "unknown_header"),
    ]
    report = {r.reason: (r.lines, r.files) for r in headers.header_report(apart).collect()}
    assert report == {"malformed_line": (4, 2), "unknown_header": (2, 2)}


def test_headers_of_a_landing_without_any_good_one(spark, tmp_dir):
    put(tmp_dir, "a.csv", ["x,y", "1,2"])
    good, apart = headers.read_mixed_headers(spark, tmp_dir)
    assert good.count() == 0 and [r.line for r in apart.collect()] == ["1,2"]


def test_equal_to_the_reader_by_position_where_headers_are_usual(spark, tmp_dir):
    rows = [row(), row(state="  "), row(commodity=None), row(market='a "b" c, d'), row(modal_price=None), row(grade="")]
    csv_src.land_raw_csv(raw_frame(spark, rows), tmp_dir)
    want = sorted(map(repr, csv_src.read_raw_csv(spark, tmp_dir).collect()))
    assert sorted(map(repr, headers.read_mixed_headers(spark, tmp_dir)[0].collect())) == want


# ----------------------------------------------------------------------------- inventory by content


def test_contents_tell_changed_partitions_of_equal_size(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    for root in (a, b):
        put(os.path.join(root, "state=Same"), "x.csv", [HEADER, "1", "2", "2"] if root == a else [HEADER, "2", "1"])
    put(os.path.join(b, "state=Same"), "y.csv", [HEADER, "2"])  # dealt to two files, in another order
    put(os.path.join(a, "state=Changed"), "x.csv", [HEADER, "1", "2"])
    put(os.path.join(b, "state=Changed"), "x.csv", [HEADER, "1", "3"])
    put(os.path.join(a, "state=Twice"), "x.csv", [HEADER, "1", "1"])
    put(os.path.join(b, "state=Twice"), "x.csv", [HEADER, "2", "2"])
    put(os.path.join(a, "state=Gone"), "x.csv", [HEADER, "1"])
    put(os.path.join(b, "state=New"), "x.csv", [HEADER, "1"])
    put(os.path.join(a, "state=More"), "x.csv", [HEADER, "1"])
    put(os.path.join(b, "state=More"), "x.csv", [HEADER, "1", "1"])
    put(os.path.join(a, "state=Bare"), "x.csv", [HEADER])
    put(os.path.join(b, "state=Bare"), "x.csv", [HEADER])
    found = inventory.compare_contents(inventory.content_inventory(spark, a), inventory.content_inventory(spark, b))
    assert {r.partition.split("=")[1]: r.status for r in found.collect()} == {
        "Same": "equal", "Changed": "changed", "Twice": "changed", "Gone": "missing", "New": "extra", "More": "grown", "Bare": "equal",
    }


# ----------------------------------------------------------------------------- SQL functions


def test_functions_take_parameters_and_mix_with_sql(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    parquet.write_processed(cleaned(spark, batch(0) + batch(3) + [row(commodity="O'Neill", state="Goa", arrival_date="01/01/2019")]), path)
    parquet.register_view(parquet.read_processed(spark, path))
    assert set(sqlfunctions.register_functions(spark)) == {"trailing_prices", "monthly_trend", "top_commodities", "arbitrage"}
    assert spark.sql("SELECT * FROM top_commodities(2)").count() == 2
    want = summaries.top_commodities(parquet.read_processed(spark, path), CFG, k=3).collect()
    assert spark.sql("SELECT * FROM top_commodities(3)").collect() == want
    assert spark.sql("""SELECT * FROM top_commodities(9) WHERE commodity = "O'neill" """).count() == 1
    assert spark.sql("SELECT count(*) AS n FROM trailing_prices(1)").first().n == 6
    assert spark.sql("SELECT count(*) AS n FROM trailing_prices(120)").first().n == 13
    joined = "SELECT t.commodity FROM top_commodities(1) t JOIN arbitrage(30) a ON a.commodity = t.commodity"
    assert spark.sql(joined).count() > 0
