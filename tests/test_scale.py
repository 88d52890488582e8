"""Plans of the test inputs: methods the JVM compiles, rows that spread over tasks, and shuffles that stay narrow."""

import datetime as dt
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from pricelake.plans import catalog
from pricelake.schema import RAW_FIELDS
from pricelake.session import application_scratch, path_exists, shuffles_dropped
from pricelake.sources import csv as csv_src
from pricelake.sources import fixtures as fx
from pricelake.sources import inventory

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"


@pytest.fixture
def tables(spark, tmp_dir):
    day = dt.datetime(1996, 1, 1)
    lines = [(i // 4, i % 3, i % 5, i % 4, 100.0 + i, 0.1, 0.05, "ANR"[i % 3], day + dt.timedelta(days=i)) for i in range(480)]
    frames = {
        "lineitem": (lines, LINES),
        "part": ([(i, f"part {i}", f"type {i}") for i in range(3)], "p_partkey long, p_name string, p_type string"),
        "supplier": ([(i, f"Supplier {i}", i) for i in range(5)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(i, f"NATION_{i}", i % 2) for i in range(5)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(i, f"REGION_{i}") for i in range(2)], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_cleaning_of_the_derived_records_is_compiled(spark, tables, static_plans, capsys):
    for df in (catalog.q_clean_records(spark, tables), catalog.q_clean_audit(spark, tables)):
        df.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000  # the JVM interprets longer methods
    assert fx.raw_records(spark, tables).count() == 480


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [catalog.q_flatten_pages, catalog.q_record_quarantine])
def test_pages_are_made_after_their_only_shuffle(spark, tables, static_plans, query):
    plan = plan_of(query(spark, tables))
    assert len(re.findall(r"Exchange hashpartitioning\(page_id", plan)) == 1
    assert plan.index("collect_list") < plan.rindex("partial_collect_list") < plan.index("Exchange hashpartitioning(page_id")
    assert len(re.findall(r"Scan parquet .*l_orderkey", plan)) == 1  # broken copies come from the same pass


def test_broken_pages_keep_every_page_and_add_copies(spark):
    texts = [f'{{"total":{n},"records":[{{"state":"{"x" * n}"}}]}}' for n in range(70)]
    both = [r["value"] for r in fx.broken_pages(spark.createDataFrame([(t,) for t in texts], "value string")).collect()]
    fifth = [t[:-3] for n, t in enumerate(texts) if (n + len(t)) % 5 == 0]
    seventh = [t for n, t in enumerate(texts) if (n + len(t)) % 7 == 0]
    assert sorted(t for t in both if "message" not in t) == sorted(texts + fifth)
    assert fifth and seventh and sum("message" in t for t in both) == len(seventh)


def test_page_files_are_compressed(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(catalog, "land_pages", lambda spark, pages, *a, **kw: seen.append(pages))
    monkeypatch.setattr(catalog.csv_src, "read_raw_csv", lambda *a: None)
    catalog.q_land_pages(spark, tables)
    names = [r["path"] for r in spark.read.format("binaryFile").load(seen[0]).select("path").collect()]
    assert names and all(n.endswith(".txt.gz") for n in names)
    assert spark.read.text(seen[0]).where("value like '{\"total\":%'").count() >= 13  # 480 keys up to 1,193


def test_second_landing_is_dealt_over_all_tasks(spark, tables, static_plans, monkeypatch):
    landed = []
    monkeypatch.setattr(catalog.csv_src, "land_raw_csv", lambda df, *a, **kw: landed.append(df))
    monkeypatch.setattr(catalog.inventory, "content_inventory", lambda *a: spark.createDataFrame([], "partition string, files int, bytes int, lines int, content string"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        catalog.q_landing_inventory(spark, tables)
        assert landed[1]._jdf.queryExecution().toRdd().getNumPartitions() == 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def scratch_names(spark):
    root = application_scratch(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_inventory_keeps_one_compressed_landing_at_a_time(spark, tables, monkeypatch):
    land, landed, there = csv_src.land_raw_csv, [], []

    def landing(df, path, **options):
        there.append([path_exists(spark, p) for p in landed])
        land(df, path, **options)
        landed.append(path)
        names = [n for _, _, found in os.walk(path.removeprefix("file:")) for n in found if n.startswith("part-")]
        assert names and all(n.endswith(".csv.gz") for n in names)

    monkeypatch.setattr(catalog.csv_src, "land_raw_csv", landing)
    names = scratch_names(spark)
    found = catalog.q_landing_inventory(spark, tables)
    assert there == [[], [False]] and not path_exists(spark, landed[1])
    assert {n.split("-")[0] for n in scratch_names(spark) - names} == {"inventory"}
    rows = {r["partition"].removeprefix("src_state="): (r["lines_before"], r["lines_after"], r["status"]) for r in found.collect()}
    raw = fx.raw_with_key(spark, tables).withColumn("s", F.coalesce(fx.landing_key(), F.lit("__HIVE_DEFAULT_PARTITION__")))
    counts = {r["s"]: (r["n"], r["n"] + r["thirds"]) for r in raw.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("k") % 3 == 0).alias("thirds")).collect()}
    want = {s: (n, n, "equal") for s, (n, _) in counts.items()}
    want |= {"NATION_1": (counts["NATION_1"][0], None, "missing"), "NATION_2": (*counts["NATION_2"], "grown")}
    want |= {"NATION_3": (counts["NATION_3"][0],) * 2 + ("changed",), "NATION_X": (None, counts["NATION_4"][0], "extra")}
    assert rows == want


def test_second_landing_is_shuffled_once(spark, tables, monkeypatch):
    land, plans = csv_src.land_raw_csv, []

    def landing(df, path, key=None, dealt=False, **options):
        rows = df.select(*RAW_FIELDS, key.alias("src_state"))
        plans.append(plan_of(rows if dealt else rows.hint("rebalance", "src_state")))
        land(df, path, key=key, dealt=dealt, **options)

    monkeypatch.setattr(catalog.csv_src, "land_raw_csv", landing)
    catalog.q_landing_inventory(spark, tables)
    assert [p.count("Exchange hashpartitioning(") for p in plans] == [1, 1]


def test_shuffle_files_go_with_their_action(spark):
    def files():
        return set(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(";").split(";"))

    def made():
        before = files()
        assert len(spark.range(1000).repartition("id").collect()) == 1000
        until = time.time() + 10
        while (left := {f for f in files() - before if "shuffle_" in f}) and time.time() < until:
            time.sleep(0.1)
        return left

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    with shuffles_dropped(spark):
        assert not made()
    assert spark.conf.get(name) == setting


def test_compressed_landing_has_the_same_contents(spark, tables, tmp_dir):
    raw, plain, packed = fx.raw_with_key(spark, tables), f"{tmp_dir}/plain", f"{tmp_dir}/packed"
    csv_src.land_raw_csv(raw.withColumn("state", F.concat("state", F.lit(" a/b"))), plain, key=F.col("state"))
    dealt = raw.withColumn("state", F.concat("state", F.lit(" a/b"))).hint("rebalance", "state", "grade")
    csv_src.land_raw_csv(dealt, packed, key=F.col("state"), compression="gzip", dealt=True)
    sides = inventory.content_inventory(spark, plain), inventory.content_inventory(spark, packed, "*.csv.gz")
    found = inventory.compare_contents(*sides).collect()
    assert {r["status"] for r in found} == {"equal"} and sum(r["lines_after"] for r in found) == 480
    want = sorted(map(repr, csv_src.read_raw_csv(spark, plain).collect()))
    assert sorted(map(repr, csv_src.read_raw_csv(spark, packed, glob="*.csv.gz").collect())) == want


def test_a_share_of_the_keys_is_taken_before_the_joins(spark, tables, static_plans):
    shares = [fx.raw_with_key(spark, tables, share=(i, 3)) for i in range(3)]
    plan = plan_of(shares[1])
    assert plan.rindex("% 3") > plan.rindex("HashJoin [")  # printed from the top
    every = sorted(map(repr, fx.raw_with_key(spark, tables).collect()))
    assert sorted(repr(r) for s in shares for r in s.collect()) == every
