import json
import os

from conftest import raw_frame, row

from pricelake.cli import main as cli_main
from pricelake.constants import MSP_2024
from pricelake.plans.analyze import run_analyze
from pricelake.plans.process import run_process
from pricelake.schema import Config
from pricelake.sources import csv as csv_src
from pricelake.sources.parquet import read_processed

CFG = Config(min_year=2013, max_year=2025)


def _land(spark, path):
    rows = [
        row(),
        row(state="Goa", commodity="Tur (Arhar)", modal_price=7000.0, max_price=8000.0),
        row(state="Goa", arrival_date="02/02/2020", modal_price=12.0),
        row(commodity=None),
        row(arrival_date="31/02/2020"),
    ]
    csv_src.land_raw_csv(raw_frame(spark, rows), path)
    with open(os.path.join(path, "src_state=Punjab", "broken.csv"), "w") as f:
        f.write("state,district,market,commodity,variety,grade,arrival_date,min_price,max_price,modal_price\n")
        f.write("Punjab,d,m,Rice,v,g,01/02/2020,abc,20,15\n")


def test_process_then_analyze(spark, tmp_dir):
    landing, processed, quarantine, results = (os.path.join(tmp_dir, x) for x in ("landing", "processed", "q", "results"))
    _land(spark, landing)
    res = run_process(spark, landing, processed, CFG, quarantine_path=quarantine)
    assert res.metrics["raw_count"] == 6 and res.metrics["kept"] == 3 and res.metrics["malformed"] == 1
    assert spark.read.parquet(quarantine).count() == 1
    assert read_processed(spark, processed).count() == 3

    geo = os.path.join(tmp_dir, "r.geojson")
    with open(geo, "w") as f:
        json.dump({"features": [{"properties": {"ST_NM": "Punjab"}}, {"properties": {"ST_NM": "Orissa"}}]}, f)
    out = run_analyze(spark, processed, results, CFG, geojson_path=geo, msp_pairs=MSP_2024)
    for name in ("price_trend_feed", "top_commodities_feed", "inefficiency_feed", "top_commodities", "top_states", "arbitrage_matrix", "state_labels", "region_summary", "msp_violations"):
        assert os.path.isdir(out[name])
    top = spark.read.option("header", True).csv(out["top_states"]).collect()
    assert [r.state for r in top] == ["Goa", "Punjab"]
    unmatched = [r.state for r in spark.read.option("header", True).csv(out["unmatched_regions"]).collect()]
    assert unmatched == ["Goa"]
    msp = spark.read.option("header", True).csv(out["msp_violations"]).collect()
    assert [(r.commodity, r.violations) for r in msp] == [("Tur (arhar)", "1")]


def test_cli_process_sample_writes_elsewhere(spark, tmp_dir):
    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "processed")
    _land(spark, landing)
    assert cli_main(["--min-year", "2013", "--max-year", "2025", "process", "--raw", landing, "--out", out, "--sample", "0.5"]) == 0
    assert os.path.isdir(out + "_sample") and not os.path.exists(out)


def test_scale_conf_sizes_partitions():
    from pricelake.session import scale_conf

    small = scale_conf(10 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = scale_conf(100 << 40)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert int(scale_conf(100 << 40, 1 << 40)["spark.sql.shuffle.partitions"]) == 4096


def test_cli_pages_ingest_and_inventory(spark, tmp_dir, capsys):
    pages_dir = os.path.join(tmp_dir, "pages")
    os.makedirs(pages_dir)
    page = {"records": [
        {"state": "Goa", "district": "d", "market": "m", "commodity": "Rice", "variety": "v", "grade": "g",
         "arrivaldate": "01/02/2020", "min_price": "10", "max_price": "20", "modal_price": "15"},
        {"state": "Assam", "market": "m", "commodity": "Gram", "arrival_date": "02/02/2020",
         "min_price": "1", "max_price": "2", "modal_price": "1"},
    ]}
    with open(os.path.join(pages_dir, "page_0000.json"), "w") as f:
        f.write(json.dumps(page, indent=1) + "\n")
    with open(os.path.join(pages_dir, "page_0001.json"), "w") as f:
        f.write(json.dumps(page)[:-9])
    landing = os.path.join(tmp_dir, "landing")
    assert cli_main(["pages", "--pages", pages_dir, "--landing", landing, "--state", "Goa"]) == 0
    assert [d for d in os.listdir(landing) if d.startswith("state_partition=")] == ["state_partition=Goa"]
    capsys.readouterr()
    for landed in (1, 0):  # the second run has nothing left to do
        assert cli_main(["pages", "--pages", pages_dir, "--landing", landing]) == 0
        assert json.loads(capsys.readouterr().out) == {"partitions": landed, "rows": landed, "bad_pages": 1}
    assert csv_src.read_raw_csv(spark, landing).count() == 2
    assert spark.read.parquet(landing + "_bad_pages").count() == 1
    assert sorted(d for d in os.listdir(landing) if d.startswith("state_partition=")) == [
        "state_partition=Assam", "state_partition=Goa"]
    out, ckpt = os.path.join(tmp_dir, "processed"), os.path.join(tmp_dir, "ckpt")
    assert cli_main(["--min-year", "2013", "--max-year", "2025", "ingest", "--landing", landing, "--out", out, "--checkpoint", ckpt]) == 0
    assert sorted(r.state for r in read_processed(spark, out).collect()) == ["Assam", "Goa"]
    assert cli_main(["sql", "--processed", out, "--query", "SELECT count(*) AS n FROM price_records", "--out", out + "_sql"]) == 0
    assert spark.read.option("header", True).csv(out + "_sql").first().n == "2"


def test_cli_inventory_reports_every_partition(spark, tmp_dir, capsys):
    root, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "inv")
    for i in range(1100):
        os.makedirs(os.path.join(root, f"state=s{i}"))
        with open(os.path.join(root, f"state=s{i}", "a.csv"), "w") as f:
            f.write("x")
    assert cli_main(["inventory", "--root", root, "--out", out]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"partitions": 1100, "files": 1100, "bytes": 1100}
    assert spark.read.option("header", True).csv(out).count() == 1100
    assert cli_main(["inventory", "--root", root, "--against", os.path.join(root, "state=s1"), "--out", out]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["mismatches"] == 1099


def test_region_map_falls_back_to_top_states(spark, tmp_dir):
    from pricelake.plans.analyze import STATE_SUMMARY_SCHEMA, run_region_map
    from pricelake.sources.results import write_result_csv

    geo = os.path.join(tmp_dir, "r.geojson")
    with open(geo, "w") as f:
        json.dump({"features": [{"properties": {"ST_NM": "Punjab"}}]}, f)
    top = spark.createDataFrame([("Punjab", 3, 1.0, 3.0, 1, 1)], STATE_SUMMARY_SCHEMA)
    write_result_csv(top, os.path.join(tmp_dir, "top_states"))
    out = run_region_map(spark, tmp_dir, geo)
    assert spark.read.option("header", True).csv(out["region_summary"]).first().record_count == "3"
