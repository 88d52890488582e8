import json
import os

import pytest
from conftest import raw_frame, row
from pyspark.sql import functions as F

from pricelake.operators import clean
from pricelake.schema import CLEAN_COLUMNS, Config
from pricelake.sources import csv as csv_src
from pricelake.sources import geo, inventory, pages, parquet, results

CFG = Config(min_year=2013, max_year=2025)
HEADER = "state,district,market,commodity,variety,grade,arrival_date,min_price,max_price,modal_price"


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_landing_roundtrip_keeps_padding_and_nulls(spark, tmp_dir):
    rows = [row(state="  punjab "), row(state="  ", commodity=None), row(min_price=1.0e7, max_price=2.5e7)]
    src = raw_frame(spark, rows)
    csv_src.land_raw_csv(src, tmp_dir, key=F.upper(F.trim("state")))
    assert any(d.startswith("src_state=") for d in os.listdir(tmp_dir))
    back = csv_src.read_raw_csv(spark, tmp_dir)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_malformed_rows_are_quarantined(spark, tmp_dir):
    _write(
        tmp_dir,
        "chunk_0000.csv",
        [
            HEADER,
            "Punjab,d,m,Rice,v,g,01/02/2020,10,20,15",
            "Punjab,d,m,Rice,v,g,01/02/2020,abc,20,15",
            "Punjab,d,m,Rice,v,g,01/02/2020,10,20",
            "Punjab,d,m,Rice,v,g,01/02/2020,10,20,15,x",
            " PUNJAB ,d,m,Tur (Arhar),v,g,01/02/2020,10,20,15",
        ],
    )
    scanned = csv_src.read_raw_csv_with_corrupt(spark, tmp_dir).cache()
    good, bad = csv_src.split_malformed(scanned)
    assert good.count() == 2 and bad.count() == 3
    flagged = csv_src.quarantine_view(scanned).filter("is_malformed")
    assert flagged.filter(F.col("state").isNotNull()).count() == 0
    # Every action sees the same rows, whichever columns it reads.
    assert len(csv_src.read_raw_csv(spark, tmp_dir).collect()) == 2
    assert csv_src.read_raw_csv(spark, tmp_dir).count() == 2
    assert csv_src.read_raw_csv(spark, tmp_dir).select("state").count() == 2
    audit = {r.reject_reason: r.record_count for r in clean.clean_audit(scanned, CFG).collect()}
    assert audit == {"malformed": 3, "kept": 2}
    scanned.unpersist()


def test_reordered_header_fails_instead_of_misbinding(spark, tmp_dir):
    _write(tmp_dir, "a.csv", [HEADER, "Punjab,d,m,Rice,v,g,01/02/2020,10,20,15"])
    swapped = "market,state,district,commodity,variety,grade,arrival_date,min_price,max_price,modal_price"
    _write(tmp_dir, "b.csv", [swapped, "m,Punjab,d,Rice,v,g,01/02/2020,10,20,15"])
    with pytest.raises(Exception):
        csv_src.read_raw_csv(spark, tmp_dir).collect()
    lenient = csv_src.read_raw_csv(spark, tmp_dir, enforce_schema=True).collect()
    assert {r.state for r in lenient} == {"Punjab", "m"}  # position binding mixes columns up


def test_only_csv_files_are_read(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "state=Punjab"), "chunk_0000.csv", [HEADER, "Punjab,d,m,Rice,v,g,01/02/2020,10,20,15"])
    _write(os.path.join(tmp_dir, "state=Punjab"), ".done", ["x"])
    _write(os.path.join(tmp_dir, "state=Punjab"), "notes.txt", ["x,y"])
    df = csv_src.read_raw_csv(spark, tmp_dir)
    assert df.columns == list(HEADER.split(","))
    assert df.count() == 1


def test_flatten_pages_alias_and_null_precedence(spark):
    page = {
        "total": 2,
        "records": [
            {"state": "Punjab", "arrivaldate": "01/02/2000", "min_price": None, "minprice": "7", "modal_price": "5", "extra": "x"},
            {"state": "Goa", "arrival_date": "02/02/2000", "arrivaldate": "ignored", "maxprice": "9"},
        ],
    }
    pdf = spark.createDataFrame([(json.dumps(page),)], "value string")
    out = [r.asDict() for r in pages.flatten_pages(pdf).collect()]
    assert out[0]["arrival_date"] == "01/02/2000"
    assert out[0]["min_price"] == ""  # present-but-null beats the alias
    assert out[0]["modal_price"] == "5" and out[0]["district"] == ""
    assert out[1]["arrival_date"] == "02/02/2000" and out[1]["max_price"] == "9"
    assert list(out[0]) == HEADER.split(",")


def test_processed_roundtrip_state_null_and_types(spark, tmp_dir):
    raw = raw_frame(spark, [row(), row(state="  "), row(state="007")])
    cleaned = clean.clean_records(raw, CFG)
    parquet.write_processed(cleaned, tmp_dir)
    dirs = sorted(os.listdir(tmp_dir))
    assert "year=2020" in dirs
    back = parquet.read_processed(spark, tmp_dir)
    assert back.columns == list(CLEAN_COLUMNS)
    assert dict(back.dtypes)["state"] == "string"
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, cleaned.collect()), key=repr)


def test_geojson_region_names(spark, tmp_dir):
    doc = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"NAME_0": "India", "ST_NM": " Orissa "}, "geometry": None},
            {"type": "Feature", "properties": {"NAME_0": "India", "ST_NM": "Goa"}, "geometry": None},
        ],
    }
    path = os.path.join(tmp_dir, "regions.geojson")
    with open(path, "w") as f:
        json.dump(doc, f)
    names = sorted(r.name for r in geo.region_names(spark, path).collect())
    assert names == ["Goa", "Orissa"]
    seq = os.path.join(tmp_dir, "seq")
    os.makedirs(seq)
    with open(os.path.join(seq, "f.json"), "w") as f:
        for feat in doc["features"]:
            f.write(json.dumps(feat) + "\n")
    assert sorted(r.name for r in geo.region_names(spark, seq, multiline=False).collect()) == ["Goa", "Orissa"]
    # fallback key detection
    odd = os.path.join(tmp_dir, "odd.geojson")
    with open(odd, "w") as f:
        json.dump({"features": [{"properties": {"NAME_0": "India", "st_name_x": "Goa"}}]}, f)
    assert geo.name_keys(geo.read_features(spark, odd)) == ["st_name_x"]


def test_region_names_are_decided_over_all_features(spark, tmp_dir):
    features = [
        {"properties": {"id": "1", "NAME_0": "India"}},  # the first one lacks every name
        {"properties": {"id": "2", "NAME_1": "Goa"}},
        {"properties": {"id": "3", "NAME_1": " ", "state_x": "Assam"}},
        {"properties": {"id": "4", "NAME_1": "Bihar", "state_x": "Other"}},
        {"properties": None},
    ]
    path = os.path.join(tmp_dir, "r.geojson")
    with open(path, "w") as f:
        json.dump({"features": features}, f)
    assert sorted(r.name for r in geo.region_names(spark, path).collect()) == ["Assam", "Bihar", "Goa"]
    assert tuple(geo.unnamed_features(spark, path).first()) == (5, 2)


def test_pages_that_do_not_parse_are_kept_apart(spark, tmp_dir):
    good = {"records": [{"state": "Goa"}, {"state": "Assam"}]}
    _write(tmp_dir, "a.json", [json.dumps(good, indent=2)])  # laid out over many lines
    _write(tmp_dir, "b.json", [json.dumps(good)[:-5]])
    _write(tmp_dir, "c.json", [json.dumps({"error": "limit"})])
    _write(tmp_dir, "d.json", [json.dumps({"records": []})])
    read = pages.read_pages(spark, tmp_dir)
    ok, bad = pages.split_pages(read)
    assert (ok.count(), bad.count()) == (2, 2)
    assert sorted(r.state for r in pages.flatten_pages(read).collect()) == ["Assam", "Goa"]
    _write(os.path.join(tmp_dir, "l"), "x.json", [json.dumps(good), json.dumps(good)])
    assert pages.flatten_pages(pages.read_pages(spark, os.path.join(tmp_dir, "l"), one_per_line=True)).count() == 4


def test_anchor_is_kept_beside_the_table(spark, tmp_dir):
    import datetime as dt

    path = os.path.join(tmp_dir, "t")
    assert parquet.read_anchor(spark, path) is None
    late = clean.clean_records(raw_frame(spark, [row(arrival_date="05/02/2021")]), CFG)
    early = clean.clean_records(raw_frame(spark, [row(), row(commodity=None)]), CFG)
    parquet.write_processed(late, path)
    parquet.write_processed(early, path, mode="append")
    assert parquet.read_anchor(spark, path) == dt.date(2021, 2, 5)
    assert parquet.read_processed(spark, path).count() == 2
    parquet.write_processed(early, path)
    assert parquet.read_anchor(spark, path) == dt.date(2020, 2, 1)
    parquet.write_processed(early.limit(0), path)
    assert parquet.read_anchor(spark, path) is None


def test_inventory_compare(spark, tmp_dir):
    a = os.path.join(tmp_dir, "a")
    _write(os.path.join(a, "state=Goa"), "chunk_0000.csv", [HEADER, "x"])
    _write(os.path.join(a, "state=Goa"), "chunk_0001.csv", [HEADER, "y"])
    _write(os.path.join(a, "state=Assam"), "chunk_0000.csv", [HEADER])
    b = os.path.join(tmp_dir, "b")
    _write(os.path.join(b, "state=Goa"), "chunk_0000.csv", [HEADER, "x"])
    inv_a = {r.partition: (r.files, r.bytes) for r in inventory.landing_inventory(spark, a).collect()}
    assert inv_a["state=Goa"][0] == 2 and inv_a["state=Assam"][0] == 1
    cmp = {r.partition: r.matches for r in inventory.compare_inventories(inventory.landing_inventory(spark, a), inventory.landing_inventory(spark, b)).collect()}
    assert cmp == {"state=Goa": False, "state=Assam": False}


def test_result_sink_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("Rice", 3, 1.5)], "commodity string, record_count long, avg_modal_price double")
    out = os.path.join(tmp_dir, "top")
    results.write_result_csv(df.repartition(3), out, single_file=True)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    back = results.read_result_csv(spark, out)
    assert back.collect()[0].avg_modal_price == 1.5
    assert results.read_result_csv(spark, os.path.join(tmp_dir, "missing")) is None
    assert results.read_result_csv(spark, os.path.join(tmp_dir, "missing"), fallback=out).count() == 1


def test_pages_dry_run(spark):
    pages_df = spark.createDataFrame(
        [(json.dumps({"records": []}),), (json.dumps({"records": [{"state": "Goa", "arrivaldate": "01/02/2000"}]}),)],
        "value string",
    )
    rows = pages.dry_run(pages_df).collect()
    assert len(rows) == 1 and rows[0].fields == ["arrivaldate", "state"]
    assert json.loads(rows[0].record) == {"state": "Goa", "arrivaldate": "01/02/2000"}


def test_records_that_are_none_cost_themselves_and_not_their_page(spark, tmp_dir):
    page = '{"records": [{"state": "Goa", "min_price": 15.25, "max_price": 12345678901234567890.125, "modal_price": null, "modalprice": 3, '
    page += '"arrivaldate": "01/02/2000", "grade": {"a": [1, 2]}, "variety": true, "extra": 1}, 5, [1], null, {"district": "D"}]}'
    _write(tmp_dir, "a.json", [page])
    _write(tmp_dir, "b.json", ['{"records": {}}'])
    _write(tmp_dir, "c.json", ["{broken"])
    _write(tmp_dir, "d.json", ['{"records": []}'])
    read = pages.read_pages(spark, tmp_dir)
    rows = pages.flatten_records(read).collect()
    good = [r for r in rows if r.odd is None]
    assert sorted(r.odd for r in rows if r.odd is not None) == ["5", "[1]", "null"]
    assert [(r.state, r.min_price, r.max_price, r.modal_price, r.arrival_date, r.grade, r.variety, r.market) for r in good] == [
        ("Goa", "15.25", "12345678901234567890.125", "", "01/02/2000", '{"a":[1,2]}', "true", ""),
        ("", "", "", "", "", "", "", ""),
    ]
    assert good[1].district == "D"
    assert pages.odd_pages(read).count() == 2
    assert pages.split_pages(read)[1].count() == 3  # one type for the whole list loses page a
