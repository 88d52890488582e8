import os

import pytest
from conftest import raw_frame, row

from pricelake.schema import Config
from pricelake.sources import csv as csv_src
from pricelake.operators.clean import clean_records
from pricelake.plans.process import run_process
from pricelake.sources.parquet import read_processed, write_processed
from pricelake.streaming.landing import land_batch, run_clean_stream

CFG = Config(min_year=2013, max_year=2025)


def test_available_now_ingest_is_incremental(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    out = os.path.join(tmp_dir, "processed")
    ckpt = os.path.join(tmp_dir, "ckpt")
    csv_src.land_raw_csv(raw_frame(spark, [row(), row(state="Goa"), row(commodity=None)]), os.path.join(landing, "batch1"))
    run_clean_stream(spark, landing, out, ckpt, CFG)
    assert read_processed(spark, out).count() == 2

    run_clean_stream(spark, landing, out, ckpt, CFG)  # nothing new
    assert read_processed(spark, out).count() == 2

    csv_src.land_raw_csv(raw_frame(spark, [row(state="Assam")]), os.path.join(landing, "batch2"))
    run_clean_stream(spark, landing, out, ckpt, CFG)
    back = read_processed(spark, out)
    assert back.count() == 3
    assert sorted(r.state for r in back.collect()) == ["Assam", "Goa", "Punjab"]


def _states(spark, path):
    return sorted(r.state for r in read_processed(spark, path).collect())


def test_batch_and_stream_share_one_table(spark, tmp_dir):
    first, second, out, ckpt = (os.path.join(tmp_dir, x) for x in ("first", "second", "out", "ckpt"))
    csv_src.land_raw_csv(raw_frame(spark, [row(), row(state="Goa")]), first)
    csv_src.land_raw_csv(raw_frame(spark, [row(state="Assam")]), second)
    run_process(spark, first, out, CFG)
    run_clean_stream(spark, second, out, ckpt, CFG)
    assert _states(spark, out) == ["Assam", "Goa", "Punjab"]
    run_clean_stream(spark, second, out, ckpt, CFG)
    write_processed(clean_records(raw_frame(spark, [row(state="Bihar")]), CFG), out, mode="append")
    assert _states(spark, out) == ["Assam", "Bihar", "Goa", "Punjab"]

    other, ckpt_2 = os.path.join(tmp_dir, "other"), os.path.join(tmp_dir, "ckpt2")
    run_clean_stream(spark, second, other, ckpt_2, CFG)  # the other way round
    write_processed(clean_records(raw_frame(spark, [row()]), CFG), other, mode="append")
    assert _states(spark, other) == ["Assam", "Punjab"]


def test_a_repeated_batch_adds_nothing(spark, tmp_dir):
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    csv_src.land_raw_csv(raw_frame(spark, [row(), row(state="Goa")]), os.path.join(tmp_dir, "l"))
    raw = csv_src.read_raw_csv_with_corrupt(spark, os.path.join(tmp_dir, "l"))
    audit = land_batch(raw, 0, out, ckpt, CFG)
    assert audit["raw_count"] == 2 and land_batch(raw, 0, out, ckpt, CFG) == audit
    assert _states(spark, out) == ["Goa", "Punjab"]


def test_stream_quarantines_counts_and_checks_headers(spark, tmp_dir):
    landing, out, ckpt, bad = (os.path.join(tmp_dir, x) for x in ("landing", "out", "ckpt", "bad"))
    os.makedirs(landing)
    header = "state,district,market,commodity,variety,grade,arrival_date,min_price,max_price,modal_price"
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(f"{header}\nPunjab,d,m,Rice,v,g,01/02/2020,10,20,15\nPunjab,d,m,Rice,v,g,01/02/2020,abc,20,15\n")
    audit = run_clean_stream(spark, landing, out, ckpt, CFG, quarantine=bad)
    assert (audit["raw_count"], audit["kept"], audit["malformed"]) == (2, 1, 1)
    assert "abc" in spark.read.parquet(bad).first()["_corrupt_record"]
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write(header.replace("state,district,market", "market,state,district") + "\nm,Punjab,d,Rice,v,g,01/02/2020,10,20,15\n")
    with pytest.raises(Exception):
        run_clean_stream(spark, landing, out, ckpt, CFG)
    assert _states(spark, out) == ["Punjab"]
