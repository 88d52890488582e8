"""Ingest at its edges: what a rerun reads, and what a run that dies leaves behind."""

import datetime as dt
import json
import os
import time

import pytest
from conftest import raw_frame, row

from pricelake.operators.clean import clean_records
from pricelake.plans import landing
from pricelake.schema import Config
from pricelake.sources import csv as csv_src
from pricelake.sources import pages, parquet
from pricelake.streaming import landing as stream

CFG = Config(min_year=2013, max_year=2025)


def page(*states):
    return {"records": [{"state": s, "market": "m", "commodity": "Rice", "arrival_date": "01/02/2020", "modal_price": "5"} for s in states]}


def put(folder, name, text, age=0):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text if isinstance(text, str) else json.dumps(text))
    then = time.time() - age
    os.utime(path, (then, then))


def scans(node):
    """The file scans of an executed plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(node.plan())
    if name == "FileSourceScanExec":
        return [node]
    children = node.children()
    return [s for i in range(children.size()) for s in scans(children.apply(i))]


def measured(df, name, column):
    """A metric of the scans that read ``column``, after ``df`` has run."""
    found = [s for s in scans(df._jdf.queryExecution().executedPlan()) if column in s.output().mkString(",")]
    return [s.metrics().apply(name).value() for s in found]


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.pages, self.landing, self.manifest, self.bad = (os.path.join(root, x) for x in ("pages", "landing", "manifest", "bad"))

    def run(self, **kw):
        r = landing.land_pages(self.spark, self.pages, self.landing, self.manifest, self.bad, **kw)
        return r.partitions, r.rows, r.bad_pages

    def states(self):
        return sorted(r.state for r in csv_src.read_raw_csv(self.spark, self.landing).collect())


def test_a_rerun_parses_nothing_and_a_new_file_only_itself(spark, tmp_dir, monkeypatch):
    job = Landing(spark, tmp_dir)
    put(job.pages, "a b.json", page("Goa", "Assam"), age=900)
    put(job.pages, "b.json", page("Goa"), age=800)
    put(job.pages, "c.json", "{broken", age=700)
    put(job.pages, "d.json", {"records": []}, age=600)
    read = []
    inner = pages.read_pages_of
    monkeypatch.setattr(landing, "read_pages_of", lambda s, p, files, *a: read.append(sorted(os.path.basename(r.path) for r in files.collect())) or inner(s, p, files, *a))
    assert job.run() == (2, 3, 1)
    assert job.run() == (0, 0, 1)
    assert len(read) == 1 and len(read[0]) == 4  # the rerun did not open a page
    put(job.pages, "e.json", page("Bihar"))
    assert job.run() == (1, 1, 1)
    assert read[1:] == [["e.json"]]
    assert job.states() == ["Assam", "Bihar", "Goa", "Goa"]
    assert [r.value for r in landing.read_bad_pages(spark, job.bad, job.manifest + "_files").collect()] == ["{broken"]


def test_files_outside_the_new_ones_time_span_are_not_opened(spark, tmp_dir):
    for i in range(30):
        put(tmp_dir, f"p{i}.json", page("Goa"), age=10_000 - 100 * i)
    listed = pages.list_page_files(spark, tmp_dir)
    new = spark.createDataFrame(listed.collect(), listed.schema).where("path like '%p29.json'")
    got = pages.read_pages_of(spark, tmp_dir, new)
    assert len(got.collect()) == 1
    assert measured(got, "numFiles", "value") == [1]


def test_only_the_files_of_a_pending_state_are_read_again(spark, tmp_dir, monkeypatch):
    job = Landing(spark, tmp_dir)
    put(job.pages, "a.json", page("Goa", "Assam"))
    put(job.pages, "b.json", page("Goa"))
    put(job.pages, "c.json", page("Bihar"))
    assert job.run(only="Goa") == (1, 2, 0)
    read = []
    inner = pages.read_pages_of
    monkeypatch.setattr(landing, "read_pages_of", lambda s, p, files, *a: read.append(sorted(os.path.basename(r.path) for r in files.collect())) or inner(s, p, files, *a))
    assert job.run(only="Assam") == (1, 1, 0)
    assert job.run() == (1, 1, 0)
    assert read == [["a.json"], ["c.json"]]
    assert job.states() == ["Assam", "Bihar", "Goa", "Goa"]


def test_a_complete_state_is_landed_again_only_on_request(spark, tmp_dir):
    job = Landing(spark, tmp_dir)
    put(job.pages, "a.json", page("Goa"))
    assert job.run() == (1, 1, 0)
    put(job.pages, "b.json", page("Goa", "Goa"))
    assert job.run() == (0, 0, 0) and job.states() == ["Goa"]
    assert job.run(reopen=True) == (1, 3, 0) and job.states() == ["Goa"] * 3
    assert job.run(reopen=True) == (0, 0, 0)
    put(job.pages, "b.json", page("Goa", "Goa", "Goa", "Goa"))  # a changed file replaces what it held
    assert job.run(reopen=True) == (1, 5, 0) and job.states() == ["Goa"] * 5


@pytest.mark.parametrize("dies_at", ["land_raw_csv", "record_manifest", "ledger"])
def test_a_run_that_dies_is_repeated_without_loss(spark, tmp_dir, monkeypatch, dies_at):
    job = Landing(spark, tmp_dir)
    put(job.pages, "a.json", page("Goa", "Assam"))
    put(job.pages, "b.json", "[]")

    def die(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if dies_at == "ledger":  # everything is written but the ledger
            os.makedirs(job.manifest + "_files")
            os.chmod(job.manifest + "_files", 0o500)
            put(job.manifest + "_files", "_temporary", "in the way") if os.geteuid() == 0 else None
        else:
            m.setattr(landing, dies_at, die)
        with pytest.raises(Exception):
            job.run()
    if dies_at == "ledger":
        os.chmod(job.manifest + "_files", 0o700)
        if os.path.exists(job.manifest + "_files/_temporary"):
            os.remove(job.manifest + "_files/_temporary")
    job.run()
    assert job.states() == ["Assam", "Goa"] and job.run() == (0, 0, 1)
    assert landing.read_bad_pages(spark, job.bad, job.manifest + "_files").count() == 1


# ----------------------------------------------------------------------------- the table


def cleaned(spark, *dates, state="Goa"):
    return clean_records(raw_frame(spark, [row(state=state, arrival_date=d) for d in dates]), CFG)


def dates(spark, path):
    return sorted(str(r.arrival_date) for r in parquet.read_processed(spark, path).collect())


def test_a_batch_replaces_itself_and_nothing_else(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    parquet.write_processed(cleaned(spark, "01/02/2020", "02/02/2020"), path)
    for _ in range(2):
        parquet.write_processed(cleaned(spark, "03/02/2020"), path, mode="append", batch="b1")
    parquet.write_processed(cleaned(spark, "04/02/2020"), path, mode="append", batch="b2")
    assert dates(spark, path) == [f"2020-02-0{d}" for d in (1, 2, 3, 4)]
    assert parquet.read_anchor(spark, path) == dt.date(2020, 2, 4)
    parquet.write_processed(cleaned(spark, "09/02/2020"), path, dynamic_overwrite=True)
    assert dates(spark, path) == [f"2020-02-0{d}" for d in (3, 4, 9)]
    assert parquet.read_anchor(spark, path) == dt.date(2020, 2, 9)
    parquet.write_processed(cleaned(spark, "05/02/2020"), path)
    assert dates(spark, path) == ["2020-02-05"] and parquet.read_anchor(spark, path) == dt.date(2020, 2, 5)


def test_a_batch_that_died_before_its_commit_is_repeated(spark, tmp_dir, monkeypatch):
    landed, out, ckpt = (os.path.join(tmp_dir, x) for x in ("l", "t", "c"))
    csv_src.land_raw_csv(raw_frame(spark, [row(), row(state="Goa", arrival_date="05/06/2021")]), landed)
    raw = csv_src.read_raw_csv_with_corrupt(spark, landed)

    def die(*a, **k):
        raise OSError("lost")

    with monkeypatch.context() as m:  # the data is there, its audit (and so the stream's commit) is not
        m.setattr(stream, "observed_audit", die)
        with pytest.raises(OSError):
            stream.land_batch(raw, 7, out, ckpt, CFG)
    assert len(dates(spark, out)) == 2
    for _ in range(2):
        assert stream.land_batch(raw, 7, out, ckpt, CFG)["kept"] == 2
    assert dates(spark, out) == ["2020-02-01", "2021-06-05"]
    stream.land_batch(raw, 8, out, ckpt, CFG)  # another batch with equal rows is another batch
    assert len(dates(spark, out)) == 4


def test_two_streams_share_a_table(spark, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    for i, state in enumerate(["Goa", "Assam"]):
        landed = os.path.join(tmp_dir, f"l{i}")
        csv_src.land_raw_csv(raw_frame(spark, [row(state=state)]), landed)
        stream.run_clean_stream(spark, landed, out, os.path.join(tmp_dir, f"c{i}"), CFG)
    assert sorted(r.state for r in parquet.read_processed(spark, out).collect()) == ["Assam", "Goa"]
    assert parquet.read_table(spark, out).select("ingest_batch").distinct().count() == 2


def test_anchor_of_a_table_that_has_none(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    cleaned(spark, "05/06/2021").write.partitionBy("year", "state").parquet(path)  # someone else wrote it
    other = os.path.join(tmp_dir, "u")
    cleaned(spark, "05/06/2021").selectExpr("*", "'x' as ingest_batch").write.partitionBy("year", "state", "ingest_batch").parquet(other)
    assert parquet.read_anchor(spark, path) == dt.date(2021, 6, 5)
    parquet.write_processed(cleaned(spark, "01/02/2020"), other, mode="append")
    assert parquet.read_anchor(spark, other) == dt.date(2021, 6, 5)
    os.makedirs(os.path.join(tmp_dir, "v", "_anchor"))  # a run that died while it wrote the log
    assert parquet.read_anchor(spark, os.path.join(tmp_dir, "v")) is None


def test_anchor_after_a_write_that_died(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    parquet.write_processed(cleaned(spark, "01/02/2020"), path)
    inner = parquet._log
    with monkeypatch.context() as m:  # between the data's commit and its date
        m.setattr(parquet, "_log", lambda *a, **k: inner(*a, **k) if k.get("pending") else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            parquet.write_processed(cleaned(spark, "05/06/2021"), path, mode="append")
    assert parquet.read_anchor(spark, path) == dt.date(2021, 6, 5)
    with monkeypatch.context() as m:  # the whole table replaced by older rows, then lost
        m.setattr(parquet, "_log", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            parquet.write_processed(cleaned(spark, "03/02/2019"), path)
    assert parquet.read_anchor(spark, path) == dt.date(2019, 2, 3)
