import os

from helpers import rows_of, sha
from pyspark.sql import functions as F

from pricelake.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"
BIG = "<p>" + "é\r\n\r\nWARC/1.1 " * 20
ROWS = [
    (3, "http://a/ x\r\ny", BIG, "q", "r"),
    (1, "http://b", BIG, None, None),
    (1, "http://b", BIG, None, None),
    (2, None, "short", None, None),
    (4, "http://c", "short", None, None),
    (5, "http://d", None, None, None),
    (None, "http://e", BIG, None, None),
    (6, "http://f", "", None, None),
]


def test_round_trip_and_revisits(spark, tmp_dir):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    index = warc.write_archives(pages, f"{tmp_dir}/w", archive_bytes=500)
    index.write.parquet(f"{tmp_dir}/i")
    index = spark.read.parquet(f"{tmp_dir}/i")
    assert index.count() == len(ROWS) and len(os.listdir(f"{tmp_dir}/w")) > 1
    got = rows_of(warc.read_records(index, f"{tmp_dir}/w").select("page_id", "record_type", "refers_to", "digest", "payload"))
    want = []
    for page_id, _, html, *_ in ROWS:
        revisit = html == BIG and page_id != 1
        want.append((page_id, "revisit" if revisit else "response", 1 if revisit else None, sha(html or ""), None if revisit else html or ""))
    assert got == sorted(want, key=repr)


def test_selected_records_are_read_in_few_ranges(spark, tmp_dir):
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), F.col("id")).alias("html")).coalesce(1)
    warc.write_archives(pages, f"{tmp_dir}/w").write.parquet(f"{tmp_dir}/i")
    index = spark.read.parquet(f"{tmp_dir}/i")
    chosen = index.where("page_id between 5 and 9 or page_id = 30")
    assert warc.byte_ranges(chosen, max_gap=0).count() == 2
    assert warc.byte_ranges(chosen).count() == 1
    got = warc.read_records(chosen, f"{tmp_dir}/w", max_gap=0).select("payload")
    assert rows_of(got) == sorted((f"page {i}",) for i in (5, 6, 7, 8, 9, 30))


def test_no_pages(spark, tmp_dir):
    index = warc.write_archives(spark.createDataFrame([], PAGES), f"{tmp_dir}/w")
    assert index.count() == 0 and warc.read_records(index, f"{tmp_dir}/w").count() == 0


def test_a_hot_payload_is_split_and_archives_are_read_by_many_tasks(spark, tmp_dir, monkeypatch):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        html = F.when(F.col("id") % 10 < 9, F.lit(BIG)).otherwise(F.concat(F.lit(BIG), F.col("id").cast("string")))
        pages = spark.range(6000).repartition(6).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
        joined = warc.tagged(pages)
        assert sum(r.record_type == "response" for r in joined.collect()) == 601
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    warc.write_archives(pages.limit(300), f"{tmp_dir}/w").write.parquet(f"{tmp_dir}/i")
    index = spark.read.parquet(f"{tmp_dir}/i")
    read = warc.read_records(index, f"{tmp_dir}/w", max_range=1000)
    assert read.rdd.getNumPartitions() > 3 and read.count() == 300
