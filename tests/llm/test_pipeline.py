import collections

import duckdb
import pytest
from conftest import SF_SMALL
from helpers import EDGE, edge_docs, no_docs, rows_of
from pyspark.sql import functions as F
from test_decontam import distance
from test_minhash import brute as components
from test_mixing import check
from test_suffix import brute as repeats

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from pricelake.llm import decontam, mixing, queries


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    before = docs.collect()
    for name, stage in pipeline.STAGES:
        df = pipeline.written(spark, stage(spark, docs, SF_SMALL), f"test-{name}")
        after = df.collect()
        ids = {r.doc_id for r in after}
        if name == "toxicity":
            toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
            assert sum(i in ids for i, t in toxic.items() if t == 0) >= 0.98 * sum(t == 0 for t in toxic.values())
        elif name == "minhash":
            assert ids == {i for i, _, _, kept in components([(r.doc_id, r.text) for r in before]) if kept}
        elif name == "suffix":
            assert ids == {r.doc_id for r in before}
            cut = dict(zip((r.doc_id for r in before), repeats([r.text for r in before], 200), strict=True))
            for r in after:
                n, removed, spans, _ = cut[r.doc_id]
                # A character cut in part goes whole: up to 3 bytes at each end of a span.
                assert 0 <= n - removed - len(r.text.encode()) <= 6 * spans and r.n_chars == len(r.text)
        elif name == "decontamination":
            items = [decontam.words_of(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in before} - ids
            for r in before:
                text = decontam.words_of(r.text)
                whole = any(" ".join(i) in " ".join(text) for i in items)
                assert not whole or r.doc_id in gone
                if r.doc_id in gone:
                    assert any(distance(i, text) <= decontam.allowed_edits(len(i)) for i in items)
        else:
            assert ids == {r.doc_id for r in before}
            check(after, {r.source: r.weight for r in mixing.tempered_weights(docs).collect()}, mixing.BLOCK_ROWS)
        assert df.columns[: len(columns)] == columns
        docs, before = df, after


def test_stages_on_edge_and_empty_rows(spark, tmp_dir):
    spark.createDataFrame([(5, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for name, stage in pipeline.STAGES:
        assert stage(spark, no_docs(spark), tmp_dir).count() == 0, name
        assert stage(spark, edge_docs(spark), tmp_dir).count() <= len(EDGE), name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.select(*columns)) == sorted(cur.fetchall(), key=repr)


def test_stages_keep_columns_whatever_their_names(spark):
    """Columns named like an operator's own come through every stage as they were."""
    names = "parts _key _index _kept _digest _part _bucket key p own kept digest id row nth at member hash bucket kept_id".split()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60")
    docs = docs.select("*", *(F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in names))
    columns, rows = docs.columns, docs.count()
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns[: len(columns)] == columns, name
        got = out.collect()
        assert 0 < len(got) <= rows and all(r[n] == f"{n}:{r.doc_id}" for r in got for n in names), name


def test_toxic_documents_go_and_clean_ones_stay(spark):
    root = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    kept = {r.doc_id for r in dict(pipeline.STAGES)["toxicity"](spark, docs, root).select("doc_id").collect()}
    gone = [i not in kept for i, toxic in labels.items() if toxic == 1]
    assert len(gone) > 300 and sum(gone) / len(gone) > 0.85
    clean = [i in kept for i, toxic in labels.items() if toxic == 0]
    assert sum(clean) / len(clean) > 0.99


def test_registered():
    names = collections.Counter(n.split("_")[0] for n in entry.queries())
    assert all(names[f"op{n}"] == 1 for n in range(1, 14)) and names["pipeline"] == 1
