import numpy as np
from conftest import SF_SMALL
from helpers import edge_docs, no_docs

from pricelake.llm import langid


def test_backpropagation_equals_numeric_gradients():
    rng = np.random.default_rng(3)
    layer = langid.Layer(rng, 3)
    layer.params = {k: v.astype(np.float64) for k, v in layer.params.items()}
    codes = rng.integers(0, 256, (5, 4))
    goal = rng.normal(size=(5, 4, 3))

    def loss():
        return float((layer.forward(codes)[1] * goal).sum())

    grads = layer.backward(codes, layer.forward(codes)[0], goal)
    for name, value in layer.params.items():
        for at in [(int(codes[2, 1]), 4)] if name == "table" else [(0, 1), (2, 0)]:
            old, step = value[at], 1e-5
            value[at] = old + step
            up = loss()
            value[at] = old - step
            down = loss()
            value[at] = old
            assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-4 * max(1, abs(grads[name][at]))


def test_fast_states_equal_the_training_forward_pass():
    rng = np.random.default_rng(4)
    layer = langid.Layer(rng, 8)
    codes = rng.integers(0, 257, (langid.SEGMENT, 6))
    assert np.allclose(layer.states(codes).transpose(0, 2, 1), layer.forward(codes)[1], atol=1e-5)


def test_segments_cover_whole_texts():
    codes, owner, sizes = langid.segments([b"", b"x" * 64, b"y" * 65, "é".encode() * 100])
    assert owner.tolist() == [1, 2, 2, 3, 3, 3, 3] and sizes.tolist() == [64, 64, 1, 64, 64, 64, 8]
    assert bytes(codes[owner == 3].reshape(-1)[:200].astype(np.uint8)) == "é".encode() * 100


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = langid.fit(docs)
    got = langid.predict(docs, model).withColumnRenamed("doc_id", "i").join(docs.where(langid.held_out(docs.doc_id)), docs.doc_id == langid.F.col("i"))
    rows = got.select("lang", "lang_pred", "score").collect()
    assert len(rows) > 30 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 7))
    assert all(got[i].lang_pred in ("en", "fr") for i in (4, 5, 6, 8, None))
    untrained = langid.fit(no_docs(spark))
    assert {r.lang_pred for r in langid.predict(docs, untrained).collect()} == {"und"}
    assert langid.predict(no_docs(spark), untrained).count() == 0
