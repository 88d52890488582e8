import random

import numpy as np
from helpers import EDGE, edge_docs, no_docs

from pricelake.llm import toxicity as t

LABELS = "doc_id long, quality int, toxic int"


def test_isotonic_is_the_best_rising_fit():
    x, p = t.fit_isotonic(np.array([1.0, 2, 3, 3, 4, 5]), np.array([0.0, 1, 0, 1, 0, 1]), np.ones(6))
    assert (np.diff(p) >= 0).all() and np.interp(5, x, p) == 1 and abs(np.interp(3, x, p) - 0.5) < 1e-9


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] > 0.3)).astype(float)
    model = t.fit_trees(x[:500], y[:500], np.ones(500))
    assert (((model.margin(x[500:]) > 0) == y[500:]).mean()) > 0.95


def test_features_see_through_disguises():
    make = t.Featurizer(["^lowe"])
    at = dict(zip(t.FEATURES, range(len(t.FEATURES)), strict=True))
    assert make("you idiot")[at["near_second_person"]] > 0
    for text in ("such an 1d10t here", "such an id*ot here", "an i.d.i.o.t!", "an idiiiiot"):
        assert make(text)[at["log_obfuscated"]] > 0, text
    assert make("plain words, 100% fine (v1.2) a*b")[at["log_obfuscated"]] == 0
    assert make("ein loweiisch wort")[at["learned_density"]] > 0 and make("SHOUT NOW")[at["shouted_words"]] > 0
    assert make("") == [0.0] * len(t.FEATURES)


def test_held_out_accuracy_and_calibration(spark):
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(5, 200))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["blarg", "snorple", "idiot", "lowe" + rnd.choice("abcdef") + "isch"]))
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, toxic))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    model = t.fit(df, spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], LABELS))
    got = {r.doc_id: (r.score, r.predicted) for r in t.score(df, model).collect()}
    held = {r.doc_id for r in df.where(t.held_out(df.doc_id)).collect()}
    assert len(held) > 100 and all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got.values())
    truth = {i: x for i, _, x in labels}
    assert sum(got[i][1] == truth[i] for i in held) / len(held) > 0.97


def test_edge_rows(spark):
    labels = spark.createDataFrame([(i, 1, int(i == 5)) for i in range(1, 9)], LABELS)
    model = t.fit(edge_docs(spark), labels)
    assert t.score(edge_docs(spark), model).count() == len(EDGE)
    none = t.fit(edge_docs(spark), labels.limit(0))
    assert {(r.score, r.predicted) for r in t.score(edge_docs(spark), none).collect()} == {(0.0, 0)}
    ones = t.fit(edge_docs(spark), labels.where("toxic = 1"))
    assert all(r.score == float(r.predicted) for r in t.score(edge_docs(spark), ones).collect())
    assert t.score(no_docs(spark), model).count() == 0
    assert t.score(no_docs(spark), t.fit(no_docs(spark), labels)).count() == 0


def test_held_out_labels_of_the_tables(spark):
    """Ranking and calibration on rows that neither the trees nor the curve have seen."""
    root = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{root}/labels.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    model = t.fit(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.where(t.held_out(labels.doc_id) & labels.toxic.isNotNull()).collect()}
    scores = {r.doc_id: r.score for r in t.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).collect() if r.doc_id in truth}
    y, s = np.array([truth[i] for i in scores]), np.array([scores[i] for i in scores])
    assert y.sum() > 50 and len(y) > 500
    order = np.argsort(s, kind="stable")
    below = np.searchsorted(s[order], s[y == 1], side="left"), np.searchsorted(s[order], s[y == 1], side="right")
    ranks = (below[0] + below[1] + 1) / 2  # of toxic ones, ties in the middle
    auc = (ranks.sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    brier = float(((s - y) ** 2).mean())
    assert auc > 0.95 and brier < 0.05, (auc, brier)
    assert abs(s.mean() - y.mean()) < 0.03  # calibrated in the large
