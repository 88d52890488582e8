import random

import pytest
from helpers import EDGE, WORD, edge_docs, no_docs, rows_of
from pyspark.sql import functions as F

from pricelake.llm import graph, minhash


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return set(zip(words, words[1:])) if len(words) > 1 else {(w,) for w in words}


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all texts; null ids are linked to copies only."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = (min(ids) if ids else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def near_copies(rnd, n, words=40):
    base = [f"b{rnd.randint(0, 9)}{i}" for i in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.choice((0, 1, 1, 2, 3, 4, 5))):
            copy[rnd.randrange(words)] = f"n{rnd.randint(0, 999)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [128, 6])
def test_components_equal_brute_force(spark, monkeypatch, block):
    """Small blocks send the groups through hubs and the blocks of what stays outside."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)
    monkeypatch.setattr(minhash, "HUBS", 3)
    rnd = random.Random(block)
    texts = near_copies(rnd, 60) + near_copies(rnd, 25, 12) + [" ".join(f"u{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 9))) for _ in range(60)]
    rows = list(enumerate(texts + texts[:10]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(df)) == brute(rows)


def test_edge_rows(spark):
    rows = [(e[0], e[1]) for e in EDGE]
    assert rows_of(minhash.near_duplicates(edge_docs(spark))) == brute(rows)
    kept = minhash.deduplicated(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 5, 7, 8]
    assert rows_of(minhash.near_duplicates(no_docs(spark))) == []


def test_similarity_is_corrected_for_chance(spark):
    a = [f"w{i}" for i in range(400)]
    texts = {0: a, 1: a[:300] + [f"x{i}" for i in range(100)], 2: [f"y{i}" for i in range(400)]}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string")
    s = minhash.sketch(df).select("doc_id", "signature")
    other = s.where("doc_id = 0").select(F.col("signature").alias("o")).first()["o"]
    got = {r.doc_id: r.j for r in s.select("doc_id", minhash.similarity(F.col("signature"), F.lit(other)).alias("j")).collect()}
    assert got[0] == 1 and abs(got[1] - 0.6) < 0.12 and abs(got[2]) < 0.12


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i * 7919 % 1000, (i + 1) * 7919 % 1000) for i in range(40)]
    star = [(5000, 5000 + i) for i in range(1, 30)]
    df = spark.createDataFrame([*chain, *star, (9, 9), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert len({got[x] for pair in chain for x in pair}) == 1 and len({got[x] for pair in star for x in pair}) == 1
    assert got[5000] != got[chain[0][0]] and 9 not in got
    assert graph.components(df.limit(0)).count() == 0
