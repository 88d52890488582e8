import random

import numpy as np
import pytest
from helpers import EDGE, LONG, edge_docs, no_docs, rows_of

from pricelake.llm import decontam as d

ITEMS = "item_id long, text string"


def distance(item, text):
    """Smallest edit distance of ``item`` to any stretch of ``text``."""
    prev = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        cur = [i]
        for j, y in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev)


def test_bit_parallel_distance():
    rnd = random.Random(3)
    for _ in range(800):
        a = [rnd.randint(1, 4) for _ in range(rnd.randint(1, 12))]
        b = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 20))]
        assert d.edits_within(np.array(a), np.array(b, np.int64))[0] == distance(a, b)


def edited(rnd, words, edits, vocabulary):
    out = list(words)
    for _ in range(edits):
        p = rnd.randrange(len(out))
        out[p : p + rnd.randint(0, 1)] = [rnd.choice(vocabulary)] * rnd.randint(0, 1)
    return out


def test_recall_and_precision_against_brute_force():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 45)))) for i in range(40)]
    bench = d.Benchmark(items)
    docs = []
    for i, text in items * 3:
        words = text.split()
        body = [rnd.choice(vocabulary) for _ in range(60)]
        body[30:30] = edited(rnd, words, rnd.randint(0, d.allowed_edits(len(words))), vocabulary)
        docs.append(body)
    got = {(k, bench.ids[i]): e for k, i, e, _ in bench.leaks([bench.encode(" ".join(x)) for x in docs])}
    want = {}
    for k, body in enumerate(docs):
        for i, text in items:
            words = text.split()
            e = distance(words, body)
            if e <= d.allowed_edits(len(words)):
                want[k, i] = e
    assert set(got) <= set(want)
    assert len(got) >= 0.99 * len(want)
    assert all(got[x] >= want[x] for x in got)
    assert all(x in got and got[x] == 0 for x, e in want.items() if e == 0)


def test_rows_blocks_and_filter(spark):
    bench = [(1, "a text that nobody numbered"), (2, None), (3, "!!!"), (4, " ".join(LONG.split()[4000:4040]).upper()), (5, "café, 世界"), (6, "not in there at all")]
    bench.append((7, bench[0][1]))
    items = spark.createDataFrame(bench, ITEMS)
    want = sorted([(None, 1), (None, 7), (5, 4), (5, 4), (6, 4), (8, 5)], key=repr)
    for size in (1 << 20, 40):
        got = d.find_leaks(edge_docs(spark), items, block_bytes=size).select("doc_id", "item_id")
        assert rows_of(got) == want
        left = d.without_leaks(edge_docs(spark), items, block_bytes=size)
        assert left.columns == edge_docs(spark).columns
        assert rows_of(left.select("doc_id")) == sorted(((e[0],) for e in EDGE if e[0] not in (None, 5, 6, 8)), key=repr)
    assert d.find_leaks(no_docs(spark), items).count() == 0
    assert d.find_leaks(edge_docs(spark), items.limit(0)).count() == 0
    assert d.without_leaks(edge_docs(spark), items.limit(0)).count() == len(EDGE)


@pytest.mark.parametrize("n", [40, 100, 200, 400])
def test_recall_at_the_largest_distance(n):
    """Items of any length with exactly the edits allowed: few are lost, however far the random walks drift."""
    rng, trials = np.random.default_rng(n), 100
    vocabulary = 5000
    found = 0
    for t in range(trials // 20):
        items = [rng.integers(1, vocabulary + 1, n).tolist() for _ in range(20)]
        bench = d.Benchmark([(i, " ".join(map(str, x))) for i, x in enumerate(items)])
        docs = []
        for x in items:
            around = rng.integers(1, vocabulary + 1, 60).tolist()
            docs.append(" ".join(map(str, around[:30] + d.edited(rng, x, d.allowed_edits(n), vocabulary) + around[30:])))
        got = {(k, i): e for k, i, e, _ in bench.leaks([bench.encode(x) for x in docs])}
        assert set(got) <= {(k, k) for k in range(20)} and all(e <= d.allowed_edits(n) for e in got.values())
        found += len(got)
    assert found >= d.TARGET_RECALL * trials


def test_walks_reach_the_recall_of_pieces():
    assert max(y - x for n in range(1, 500) for x, y in d.pieces_of(n)) < 2 * d.PIECE
    for n in (4, 9, 10, 19, 20, 25, 31, 35, 39):
        assert d.meetings(n, d.walks_for(n), trials=300, seed=n)[-1] >= d.TARGET_RECALL, n
