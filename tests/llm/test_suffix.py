import collections
import random

import numpy as np
import pytest
from helpers import EDGE, edge_docs, no_docs, rows_of, sha

from pricelake.llm import suffix


def brute(texts, length):
    count = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        cover = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                cover[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        out.append((len(raw), int(cover.sum()), runs, sha(bytes(np.frombuffer(raw, np.uint8)[~cover]))))
    return out


def test_deep_shallow_orders_strings():
    rnd = random.Random(5)
    for _ in range(150):
        length = rnd.choice([5, 12, 20, 60])
        buf = bytes(rnd.choice(b"ab") for _ in range(300))
        starts = np.array(sorted(rnd.sample(range(300 - length), 80)))
        order, same = suffix.deep_shallow(buf, starts, length, rnd.choice([8, 16, 40]))
        got = [buf[s : s + length] for s in starts[order].tolist()]
        assert got == sorted(got)
        assert same.tolist() == [i > 0 and got[i] == got[i - 1] for i in range(len(got))]


def test_chunks_cover_every_window_once_and_equal_windows_share_grams(monkeypatch):
    rnd = random.Random(6)
    raw = bytes(rnd.choice(b"abc") for _ in range(3000))
    raw += raw[500:900] + b"a" * 300

    def owners():
        grams, _, first, last = suffix.anchors(raw, 40, 8)
        assert first[0] == 0 and last[-1] == len(raw) - 40 and (first[1:] == last[:-1] + 1).all()
        return np.repeat(grams, last - first + 1)

    gram_of = owners()
    seen = {}
    for s in range(len(raw) - 39):
        assert seen.setdefault(raw[s : s + 40], gram_of[s]) == gram_of[s]
    monkeypatch.setattr(suffix, "BLOCK", 256)  # a text of many blocks
    monkeypatch.setattr(suffix, "_PLACE", np.uint64(511))
    assert (owners() == gram_of).all()


@pytest.mark.parametrize(("length", "gram", "hot"), [(20, 5, 1000), (20, 5, 2), (12, 3, 1)])
def test_removals_equal_brute_force(spark, length, gram, hot):
    rnd = random.Random(length)
    base = "".join(rnd.choice("abcdé ") for _ in range(3000))
    texts = [None, "", "a", "a" * 50, "ab" * 20]
    for _ in range(50):
        t = "".join(rnd.choice("abcdefghijklmnopé ") for _ in range(rnd.randint(5, 60)))
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randrange(2900)
            t += base[a : a + rnd.randint(10, 60)] + "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 9)))
        texts.append(t)
    texts += texts[10:14] + [texts[20]] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = [(i, *r) for i, r in enumerate(brute(texts, length))]
    assert rows_of(suffix.remove_repeats(df, length, gram, hot)) == sorted(want, key=repr)


def test_edge_rows_and_pipeline_form(spark):
    texts = [e[1] for e in EDGE]
    want = [(e[0], *r) for e, r in zip(EDGE, brute(texts, 200))]
    assert rows_of(suffix.remove_repeats(edge_docs(spark))) == sorted(want, key=repr)
    cut = suffix.without_repeats(edge_docs(spark))
    assert cut.columns == edge_docs(spark).columns
    left = {(r.doc_id, r.text) for r in cut.collect()}
    assert (5, "") in left and (1, None) in left and (4, "one") in left
    assert suffix.remove_repeats(no_docs(spark)).count() == 0 == suffix.without_repeats(no_docs(spark)).count()


def test_partition_by_pivots_orders_groups_apart():
    rnd = random.Random(7)
    for _ in range(100):
        buf = bytes(rnd.choice(b"ab") for _ in range(400))
        starts = np.array(sorted(rnd.sample(range(340), 90)))
        cuts = [0, *sorted(rnd.sample(range(1, 90), 6)), 90]
        order, same = suffix.deep_shallow(buf, starts, 60, 40, np.array(cuts[:-1]))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            assert sorted(order[a:z]) == list(range(a, z)) and not same[a]
            got = [buf[s : s + 60] for s in starts[order[a:z]].tolist()]
            assert got == sorted(got) and same[a + 1 : z].tolist() == [x == y for x, y in zip(got, got[1:])]


def test_halves_hold_every_window_once():
    rnd = random.Random(8)
    for _ in range(200):
        gram = rnd.choice([3, 5])
        length = gram + rnd.randint(1, 20)
        raw = bytes(rnd.choice(b"ab") for _ in range(80))
        for _, place, first, last in zip(*(x.tolist() for x in suffix.anchors(raw, length, gram)), strict=True):
            todo, whole = [(raw[first : last + length], first, place - first, 0, 0)], []
            while todo:
                piece, at, inside, left, right = chunk = todo.pop()
                if left + right + gram == length:
                    assert piece == raw[at : at + length]
                    whole.append(at)
                else:
                    todo += [(r[3], r[2], *r[4:]) for r in suffix.halves(*chunk, length, gram)]
            assert sorted(whole) == list(range(first, last + 1))


def test_thousands_of_kinds_of_one_gram(spark):
    """A line that many texts share, with other text around it: its grams have as many kinds of chunk as there are texts."""
    rnd = random.Random(9)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(45))
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(1, 40)))
    texts = [f"{word()}{line}{word()}" for _ in range(1500)]
    texts += [f"{line[:30]}{word()}" for _ in range(200)] + [f"{t}!" for t in texts[:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for length, gram, hot in ((30, 8, 2), (60, 8, 20)):
        want = [(i, *r) for i, r in enumerate(brute(texts, length))]
        assert rows_of(suffix.remove_repeats(df, length, gram, hot)) == sorted(want, key=repr)


def test_equal_hashes_alone_remove_nothing(spark, monkeypatch):
    """With grams that all hash alike, only equal bytes go."""
    monkeypatch.setattr(suffix, "_BASE", 1)  # a gram's hash is then the sum of its bytes
    suffix._powers.cache_clear()
    first, second = "abcdefghij" * 3, "jihgfedcba" * 3
    texts = [f"{first}{'x' * 7}", second + "y" * 9, "bacdefghij" * 3 + "zz", first + "w"]
    rows = [suffix.anchors(t.encode(), 12, 10)[0].tolist() for t in texts]
    assert set(rows[0]) & set(rows[1])
    suffix._powers.cache_clear()
    monkeypatch.undo()
    suffix._powers.cache_clear()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *r) for i, r in enumerate(brute(texts, 12))]
    for hot in (1, 100):
        assert rows_of(suffix.remove_repeats(df, 12, 10, hot)) == sorted(want, key=repr)
