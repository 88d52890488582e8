import collections
import math
import random

import pytest
from helpers import EDGE, edge_docs, no_docs

from pricelake.llm import mixing


def check(rows, weights, block_rows):
    """Slots are dense, blocks keep their windows, and any prefix of a phase is within a block of every target."""
    slots = {}
    for r in rows:
        slots.setdefault(r.slot, set()).add((r.source, r.block, r.phase, r.release, r.deadline))
    assert sorted(slots) == list(range(len(slots))) and all(len(v) == 1 for v in slots.values())
    assert len({r.position for r in rows}) == len(rows)
    order = [next(iter(slots[t])) for t in range(len(slots))]
    assert all(release <= t < deadline for t, (_, _, _, release, deadline) in enumerate(order))
    blocks = {}
    for source, block, *_ in order:
        assert block == blocks.get(source, 0)  # a source's blocks run in order
        blocks[source] = block + 1
    for s, n in blocks.items():
        assert n == -(-sum(r.source == s for r in rows) // block_rows)
    live = dict(weights)
    for phase in sorted({o[2] for o in order}):
        own = [o[0] for o in order if o[2] == phase]
        total, done = sum(live.values()), dict.fromkeys(live, 0)
        for t, s in enumerate(own, 1):
            done[s] += 1
            assert all(abs(done[x] - t * w / total) < 1 for x, w in live.items())
        live = {s: w for s, w in live.items() if any(o[0] == s and o[2] > phase for o in order)}


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 1, "b": 97, "c": 13}])
def test_less_than_a_block_from_the_target(spark, weights):
    docs = [(i, f"t{i}", "en", "a" if i % 3 == 0 else "bc"[i % 5 == 1], 2) for i in range(700)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    targets = spark.createDataFrame(list(weights.items()), "source string, weight long")
    check(mixing.mix(df, targets, block_rows=4).collect(), weights, 4)


def test_edge_rows_all_appear(spark):
    df = edge_docs(spark).withColumnRenamed("score", "slot")
    out = mixing.mix(df, block_rows=1)
    assert out.columns == [c for c in df.columns if c != "slot"] + list(mixing.ADDED)
    rows = out.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((e[0], e[1]) for e in EDGE), key=repr)
    weights = {r.source: r.weight for r in mixing.tempered_weights(df).collect()}
    check(rows, weights, 1)
    assert mixing.mix(no_docs(spark)).count() == 0


def edf(weights, blocks):
    """Slots of every (source, block) by simulation: earliest deadline first among released blocks, ties by source."""
    left, done, slots, start = dict(blocks), dict.fromkeys(blocks, 0), {}, 0
    while any(left.values()):
        live = {s: weights[s] for s in sorted(left) if left[s]}
        total, ran, t = sum(live.values()), dict.fromkeys(live, 0), 0
        while all(left[s] for s in live):
            ready = [s for s in live if ran[s] * total // live[s] <= t]
            s = min(ready, key=lambda s: (-(-(ran[s] + 1) * total // live[s]), s))
            slots[s, done[s]] = start + t
            ran[s], done[s], left[s], t = ran[s] + 1, done[s] + 1, left[s] - 1, t + 1
        start += t
    return slots


def sized(spark, sizes):
    rows = [(i, f"t{i}", "en", s, 2) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("seed", range(4))
def test_slots_equal_a_simulation(spark, seed):
    rnd = random.Random(seed)
    weights = {f"s{i:02d}": rnd.choice([1, 2, 3, 10, 97]) for i in range(rnd.randint(1, 12))}
    blocks = {s: rnd.randint(1, 60) for s in weights}
    targets = spark.createDataFrame(list(weights.items()), "source string, weight long")
    rows = mixing.mix(sized(spark, {s: 2 * n for s, n in blocks.items()}), targets, block_rows=2).collect()
    assert {(r.source, r.block): r.slot for r in rows} == edf(weights, blocks)


def test_large_weights_have_a_short_plan(spark):
    weights = {"a": 20001, "b": 10007, "c": 3001, "d": 10**12}
    rows = mixing.mix(sized(spark, dict.fromkeys(weights, 20)), spark.createDataFrame(list(weights.items()), "source string, weight long"), block_rows=1).collect()
    assert sorted(r.slot for r in rows) == list(range(80))
    assert [r.source for r in sorted(rows, key=lambda r: r.slot)[:20]].count("d") >= 19


@pytest.mark.parametrize("fanin", [2, 3])
def test_a_tree_of_schedules_keeps_each_level_within_a_block(spark, fanin):
    rnd = random.Random(fanin)
    weights = {f"s{i:02d}": rnd.randint(1, 9) for i in range(11)}
    blocks = {s: 40 * w for s, w in weights.items()}  # all run out together, so the targets hold to the end
    docs = sized(spark, blocks)
    rows = mixing.mix(docs, spark.createDataFrame(list(weights.items()), "source string, weight long"), 1, fanin).collect()
    order = [r.source for r in sorted(rows, key=lambda r: r.slot)]
    assert sorted(r.slot for r in rows) == list(range(len(rows))) == sorted(r.position for r in rows)
    assert collections.Counter(order) == blocks
    assert all(r.release <= r.slot < r.deadline for r in rows)
    total, done, levels = sum(weights.values()), dict.fromkeys(weights, 0), math.ceil(math.log(11, fanin) - 1e-9)
    for t, s in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[x] - t * w / total) < levels for x, w in weights.items())
    for s in weights:
        assert [r.block for r in sorted(rows, key=lambda r: r.slot) if r.source == s] == list(range(blocks[s]))


def test_any_number_of_sources_has_a_place_for_every_document(spark):
    docs = spark.range(12000).selectExpr("id as doc_id", "concat('t', id) as text", "'en' as lang", "concat('s', if(id < 4000, 0, id % 5000)) as source", "1L as n_chars")
    rows = mixing.mix(docs, block_rows=4).select("doc_id", "source", "block", "slot", "position").collect()
    assert sorted(r.doc_id for r in rows) == list(range(12000))
    slots = {r.slot: (r.source, r.block) for r in rows}
    assert sorted(slots) == list(range(len(slots))) and len(set(slots.values())) == len(slots)
    assert len({r.position for r in rows}) == 12000
