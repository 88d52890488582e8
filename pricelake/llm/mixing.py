"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of ``block_rows``. With integer
weights a_s that sum to D, block k (from 0) of source s may start at slot
floor(k D / a_s) and must start before slot ceil((k + 1) D / a_s). One block
runs per slot, the released one with the earliest deadline. After any number
of slots each source then has its share of them to within less than a block.

Such a schedule repeats every D slots, so a pattern of D slots tells the slot
of every block by arithmetic, however many blocks there are. When a source
runs out, a new phase begins with the weights of those left.

One schedule has at most ``FANIN`` members. More sources form a tree: by falling
weight, every FANIN of them are a group that weighs what they weigh together,
groups form groups in the same way, and a group's k-th own slot is its k-th block
in the schedule above. Any number of sources has a plan, and each is within less
than a block of its share per level of the tree (16 sources have one level, 4,096
three). When a source runs out, its group keeps its share until it runs out as a whole.

The plan of a schedule is a SQL expression over one row; the rows of a level
are spread over the cluster. Periods are bounded: weights are divided by their
greatest common divisor, and where their sum is above ``MAX_PERIOD`` still,
they are rounded to so many parts, at least one each. Documents are numbered
within their source in about sqrt(rows) buckets, so that no source is ever in
one task. With one level they find their slot through a join with that bounded
plan; with more, block rows climb the tree level by level and documents meet
them by source and block.

Every document appears exactly once. Null sources form a source of their own.
A source whose target weight is missing, null or below 1 has weight 1. Rows
that tie or repeat are numbered in any order among themselves. An empty table
gives an empty result. Of the input's columns those named like an added one are
replaced, all others are kept. ``phase``, ``release`` and ``deadline`` are those
of the topmost schedule, which counts in slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import given_back, own_names, placed, set_aside, written

BLOCK_ROWS = 16
RESOLUTION, LEAST_PARTS = 1000, 10
FANIN, MAX_PERIOD = 16, 4096
BLOCKS_A_ROW = 4096
ADDED = ("phase", "block", "release", "deadline", "slot", "position")

# Greatest common divisor of the positive weights: Euclid's steps, at most 90 for longs.
_DIVISOR = """
aggregate(filter({a}, w -> w > 0), 0L, (g, w) ->
  aggregate(sequence(1, 90), named_struct('x', g, 'y', w), (p, i) -> if(p.y = 0, p, named_struct('x', p.y, 'y', p.x % p.y)), p -> p.x))
"""

# Slots of one period, or its first {n}: the released block with the earliest deadline, ties by source.
_PATTERN = """
aggregate(sequence(0L, {n} - 1),
  named_struct('done', transform({a}, w -> 0L), 'slots', cast(array() as array<bigint>)),
  (s, t) -> transform(array(array_min(transform({a}, (w, i) ->
      if(w > 0 and (s.done[i] * {d}) div w <= t, named_struct('due', ((s.done[i] + 1) * {d} + w - 1) div w, 'i', cast(i as bigint)), null)))),
    best -> named_struct('done', transform(s.done, (c, i) -> if(i = best.i, c + 1, c)), 'slots', concat(s.slots, array(best.i))))[0]).slots
"""

# One phase, in named steps: the weights of the members that are left, without their common divisor and with a bounded
# sum; the slots that the phase needs of its pattern; the places of each member in them; and its length up to the first
# member that runs out.
_STEPS = (
    ("own", "transform(p.left, (r, i) -> if(r > 0, weights[i], 0L))"),
    ("g", _DIVISOR.format(a="own")),
    ("small", "transform(own, w -> if(w > 0, w div g, 0L))"),
    ("total", "aggregate(small, 0D, (x, y) -> x + y)"),
    ("a", f"transform(small, w -> if(w = 0 or total <= {MAX_PERIOD}, w, greatest(1L, cast(round(w * ({MAX_PERIOD} / total)) as bigint))))"),
    ("d", "aggregate(a, 0L, (x, y) -> x + y)"),
    ("n", "least(d, array_min(transform(p.left, (r, i) -> if(r between 1 and a[i], (r * d + a[i] - 1) div a[i], null))))"),
    ("slots", _PATTERN.format(a="a", d="d", n="n")),
    ("places", "transform(a, (w, i) -> filter(sequence(0L, n - 1), t -> slots[cast(t as int)] = i))"),
    ("length", "array_min(transform(p.left, (r, i) -> if(r > 0, ((r - 1) div a[i]) * d + get(places[i], cast((r - 1) % a[i] as int)) + 1, null)))"),
)
_NEXT = """
named_struct(
  'left', transform(p.left, (r, i) -> if(r > 0, r - (length div d) * a[i] - size(filter(places[i], t -> t < length % d)), 0L)),
  'start', p.start + length,
  'phases', concat(p.phases, array(named_struct('start', p.start, 'd', d, 'weights', a, 'places', places, 'before', zip_with(blocks, p.left, (x, r) -> x - r)))))
"""


def _phase() -> str:
    """The next state of a plan, or the same one where nothing is left."""
    out = _NEXT
    for name, value in reversed(_STEPS):
        out = f"transform(array({value}), {name} -> {out})[0]"
    return f"if(exists(p.left, r -> r > 0), {out}, p)"


_PLAN = f"""
aggregate(sequence(1, size(blocks)),
  named_struct('left', blocks, 'start', 0L, 'phases',
    cast(array() as array<struct<start: bigint, d: bigint, weights: array<bigint>, places: array<array<bigint>>, before: array<bigint>>>)),
  (p, turn) -> {_phase()}).phases
"""


def _key(source) -> F.Column:
    """A source as a join key; a null source has one too."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def tempered_weights(docs: DataFrame, exponent: float = 0.5, resolution: int = RESOLUTION, least_parts: int = LEAST_PARTS) -> DataFrame:
    """``source, weight``: the share of each source's document count to the power ``exponent``, in ``resolution`` parts, or
    in so many that the smallest share is ``least_parts`` of them."""
    powered = docs.groupBy("source").agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(exponent)).alias("p"))
    # A decimal sum, so that its order does not matter.
    total = powered.agg(F.sum(F.round("p", 6).cast("decimal(38,6)")).cast("double")).scalar()
    least = powered.agg(F.min("p")).scalar()
    parts = F.greatest(F.lit(float(resolution)), F.ceil(least_parts * total / least).cast("double"))
    return powered.select("source", F.greatest(F.lit(1), F.round(F.col("p") / total * parts)).cast("long").alias("weight"))


def _plans(members: DataFrame) -> DataFrame:
    """Per member of ``members (node, member, weight, blocks)`` its part of its node's plan: the phases with start, period,
    weight, places in the period and blocks done before. A node has at most FANIN members."""
    one = members.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("member", "weight", "blocks"))).alias("s"))
    one = one.select("node", F.col("s.member").alias("members"), F.col("s.weight").alias("weights"), F.col("s.blocks").alias("blocks"))
    phases = one.select("members", F.posexplode(F.expr(_PLAN)).alias("phase", "p"))
    parts = phases.select("phase", "p.start", "p.d", F.explode(F.arrays_zip("members", "p.weights", "p.places", "p.before")).alias("z"))
    part = F.struct(
        F.col("z.before").alias("before"),
        F.col("phase").cast("long").alias("phase"),
        "start",
        "d",
        F.col("z.weights").alias("weight"),
        F.col("z.places").alias("places"),
    )
    return parts.where("z.weights > 0").groupBy(F.col("z.members").alias("member")).agg(F.sort_array(F.collect_list(part)).alias("parts"))


def schedule(counts: DataFrame, targets: DataFrame, block_rows: int = BLOCK_ROWS, fanin: int = FANIN) -> tuple[DataFrame, list[DataFrame]]:
    """The sources ``key, member, blocks`` and, level by level from below, the plan ``member, parts`` of a level's members.

    ``counts (key, rows)`` and ``targets (source, weight)`` have a row per source. Member m of a level is in node
    m div ``fanin``, which is a member of the next one.
    """
    spark = counts.sparkSession
    wanted = targets.select(_key(F.col("source")).alias("key"), F.col("weight").cast("long").alias("weight")).groupBy("key").agg(F.max("weight").alias("weight"))
    weight = F.greatest(F.coalesce("weight", F.lit(1)), F.lit(1)).cast("long")
    sources = counts.join(wanted, "key", "left").select("key", weight.alias("weight"), F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"))
    sources = written(spark, sources, "mixing-sources")
    many = sources.count()
    # One node takes its members by key; with several, members of a node weigh alike.
    by = ["key"] if many <= fanin else ["lighter", "key"]
    sources = placed(sources.withColumn("lighter", -F.col("weight")), by, "mixing-order")
    sources = written(spark, sources.select("key", F.col("place").alias("member"), "weight", "blocks"), "mixing-members")
    levels, members = [], sources.select("member", "weight", "blocks")
    while True:
        members = members.withColumn("node", F.expr(f"member div {fanin}"))
        levels.append(written(spark, _plans(members), "mixing-plan"))
        if many <= fanin:
            return sources.select("key", "member", "blocks"), levels
        many = -(-many // fanin)
        members = members.groupBy("node").agg(F.sum("weight").alias("weight"), F.sum("blocks").alias("blocks")).withColumnRenamed("node", "member")
        members = written(spark, members, "mixing-members")


def _slots(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows (member, nth)`` with the slot of their member's nth block: ``phase, release, deadline, slot`` beside the other columns."""
    found = rows.join(plan, "member").withColumn("part", F.expr("element_at(filter(parts, p -> p.before <= nth), -1)")).drop("parts")
    return found.withColumn("j", F.col("nth") - F.col("part.before")).selectExpr(
        *rows.columns,
        "part.phase as phase",
        "part.start + (j * part.d) div part.weight as release",
        "part.start + ((j + 1) * part.d + part.weight - 1) div part.weight as deadline",
        "part.start + (j div part.weight) * part.d + part.places[cast(j % part.weight as int)] as slot",
    )


def block_slots(sources: DataFrame, levels: list[DataFrame], fanin: int = FANIN) -> DataFrame:
    """``key, block, phase, release, deadline, slot`` of every block, by climbing the tree."""
    # In two steps, so that a source with very many blocks is spread before they are made.
    some = sources.select("key", "member", "blocks", F.explode(F.expr(f"sequence(0L, blocks - 1, {BLOCKS_A_ROW}L)")).alias("low")).repartition("key", "low")
    rows = some.select("key", "member", F.explode(F.expr(f"sequence(low, least(low + {BLOCKS_A_ROW}, blocks) - 1)")).alias("block"))
    rows = rows.withColumn("nth", F.col("block"))
    for i, plan in enumerate(levels):
        rows = _slots(rows, plan)
        if i < len(levels) - 1:
            rows = rows.select("key", F.expr(f"member div {fanin}").alias("member"), "block", F.col("slot").alias("nth"))
    return written(sources.sparkSession, rows.drop("member", "nth"), "mixing-blocks")


def numbered(docs: DataFrame) -> DataFrame:
    """The columns set aside, ``key`` and ``nth``, a number from 0 within the source, in an order mixed by hash."""
    keyed = set_aside(docs, _key(F.col("source")).alias("key"), F.xxhash64("doc_id", "text").alias("hash"), F.col("doc_id").alias("id"))
    buckets = max(1, int(docs.count() ** 0.5))
    keyed = keyed.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    sizes = keyed.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("key", "bucket").orderBy("hash", "id")
    ranked = keyed.withColumn("rank", F.row_number().over(own) - 1)
    return ranked.join(starts, ["key", "bucket"]).select(*own_names(docs), "key", (F.col("start") + F.col("rank")).alias("nth"))


def mix(docs: DataFrame, targets: DataFrame | None = None, block_rows: int = BLOCK_ROWS, fanin: int = FANIN) -> DataFrame:
    """Rows of ``docs (doc_id, text, source, ...)`` with phase, block, release, deadline, slot and position in the mix."""
    docs = docs.drop(*ADDED)
    if targets is None:
        targets = tempered_weights(docs)
    counts = docs.groupBy(_key(F.col("source")).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    sources, levels = schedule(counts, targets, block_rows, fanin)
    rows = numbered(docs).withColumn("block", F.floor(F.col("nth") / block_rows)).withColumn("at", F.col("nth") % block_rows)
    if len(levels) == 1:
        # At most fanin rows, whose places together are at most phases * MAX_PERIOD: a proven bound.
        plan = F.broadcast(sources.join(levels[0], "member").select(F.col("key").alias("member"), "parts"))
        done = _slots(rows.select(*own_names(docs), F.col("key").alias("member"), "block", F.col("block").alias("nth"), "at"), plan)
    else:
        done = rows.join(block_slots(sources, levels, fanin), ["key", "block"])
    return done.withColumn("position", F.col("slot") * block_rows + F.col("at")).select(*given_back(docs), *ADDED)
