"""Near-duplicate components by b-bit MinHash.

A document's set holds its distinct 2-word shingles. Documents are linked if
their sets' Jaccard similarity is at least 0.8; the result is the connected
components of all links.

1. Equal sets form a class; everything below works on classes, so any number
   of copies costs one row.
2. ``BANDS`` bands of ``ROWS`` minima give bucket keys. The signature keeps
   only the low ``BITS`` bits of each minimum, packed into longs; equal lanes
   of two signatures, counted by XOR and bit counts and corrected for chance
   equality 2^-BITS, estimate their similarity.
3. Bucket by bucket, each member is compared with the bucket's leader, never
   with all others. Two linked classes are at a Jaccard distance of at most
   0.2, so if one is within 1 - CORE of the leader the other is within
   1 - CORE + 0.2: members estimated above CORE + MARGIN leave the bucket and all estimated above
   CORE - 0.2 - MARGIN are tied to the leader. Those that stay go through
   another round, and what still stays after ``ROUNDS`` rounds is tied to its
   last leader unseen. The ties' components are candidate clusters; a link
   that shares any bucket is inside one of them.
4. Links are confirmed on full sets inside each cluster, in tasks of bounded
   size: a small cluster is one task; of a large one, each block of members
   meets a block of hubs, and then only the members outside its largest
   component meet all blocks.

Chance that a link of similarity 0.8 shares no bucket: (1 - 0.8^5)^40 = 1e-7.

A document with one word has that word as its only shingle; null, empty and
wordless texts have an empty set and are alone. Rows that repeat or share an
id each give a row, grouped by their text. Null ids never are a component's
id, and a text that only null ids hold is linked to its copies alone. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import WORD_RE, ascii_lower, by_shuffle, given_back, map_arrow, scratch_scope, set_aside, written
from pricelake.llm.graph import components

BANDS, ROWS, BITS = 40, 5, 4
SIMILARITY = 0.8  # 100 * intersection >= 80 * union
CORE, MARGIN, ROUNDS = 0.63, 0.12, 2
# A task of the confirmation holds about so many sets and shingles on each side.
BLOCK_SETS, BLOCK_SHINGLES, HUBS = 128, 2_000_000, 64

_LANES = 64 // BITS
_LONGS = -(-BANDS * ROWS // _LANES)


def shingles(text) -> F.Column:
    """The distinct shingles of a text, as hashes."""

    def made(w):
        pairs = F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
        return F.when(F.size(w) >= 2, F.array_distinct(pairs)).otherwise(F.transform(w, lambda x: F.xxhash64(x)))

    words = F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(f"({WORD_RE})"), F.lit(1))
    return F.transform(F.array(words), made)[0]


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    k = BANDS * ROWS
    return rng.integers(0, 2**31, k).astype(np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, k).astype(np.uint32)


def minima(values: np.ndarray) -> np.ndarray:
    """The minimum of each hash permutation over a set (uint64), 512 members at a time."""
    a, b = _permutations()
    low = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    out = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(low), 512):
        hashes = low[k : k + 512, None] * a
        hashes += b
        np.minimum(out, hashes.min(axis=0), out=out)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def bands_and_signatures(mins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys (n, BANDS) and packed b-bit signatures (n, _LONGS) of minima (n, BANDS * ROWS)."""
    wide = mins.astype(np.uint64)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(mins), 1))
    for r in range(ROWS):
        keys = _mixed(keys + wide.reshape(-1, BANDS, ROWS)[:, :, r] + np.uint64(1))
    # The minima's own low bits are those of a linear hash: mix before keeping them.
    lanes = np.zeros((len(mins), _LONGS * _LANES), np.uint64)
    lanes[:, : BANDS * ROWS] = (_mixed(wide + np.uint64(1)) >> np.uint64(40)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS)
    packed = np.bitwise_or.reduce(lanes.reshape(-1, _LONGS, _LANES) << shifts, axis=2)
    return keys.view(np.int64), packed.view(np.int64)


def similarity(a, b) -> F.Column:
    """Estimated Jaccard similarity of two packed signatures: equal lanes by bit counts, less chance equality."""
    ones = sum(1 << (BITS * k) for k in range(_LANES))
    lane_ones = F.lit(ones - (1 << 64) if ones >= 1 << 63 else ones)

    def unequal(x, y):
        d = x.bitwiseXOR(y)
        any_bit = d
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(any_bit.bitwiseAND(lane_ones))

    total = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    return ((1 - total / (BANDS * ROWS)) - chance) / (1 - chance)


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, bands, signature``; the digest names the set and is null for an empty one."""

    def run(batches):
        for b in batches:
            column = b.column("s")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            sets = [values[x:y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, packed = bands_and_signatures(np.stack([minima(sets[i]) for i in full])) if full else (np.zeros((0, BANDS), np.int64), np.zeros((0, _LONGS), np.int64))
            digests: list = [None] * len(sets)
            for i in full:
                digests[i] = digest(sets[i])
            sizes = np.array([bool(len(s)) for s in sets], np.int64)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes * m.shape[1]))), pa.int32()), pa.array(m.reshape(-1)))
                for m in (keys, packed)
            ]
            counts = pa.array([len(s) for s in sets], pa.int64())
            yield [b.column("doc_id"), counts, pa.array(digests, pa.binary()), *lists]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingles(F.col("text")).alias("s"))
    return map_arrow(rows, run, "doc_id long, n_shingles long, digest binary, bands array<long>, signature array<long>")


def digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(np.sort(values).tobytes(), digest_size=16).digest()


def candidate_ties(classes: DataFrame) -> DataFrame:
    """``u, v``: ties of classes ``(key, bands, signature)`` to bucket leaders, as the module docstring says.

    Keys are 64-bit hashes of the digests. If two classes ever shared one, their clusters would be examined as one.
    """
    spark = classes.sparkSession
    signatures = classes.select("key", "signature")
    rows = classes.select("key", F.explode("bands").alias("bucket"))
    ties = None
    for turn in range(ROUNDS + 1):
        # Buckets with one member end here; least and greatest are combined before the shuffle.
        ends = rows.groupBy("bucket").agg(F.min("key").alias("leader"), F.max("key").alias("last")).where("leader <> last")
        pairs = rows.join(by_shuffle(ends.select("bucket", "leader")), "bucket").where("key <> leader")
        if turn < ROUNDS:
            pairs = pairs.join(signatures, "key").join(signatures.select(F.col("key").alias("leader"), F.col("signature").alias("other")), "leader")
            pairs = pairs.select("bucket", "key", "leader", similarity(F.col("signature"), F.col("other")).alias("similar"))
            pairs = written(spark, pairs, "minhash-pairs")
            rows = pairs.where(F.col("similar") < CORE + MARGIN).select("key", "bucket")
            pairs = pairs.where(F.col("similar") >= CORE - (1 - SIMILARITY) - MARGIN)
        found = pairs.select(F.col("key").alias("u"), F.col("leader").alias("v")).distinct()
        ties = found if ties is None else ties.union(found)
    return ties


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Root (an index) of each set's component under links among ``sets``, by intersection counts over an inverted index."""
    n = len(sets)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    posted = owner[np.argsort(inverse, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(inverse, minlength=len(values)))))
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i in range(n - 1):
        own = inverse[at[i] : at[i + 1]]
        low, counts = starts[own], starts[own + 1] - starts[own]
        reach = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        shared = np.bincount(posted[reach], minlength=n)
        # 100 * shared >= 80 * (a + b - shared)
        for j in (np.flatnonzero(180 * shared[i + 1 :] >= 80 * (sizes[i] + sizes[i + 1 :])) + i + 1).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)])


def confirmed(rows: DataFrame) -> DataFrame:
    """``u, v``: links that span the components within each task of ``rows (task, digest, s)``."""

    def run(batches):
        task, members = None, {}

        def result():
            names = list(members)
            roots = linked(list(members.values())) if len(names) > 1 else ()
            pairs = [(names[i], names[r]) for i, r in enumerate(roots) if i != r]
            return [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]

        for b in batches:
            column = b.column("s")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            for name, key, x, y in zip(b.column("task").to_pylist(), b.column("digest").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                if name != task:
                    if members:
                        yield result()
                    task, members = name, {}
                members.setdefault(key, np.array(values[x:y]))
        if members:
            yield result()

    dealt = rows.select("task", "digest", "s").repartition("task").sortWithinPartitions("task")
    return map_arrow(dealt, run, "u binary, v binary")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``u, v``: confirmed links that span the components of the classes ``(digest, id, n_shingles, bands, signature)``."""
    spark = docs.sparkSession
    classes = classes.withColumn("key", F.xxhash64("digest"))
    clusters = components(candidate_ties(classes)).withColumnRenamed("node", "key").withColumnRenamed("root", "cluster")
    members = written(spark, clusters.join(classes.select("key", "digest", "id", "n_shingles"), "key").drop("key"), "minhash-members")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("n"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("n") / BLOCK_SHINGLES)).cast("int")
    sizes = sizes.select("cluster", blocks.alias("blocks"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(by_shuffle(members.where("id is not null")), "id")
    sets = texts.select("cluster", "digest", shingles(F.col("text")).alias("s"))
    sets = written(spark, _own(sets).join(sizes, "cluster"), "minhash-sets")

    def task(*parts):
        return F.concat_ws(":", F.hex("cluster"), *(p.cast("string") for p in parts))

    def part(count):
        return F.pmod(F.xxhash64("digest"), count)

    large = sets.where("blocks > 1")
    own = sets.select(task(F.when(F.col("blocks") > 1, part(F.col("blocks"))).otherwise(0)).alias("task"), "digest", "s")
    # The hubs are about HUBS members by hash, fewer where sets are large, and meet every block.
    hub = F.pmod(F.xxhash64("digest", F.lit("hub")), F.greatest(F.lit(1), F.col("blocks") * (BLOCK_SETS // HUBS))) == 0
    hubs = large.where(hub).select("cluster", "digest", "s", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    first = written(spark, confirmed(own.union(hubs.select(task(F.col("b")).alias("task"), "digest", "s"))), "minhash-links")
    if large.isEmpty():
        return first
    # Of a large cluster, whoever is outside its largest component so far meets every member.
    names = large.select("cluster", "digest", "blocks")
    roots = components(first.join(names.select(F.col("digest").alias("u")), "u", "left_semi"))
    placed = names.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    largest = placed.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("cluster").agg(F.max_by("root", F.struct("k", "root")).alias("main"))
    outside = written(spark, placed.join(largest, "cluster").where("root <> main").select("cluster", "digest"), "minhash-outside")
    counts = outside.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).cast("int").alias("groups"))
    # Sets are as large as their cluster's blocks allow, so groups follow the larger of both measures.
    counts = counts.join(sizes, "cluster").select("cluster", F.least("blocks", F.greatest("groups", F.lit(1))).alias("groups"))
    every = large.join(counts, "cluster")
    each_group = every.select("cluster", "digest", "s", part(F.col("blocks")).alias("b"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    outer = every.join(outside, ["cluster", "digest"], "left_semi").withColumn("g", part(F.col("groups")))
    each_block = outer.select("cluster", "digest", "s", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "g")
    rows = each_group.unionByName(each_block).select(task(F.col("b"), F.col("g")).alias("task"), "digest", "s")
    return first.union(written(spark, confirmed(rows), "minhash-links"))


def _own(sets: DataFrame) -> DataFrame:
    """Rows whose set has the digest they are listed under (ids may repeat with other texts)."""

    def run(batches):
        for b in batches:
            column = b.column("s")
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            same = [digest(values[x:y]) == d for x, y, d in zip(offsets[:-1], offsets[1:], b.column("digest").to_pylist(), strict=True)]
            kept = b.filter(pa.array(same, pa.bool_()))
            yield [kept.column(n) for n in ("cluster", "digest", "s")]

    return map_arrow(sets, run, "cluster long, digest binary, s array<long>")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs (doc_id, text)``."""
    spark = docs.sparkSession
    with scratch_scope(spark):
        sketched = written(spark, sketch(docs), "minhash-sketch")
        classes = (
            sketched.where("digest is not null")
            .groupBy("digest")
            .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        )
        classes = written(spark, classes, "minhash-classes")
        sizes = written(spark, sketched.select("doc_id", "n_shingles", "digest"), "minhash-sizes", keep=True)
        roots = components(links(docs, classes)).withColumnRenamed("node", "digest")
        rooted = classes.select("digest", "id").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
        # Written, so that the join back stands on a shuffle of its own on both sides and a large component can be split.
        rooted = written(spark, rooted, "minhash-rooted", keep=True)
    least = written(spark, rooted.groupBy("root").agg(F.min("id").alias("component_id")), "minhash-least")
    named = rooted.join(by_shuffle(least), "root").select("digest", "component_id")
    rows = sizes.join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that their component keeps, all columns; rows that repeat a kept id stay together."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = set_aside(docs, F.col("doc_id").cast("long").alias("id"))
    return rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi").select(*given_back(docs))
