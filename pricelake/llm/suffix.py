"""Exact repeats across a corpus: sampled suffixes, sorted deep-shallow.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, same document included, is a repeat. Strings are judged on the input and
never cross documents.

1. Anchors: each window of ``length`` bytes owns the leftmost smallest gram
   hash inside it. Consecutive windows with the same anchor form a *chunk* (the
   bytes they cover). Equal windows own equal anchors at the same place, so
   only chunks whose anchor gram occurs twice or more can hold a repeat.
2. Equal chunks (same gram, same 96-bit digest of their bytes) that occur twice are repeats whole.
   They are counted with a combine before the shuffle, so passages with any
   number of copies and documents with any number of copies cost one row a task.
3. Where a gram is shared by different chunks, the windows of one chunk of each
   kind are sorted as suffixes: multikey quicksort orders them by eight-byte
   keys down to a shallow depth, and blind tries order the groups that still
   agree. Neighbours that agree over the full length repeat. Grams are pooled
   into sorts of bounded size.
4. A gram with more than ``HOT_KINDS`` kinds of chunk is dealt finer, by what stands
   beside it. A window holds at least half of the bytes that are not the gram's to its left, or else at least half
   to its right; the gram with its left half, and that with its right half, are the keys of
   two smaller groups, and every window is in one of them. Chunks are clipped to those windows, equal clips are
   counted as in 2., and a group that still has too many kinds is halved again. When
   nothing is left to halve the key is the whole window and every group has one kind.
5. Spans are merged per distinct text and applied.

Gram hashes only find candidates: what is removed was equal by a cryptographic digest of 96 bits or more,
or by its bytes. Null texts are empty; texts shorter than ``length`` have no windows.
Rows that repeat each give a row. Other columns are ignored, and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import drop_paths, given_back, map_arrow, map_rows, scratch_scope, set_aside, written

LENGTH, GRAM = 200, 48
SHALLOW = 40  # bytes that the quicksort orders before the tries take over
# Sorts hold about so many chunks; grams with more kinds of chunk than that are dealt finer.
POOL_CHUNKS, HOT_KINDS = 1024, 1024
# Window starts of a very long text are taken so many at a time.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5
_PLACE = np.uint64(2 * BLOCK - 1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :]) if size < width else v


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Chunks of a text: gram hash, place of the gram, first and last window start of each."""
    parts = []
    for at in range(0, len(raw) - length + 1, BLOCK):
        x = np.frombuffer(raw, np.uint8, min(len(raw) - at, BLOCK + length - 1), at).astype(np.uint64)
        power, inverse = _powers(1 << max(16, int(len(x)).bit_length()))
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x + np.uint64(1)) * power[: len(x)], out=sums[1:])
        grams = _mixed((sums[gram:] - sums[:-gram]) * inverse[: len(x) - gram + 1])
        # The place in the low bits makes the minimum the leftmost one and tells where it is.
        least = _sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64) & _PLACE, length - gram + 1)
        place = (least & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        parts.append((grams[place[first]], place[first] + at, first + at, last + at))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def blind_trie(buf: bytes, starts: list[int], length: int) -> list[list[int]]:
    """Strings ``buf[s : s + length]`` in order, equal ones together.

    Inner nodes ``[depth, {byte: child}]`` hold only the depth at which their
    strings part. A new string descends by those bytes alone, is compared once
    with the leaf it reaches, and is hung in where the two really part.
    """
    root: list | None = None
    leaves: dict[int, list[int]] = {}  # first member -> members; a leaf in the trie is its first member
    for s in starts:
        if root is None:
            root = s
            leaves[s] = [s]
            continue
        node = root
        while not isinstance(node, int):
            node = node[1].get(buf[s + node[0]]) if buf[s + node[0]] in node[1] else next(iter(node[1].values()))
        differ = int.from_bytes(buf[s : s + length]) ^ int.from_bytes(buf[node : node + length])
        if not differ:
            leaves[node].append(s)
            continue
        common = length - (differ.bit_length() + 7) // 8
        leaves[s] = [s]
        other, parent, node = node, None, root
        while not isinstance(node, int) and node[0] < common:
            parent, node = node, node[1][buf[s + node[0]]]
        if not isinstance(node, int) and node[0] == common:
            node[1][buf[s + common]] = s
            continue
        split = [common, {buf[other + common]: node, buf[s + common]: s}]
        if parent is None:
            root = split
        else:
            parent[1][buf[s + parent[0]]] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(leaves[node])
        else:
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
    return out


def _partitioned(words: np.ndarray, starts: np.ndarray, order: np.ndarray, head: np.ndarray, limit: int) -> None:
    """Multikey quicksort on eight-byte keys: each round splits every group by its pivot into less, equal and greater.

    ``order`` and ``head`` (where a group begins) change in place. Equal ones go on with their next key, the others with
    the same one, until a group has one member or its keys reach ``limit``. All groups of a round are split at once.
    """
    depth = np.zeros(len(order), np.int64)  # by place; the same throughout a group
    while True:
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, len(order)))
        open_ = (size > 1) & (depth[begin] + 8 <= limit)
        live = np.flatnonzero(np.repeat(open_, size))
        if not len(live):
            return
        size = size[open_]
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        own = np.repeat(np.arange(len(size)), size)
        key = words[starts[order[live]] + depth[live]]
        low, middle, high = key[at], key[at + size // 2], key[at + size - 1]
        pivot = np.maximum(np.minimum(low, middle), np.minimum(np.maximum(low, middle), high))[own]
        side = (key >= pivot).view(np.int8) + (key > pivot).view(np.int8)
        target, base = np.empty(len(live), np.int64), at
        for k in range(3):
            mine = side == k
            count = np.add.reduceat(mine, at, dtype=np.int64)
            before = np.cumsum(mine) - mine
            target[mine] = (base[own] + before - before[at][own])[mine]
            if k == 1:
                equal = np.repeat(base - at, size) <= np.arange(len(live)) - at[own]
                equal &= np.arange(len(live)) < (base + count)[own]
            head[live[base[count > 0]]] = True
            base = base + count
        moved = np.empty(len(live), order.dtype)
        moved[target] = order[live]
        order[live] = moved
        depth[live[equal]] += 8


def deep_shallow(buf: bytes, starts: np.ndarray, length: int, shallow: int = SHALLOW, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings ``buf[s : s + length]``, and whether each equals the one before it.

    ``groups`` tells where among the starts a group begins whose strings are ordered among themselves only.
    """
    n = len(starts)
    raw = np.frombuffer(buf + bytes(8), np.uint8).astype(np.uint64)
    words = np.zeros(len(buf) + 1, np.uint64)
    for k in range(8):
        words |= raw[k : k + len(words)] << np.uint64(56 - 8 * k)
    order, head = np.arange(n), np.zeros(n, bool)
    head[:1] = True
    if groups is not None:
        head[groups] = True
    _partitioned(words, starts, order, head, min(shallow, length))
    same = np.zeros(n, bool)
    heads = np.append(np.flatnonzero(head), n)
    many = np.flatnonzero(np.diff(heads) > 1)
    for a, b in zip(heads[many].tolist(), heads[many + 1].tolist(), strict=True):
        members = order[a:b]
        if b - a == 2:
            x, y = starts[members].tolist()
            x, y = buf[x : x + length], buf[y : y + length]
            if x == y:
                same[a + 1] = True
            elif y < x:
                order[a], order[a + 1] = members[1], members[0]
            continue
        where = dict(zip(starts[members].tolist(), members.tolist(), strict=True))
        for leaf in blind_trie(buf, list(where), length):
            order[a : a + len(leaf)] = [where[s] for s in leaf]
            same[a + 1 : a + len(leaf)] = True
            a += len(leaf)
    return order, same


def repeated_windows(pieces: list[bytes], length: int, shallow: int = SHALLOW, groups: list[int] | None = None) -> list[np.ndarray]:
    """Per piece, whether the window at each of its starts equals another one of the pieces of its group.

    ``groups`` has the index of each group's first piece.
    """
    counts = [len(p) - length + 1 for p in pieces]
    bases = np.cumsum([0] + [len(p) for p in pieces])[:-1]
    starts = np.repeat(bases, counts) + np.concatenate([np.arange(c) for c in counts])
    first = None if groups is None else np.concatenate(([0], np.cumsum(counts)))[groups]
    order, same = deep_shallow(b"".join(pieces), starts, length, shallow, first)
    found = np.zeros(len(starts), bool)
    found[order] = same | np.append(same[1:], False)
    return np.split(found, np.cumsum(counts)[:-1])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def chunk_table(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row, doc_id, digest, n_bytes`` and, per chunk, ``grams, highs, lows, sites`` of every row; written, so row numbers stay.

    ``highs`` and ``lows`` are a 96-bit digest of the chunk's bytes and its gram's place in them, ``sites`` where it
    is: first window << 16 | further windows << 8 | gram's place after the first window (both at most ``length - gram``).
    """

    def run(batches):
        for b in batches:
            columns: list[list] = [[], [], [], []]
            counts = [0]
            for t in b.column("text").to_pylist():
                raw = t.encode()
                grams, places, first, last = anchors(raw, length, gram)
                digests = b"".join(
                    hashlib.blake2b(raw[f : z + length], digest_size=12, salt=(p - f).to_bytes(2)).digest()
                    for p, f, z in zip(places.tolist(), first.tolist(), last.tolist(), strict=True)
                )
                both = np.frombuffer(digests, np.dtype([("high", "<i8"), ("low", "<i4")]))
                for column, values in zip(columns, (grams.view(np.int64), both["high"], both["low"], first << 16 | (last - first) << 8 | (places - first)), strict=True):
                    column.append(values)
                counts.append(len(grams))
            offsets = pa.array(np.cumsum(counts), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in columns]
            yield [b.column(n) for n in ("row", "doc_id", "digest", "n_bytes")] + lists

    if length - gram > 255:
        raise ValueError("a window may be at most 255 bytes longer than its gram")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        "text",
    )
    kinds = "row long, doc_id long, digest string, n_bytes long, grams array<long>, highs array<long>, lows array<int>, sites array<long>"
    return written(docs.sparkSession, map_arrow(rows, run, kinds), "suffix-chunks")


def sorted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Repeats within each group of ``pieces (key, digest, first, piece)``, by pooled suffix sorts: ``digest, begin, end``."""

    def run(batches):
        pool: list = []
        groups: list[int] = []
        key = None

        def result():
            out = {"digest": [], "begin": [], "end": []}
            for (digest, first, _), flags in zip(pool, repeated_windows([p for *_, p in pool], length, groups=groups), strict=True):
                for a, b in _runs(flags):
                    out["digest"].append(digest)
                    out["begin"].append(first + a)
                    out["end"].append(first + b - 1 + length)
            return out

        for b in batches:
            for k, digest, first, piece in zip(b["key"], b["digest"], b["first"], b["piece"], strict=True):
                if k != key:
                    if len(pool) >= POOL_CHUNKS:
                        yield result()
                        pool.clear()
                        groups.clear()
                    groups.append(len(pool))
                key = k
                pool.append((digest, first, piece))
        if pool:
            yield result()

    dealt = pieces.select("key", "digest", "first", "piece").repartition("key").sortWithinPartitions("key")
    return map_rows(dealt, run, "digest string, begin long, end long")


PIECE = "digest string, first long, piece binary, place int, left int, right int"


def halves(piece: bytes, first: int, place: int, left: int, right: int, length: int, gram: int) -> list[tuple]:
    """The two finer groups of a chunk whose windows all hold the gram (at ``place``) with ``left`` and ``right`` bytes beside it.

    Each as ``(key, kind, first, piece, place, left, right)``; the piece is cut to the windows of that group, and a
    group without any is left out.
    """
    slack = length - gram - left - right
    more_left = (slack + 1) // 2
    out = []
    for grown in ((left + more_left, right), (left, right + slack - more_left + 1)):
        # The gram's place in a window that holds all of the grown context.
        least, most = grown[0], length - gram - grown[1]
        a, z = max(0, place - most), min(len(piece) - length, place - least)
        if a <= z:
            cut, at = piece[a : z + length], place - a
            context = cut[at - grown[0] : at + gram + grown[1]]
            key = hashlib.blake2b(context, digest_size=16, salt=grown[0].to_bytes(2)).digest()
            kind = hashlib.blake2b(cut, digest_size=16, salt=at.to_bytes(2)).digest()
            out.append((key, kind, first + a, cut, at, *grown))
    return out


def hot_spans(pieces: DataFrame, length: int, gram: int, hot_kinds: int) -> DataFrame:
    """The same for groups with very many kinds of chunk, halved until each has at most ``hot_kinds`` or one."""
    spark = pieces.sparkSession
    names = ("key", "kind", "first", "piece", "place", "left", "right")

    def run(batches):
        for b in batches:
            out = {k: [] for k in (*names, "digest")}
            for digest, *chunk in zip(*(b[k] for k in ("digest", "piece", "first", "place", "left", "right")), strict=True):
                for row in halves(*chunk, length, gram):
                    out["digest"].append(digest)
                    for k, v in zip(names, row, strict=True):
                        out[k].append(v)
            yield out

    found = None
    while not pieces.isEmpty():
        parts = written(spark, map_rows(pieces.select("digest", "piece", "first", "place", "left", "right"), run, f"key binary, kind binary, {PIECE}"), "suffix-halves")
        kinds = written(spark, parts.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "first")).alias("at")), "suffix-half-kinds")
        # A clip that occurs twice repeats whole, wherever it is.
        spans = parts.join(kinds.where("n > 1").select("key", "kind"), ["key", "kind"], "left_semi").select(
            "digest", F.col("first").alias("begin"), (F.col("first") + F.octet_length("piece")).cast("long").alias("end")
        )
        many = written(spark, kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "suffix-half-many")
        one = kinds.join(many, "key").select("key", "kind", F.col("at.digest").alias("digest"), F.col("at.first").alias("first"), "kinds")
        each = written(spark, parts.join(one, ["key", "kind", "digest", "first"]), "suffix-half-pieces")
        spans = spans.union(sorted_spans(each.where(F.col("kinds") <= hot_kinds), length))
        found = spans if found is None else found.union(spans)
        pieces = each.where(F.col("kinds") > hot_kinds)
    return found


def repeat_spans(docs: DataFrame, chunks: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_kinds: int = HOT_KINDS) -> tuple[DataFrame, DataFrame]:
    """Spans ``digest, begin, end`` (they may overlap) of distinct texts, and the texts ``digest, text`` that have any candidates."""
    spark = docs.sparkSession
    with scratch_scope(spark):
        shared = chunks.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
        shared = written(spark, shared, "suffix-grams")
        each = chunks.select("row", F.explode(F.arrays_zip("grams", "highs", "lows", "sites")).alias("z")).select(
            F.col("z.grams").alias("gram"), F.col("z.highs").alias("high"), F.col("z.lows").alias("low"), "row", F.col("z.sites").alias("site")
        )
        each = written(spark, each.join(shared, "gram", "left_semi"), "suffix-shared")
        kinds = each.groupBy("gram", "high", "low").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "site")).alias("at"))
        kinds = written(spark, kinds, "suffix-kinds")
        first, windows, place = F.shiftright("site", 16), F.shiftright("site", 8).bitwiseAND(F.lit(255)), F.col("site").bitwiseAND(F.lit(255))

        # One row stands for all copies of a text.
        own = chunks.groupBy("digest").agg(F.min("row").alias("row"))
        placed = each.join(own, "row")
        often = kinds.where("n > 1").select("gram", "high", "low")
        whole = placed.join(often, ["gram", "high", "low"], "left_semi").select("digest", first.alias("begin"), (first + windows + length).alias("end"))

        needed = placed.select("digest").distinct()
        text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
        texts = docs.select(text).groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(F.first("text").alias("text"))
        texts = written(spark, texts.join(needed, "digest", "left_semi"), "suffix-texts", keep=True)

        many = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        # Any row of a text will do, but only some hold the text's number here: go from row to digest.
        sites = kinds.select("gram", "at.*").join(written(spark, many, "suffix-many"), "gram").join(chunks.select("row", "digest"), "row")
        cut = F.struct("gram", first.alias("first"), windows.alias("windows"), place.cast("int").alias("place"), "kinds")
        cuts = sites.groupBy("digest").agg(F.collect_list(cut).alias("cuts"))

        def run(batches):
            for b in batches:
                out = {"key": [], "digest": [], "first": [], "piece": [], "place": [], "left": [], "right": [], "kinds": []}
                for digest, t, found in zip(b["digest"], b["text"], b["cuts"], strict=True):
                    raw = t.encode()
                    for c in found:
                        for k, v in (("key", c["gram"]), ("digest", digest), ("first", c["first"]), ("place", c["place"]), ("left", 0), ("right", 0), ("kinds", c["kinds"])):
                            out[k].append(v)
                        out["piece"].append(raw[c["first"] : c["first"] + c["windows"] + length])
                yield out

        pieces = written(spark, map_rows(texts.join(cuts, "digest"), run, f"key long, {PIECE}, kinds long"), "suffix-pieces")
        spans = whole.union(sorted_spans(pieces.where(F.col("kinds") <= hot_kinds), length))
        finer = hot_spans(pieces.where(F.col("kinds") > hot_kinds), length, gram, hot_kinds)
        return written(spark, spans if finer is None else spans.union(finer), "suffix-spans", keep=True), texts


def removals(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """``digest, n_removed, n_spans, kept`` (the remaining bytes) of every distinct text with a repeat."""

    def run(batches):
        for b in batches:
            out = {"digest": b["digest"], "n_removed": [], "n_spans": [], "kept": []}
            for text, found in zip(b["text"], b["spans"], strict=True):
                raw = text.encode()
                merged: list[list[int]] = []
                for s in sorted((s["begin"], s["end"]) for s in found):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                edges = [0, *(e for s in merged for e in s), len(raw)]
                out["n_removed"].append(sum(e - s for s, e in merged))
                out["n_spans"].append(len(merged))
                out["kept"].append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            yield out

    grouped = spans.groupBy("digest").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    return map_rows(grouped.join(texts, "digest"), run, "digest string, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_kinds: int = HOT_KINDS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs (doc_id, text)``."""
    spark = docs.sparkSession
    with scratch_scope(spark, drop=False) as large:
        chunks = chunk_table(docs, length, gram)
    rows = written(spark, chunks.select("doc_id", "n_bytes", "digest"), "suffix-rows")
    done = removals(*repeat_spans(docs, chunks, length, gram, hot_kinds)).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    drop_paths(spark, large)
    return rows.join(done, "digest", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All rows and columns of ``docs`` with repeats cut out of ``text``; a character cut in part goes whole."""
    with scratch_scope(docs.sparkSession, drop=False) as large:
        chunks = chunk_table(docs, length, gram)
    kept = removals(*repeat_spans(docs, chunks, length, gram))
    drop_paths(docs.sparkSession, large)

    def run(batches):
        for b in batches:
            yield {"digest": b["digest"], "kept": [k.decode(errors="ignore") for k in b["kept"]]}

    cleaned = map_rows(kept.select("digest", "kept"), run, "digest string, kept string")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = set_aside(docs, F.sha2(text.cast("binary"), 256).alias("digest")).join(cleaned, "digest", "left")
    own = dict(zip(docs.columns, given_back(docs), strict=True))
    return joined.select(*(F.coalesce(F.col("kept"), v).alias(c) if c == "text" else v for c, v in own.items()))
