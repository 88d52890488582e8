"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items are word sequences (lower-cased runs of letters and
digits). An item of n words leaks into a document if some stretch of it is
within floor(``MAX_EDITS`` * n) word edits of the item.

1. An item of ``2 * PIECE`` words or more is cut into pieces of at least PIECE
   words. If all pieces had more than their share of edits, so would the item:
   at least one piece of a leak is within its own share. This is exact.
2. An exact filter: with k edits at least one run of ceil((n - k) / (k + 1))
   of a piece's n words survives, so only windows around a common run of that
   length (at most GRAM words) can leak. It drops no window that could.
3. The CGK random walk copies each piece-sized window into a string of twice
   its length, repeating each word by random bits; equal edit distance turns
   into Hamming distance. Independent walks, each with ``BITS`` sampled places,
   bring windows and pieces with equal samples together. The walks drift apart
   the longer they are, so their number is measured for each length at its
   largest distance (``walks_for``); pieces keep it small for any item. Windows
   equal to the piece meet it always.
4. Items with a piece that met a window are verified by the exact edit distance
   of the whole item to any stretch of the words around it.

The benchmark is a stated query set, taken in blocks of bounded size; each
block is one pass over all documents, whole texts, with no shuffle of texts.

Null or wordless items match nothing; null or empty texts leak nothing. Items
with equal texts are all reported. Repeated document rows each give rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import keep_where, map_rows

MAX_EDITS = 0.2
GRAM = 4
BITS = 4
PIECE = 20
TARGET_RECALL = 0.99
# Walks by the edits a piece may have: what measured_walks finds at the shortest such piece (8 to 48), and up to 32 more, as lengths differ.
WALKS = (8, 24, 32, 40, 56, 64, 72, 80)
# A block of the benchmark holds about so many bytes of text.
BLOCK_BYTES = 2 << 20
SEED = 20240229

_WORDS = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd multiplier that spreads bits


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def allowed_edits(n: int, share: float = MAX_EDITS) -> int:
    return int(n * share)


def gram_length(n: int, share: float = MAX_EDITS) -> int:
    k = allowed_edits(n, share)
    return max(1, min(GRAM, -(-(n - k) // (k + 1))))


def pieces_of(n: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of an item of n words, near equal in length: PIECE to 2 * PIECE - 1 words, or the whole of a short item."""
    count = max(1, n // PIECE)
    return [(n * j // count, n * (j + 1) // count) for j in range(count)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(32)
    x *= _MIX
    return x ^ (x >> np.uint64(29))


def cgk_keys(windows: np.ndarray, walks: int, bits: int = BITS) -> np.ndarray:
    """LSH keys (walks, n) of word-code windows (n, length): ``bits`` sampled places of each random-walk embedding.

    The walk of repetition r stands on word i at step j, writes it, and moves on if the random bit of (r, j, word) is set.
    """
    n, length = windows.shape
    rng = np.random.default_rng(SEED + length)
    steps = 2 * length
    places = np.sort(rng.integers(0, steps, (walks, bits)), axis=1)
    # Step salts are the same for any length; only the sampled places depend on it.
    salts = np.random.default_rng(SEED).integers(1, 2**62, (walks, steps), dtype=np.uint64)
    padded = np.concatenate((windows, np.full((n, 1), -1, np.int64)), axis=1).astype(np.uint64)
    at = np.zeros((walks, n), np.int64)
    keys = np.zeros((walks, n), np.uint64)
    rows = np.arange(n)
    for j in range(int(places.max()) + 1):
        symbol = padded[rows, at]
        for b in range(bits):
            hit = np.flatnonzero(places[:, b] == j)
            if len(hit):
                keys[hit] = _mixed(keys[hit] ^ symbol[hit]) + np.uint64(b + 1)
        move = _mixed(symbol ^ salts[:, j : j + 1]) >> np.uint64(63)
        at = np.minimum(at + move.astype(np.int64), length)
    return keys


def edits_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any stretch of ``text``, and where the first such stretch ends (bit-parallel)."""
    m = len(item)
    masks: dict[int, int] = {}
    for i, c in enumerate(item.tolist()):
        masks[c] = masks.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = ones, 0, m  # where a column rises or falls by one against the cell above
    best, end = m, 0
    for j, c in enumerate(text.tolist(), 1):
        same = masks.get(c, 0)
        level = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        rises, falls = minus | (ones & ~(across | plus)), plus & across
        score += bool(rises & top) - bool(falls & top)
        rises, falls = rises << 1 & ones, falls << 1 & ones
        plus, minus = falls | (ones & ~(level | rises)), rises & level
        if score < best:
            best, end = score, j
    return best, end


def edited(rng: np.random.Generator, words: list[int], edits: int, vocabulary: int) -> list[int]:
    """``words`` after insertions, deletions and substitutions, as many as bring it to a distance of exactly ``edits``."""
    out, done = list(words), 0
    # One edit changes the distance by one at most, so it is met on the way.
    while done < edits or edits_within(np.array(words), np.array(out, np.int64))[0] < edits:
        kind = int(rng.integers(0, 3))
        p = int(rng.integers(0, len(out) + (kind == 0)))
        out[p : p + (kind > 0)] = [int(rng.integers(1, vocabulary + 1))] * (kind < 2)
        done += 1
    return out


def meetings(length: int, walks: int, share: float = MAX_EDITS, trials: int = 1000, seed: int = 0, vocabulary: int = 5000) -> np.ndarray:
    """Measured share of pieces of ``length`` words that meet a copy with the most edits allowed, after each number of walks."""
    rng = np.random.default_rng(seed)
    k, g = allowed_edits(length, share), gram_length(length, share)
    pieces, windows, owner = [], [], []
    for t in range(trials):
        piece = rng.integers(1, vocabulary + 1, length).tolist()
        around = rng.integers(1, vocabulary + 1, 2 * length).tolist()
        body = around[:length] + edited(rng, piece, k, vocabulary) + around[length:]
        where: dict[tuple, list[int]] = {}
        for q in range(length - g + 1):
            where.setdefault(tuple(piece[q : q + g]), []).append(q)
        runs = [(p, q) for p in range(len(body) - g + 1) for q in where.get(tuple(body[p : p + g]), ())]
        starts = {s for p, q in runs for s in range(p - q - k, p - q + k + 1)}
        pieces.append(piece)
        windows += [[body[x] if 0 <= x < len(body) else -2 for x in range(s, s + length)] for s in sorted(starts)]
        owner += [t] * len(starts)
    keys, owners = cgk_keys(np.array(pieces, np.int64), walks), np.array(owner)
    met = np.zeros((walks, trials), bool)
    for a in range(0, len(windows), 4096):
        own = owners[a : a + 4096]
        for r, equal in enumerate(cgk_keys(np.array(windows[a : a + 4096], np.int64), walks) == keys[:, own]):
            met[r, own[equal]] = True
    return (np.cumsum(met, axis=0) > 0).mean(axis=1)


@lru_cache(maxsize=1024)
def measured_walks(length: int, share: float = MAX_EDITS, recall: float = TARGET_RECALL) -> int:
    """Walks, in steps of 8, after which the measured share of lost pieces is under half of what ``recall`` allows."""
    walks = 64
    while True:
        enough = np.flatnonzero(1 - meetings(length, walks, share) < (1 - recall) / 2)
        if len(enough):
            return -(-(int(enough[0]) + 1) // 8) * 8
        walks *= 2


def walks_for(length: int, share: float = MAX_EDITS) -> int:
    """Walks for a piece of ``length`` words; beyond the table (more edits than MAX_EDITS allows) they are measured now."""
    return WALKS[allowed_edits(length)] if share <= MAX_EDITS else measured_walks(length, share)


@dataclass
class Benchmark:
    """One block of items, ready for matching: vocabulary, surviving-run grams and LSH tables."""

    items: list[tuple[int, str]]
    share: float = MAX_EDITS
    vocabulary: dict[str, int] = field(default_factory=dict)
    codes: list[np.ndarray] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)

    def __post_init__(self):
        for item_id, text in self.items:
            ws = words_of(text or "")
            if ws:
                self.ids.append(item_id)
                self.codes.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], np.int64))
        # (item, start in the item, codes) of every piece.
        self.pieces = [(i, x, c[x:y]) for i, c in enumerate(self.codes) for x, y in pieces_of(len(c))]
        # Gram hash -> (piece length, place in the piece), per gram length.
        self.grams: dict[int, tuple[np.ndarray, dict[int, set]]] = {}
        found: dict[int, dict[int, set]] = {}
        for _, _, c in self.pieces:
            g = gram_length(len(c), self.share)
            own = found.setdefault(g, {})
            for q, h in enumerate(self.gram_hashes(c, g).tolist()):
                own.setdefault(h, set()).add((len(c), q))
        self.grams = {g: (np.array(sorted(own), np.uint64), own) for g, own in found.items()}
        # Per piece length, the LSH table, key of any walk -> pieces, and its keys.
        self.tables: dict[int, tuple[np.ndarray, dict[int, list[int]]]] = {}
        for n in {len(c) for _, _, c in self.pieces}:
            members = [j for j, (_, _, c) in enumerate(self.pieces) if len(c) == n]
            table: dict[int, list[int]] = {}
            for row in self.keys(np.stack([self.pieces[j][2] for j in members])).tolist():
                for j, key in zip(members, row, strict=True):
                    table.setdefault(key, []).append(j)
            self.tables[n] = np.array(sorted(table), np.uint64), table

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """LSH keys of all walks for windows of one length, mixed with the walk's number."""
        keys = cgk_keys(windows, walks_for(windows.shape[1], self.share))
        return _mixed(keys + np.arange(1, len(keys) + 1, dtype=np.uint64)[:, None])

    @staticmethod
    def gram_hashes(codes: np.ndarray, g: int) -> np.ndarray:
        """A hash of each run of g codes; 0, which no lookup holds, where a word is not in the vocabulary."""
        n = len(codes) - g + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        h, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(g):
            part = codes[k : k + n]
            h = _mixed(h + part.astype(np.uint64) + np.uint64(k + 1))
            known &= part > 0
        return np.where(known, h | np.uint64(1), np.uint64(0))

    def encode(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words_of(text)), np.int64)

    def windows(self, codes: np.ndarray) -> set[tuple[int, int]]:
        """(piece length, start) of every piece-sized window around a surviving run, with starts shifted by up to the allowed edits."""
        out = set()
        for g, (known, where) in self.grams.items():
            hashes = self.gram_hashes(codes, g)
            if not len(hashes) or not hashes.any():
                continue
            spots = np.flatnonzero(hashes)
            near = known[np.minimum(np.searchsorted(known, hashes[spots]), len(known) - 1)]
            for p in spots[near == hashes[spots]].tolist():
                for n, q in where[int(hashes[p])]:
                    k = allowed_edits(n, self.share)
                    out.update((n, s) for s in range(p - q - k, p - q + k + 1))
        return out

    def leaks(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(document, item, edits, word after the last of the stretch) for every leaked item, at its smallest distance."""
        by_length: dict[int, list[tuple[int, int]]] = {}
        for d, codes in enumerate(docs):
            for n, start in self.windows(codes):
                by_length.setdefault(n, []).append((d, start))
        # (document, item) -> where the item may start and by how much this may be off.
        met: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for n, places in by_length.items():
            known, table = self.tables[n]
            for a in range(0, len(places), 4096):
                part = places[a : a + 4096]
                # Words beyond a document's ends are a symbol that no item holds.
                rows = np.full((len(part), n), -2, np.int64)
                for row, (d, s) in zip(rows, part, strict=True):
                    own = docs[d][max(0, s) : max(0, s + n)]
                    row[max(0, -s) : max(0, -s) + len(own)] = own
                keys = self.keys(rows)
                equal = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
                for r, w in np.argwhere(equal).tolist():
                    d, s = part[w]
                    for j in table[int(keys[r, w])]:
                        i, x, _ = self.pieces[j]
                        met.setdefault((d, i), set()).add((s - x, allowed_edits(n, self.share)))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for (d, i), starts in met.items():
            n = len(self.codes[i])
            k = allowed_edits(n, self.share)
            spans: list[list[int]] = []
            for low, high in sorted((max(0, s - k - off), s + n + k + off) for s, off in starts):
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
            for low, high in spans:
                edits, end = edits_within(self.codes[i], docs[d][low : max(0, high)])
                if edits <= k and (edits, low + end) < best.get((d, i), (k + 1, 0)):
                    best[d, i] = (edits, low + end)
        return [(d, i, e, end) for (d, i), (e, end) in sorted(best.items())]


@lru_cache(maxsize=1)
def prepared(items: tuple, share: float) -> Benchmark:
    """The last block a worker used; its next task reuses it."""
    return Benchmark(list(items), share)


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple]:
    """The items in blocks of about ``block_bytes`` of text; the driver holds what one task gets."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield tuple(sorted(((r["item_id"], r["text"]) for r in own.collect()), key=repr))


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = MAX_EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, edits, item_words, end_word`` for every item of ``benchmark (item_id, text)`` that leaks into a document."""
    schema = "doc_id long, item_id long, edits int, item_words int, end_word long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = None
    for block in blocks_of(benchmark, block_bytes):

        def run(batches, block=block):
            bench = prepared(block, share)
            for b in batches:
                found = bench.leaks([bench.encode(t) for t in b["text"]])
                yield {
                    "doc_id": [b["doc_id"][d] for d, *_ in found],
                    "item_id": [bench.ids[i] for _, i, _, _ in found],
                    "edits": [e for _, _, e, _ in found],
                    "item_words": [len(bench.codes[i]) for _, i, _, _ in found],
                    "end_word": [end for *_, end in found],
                }

        part = map_rows(rows, run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = MAX_EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that no item leaks into, all columns."""
    for block in blocks_of(benchmark, block_bytes):

        def make(block=block):
            def test(texts):
                bench = prepared(block, share)
                found = {d for d, *_ in bench.leaks([bench.encode(t) for t in texts])}
                return [d not in found for d in range(len(texts))]

            return test

        docs = keep_where(docs, make)
    return docs
