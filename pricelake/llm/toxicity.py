"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed and of a learned lexicon (words,
and the first STEM letters of longer ones, as insults inflect), hits near a
second-person word, capitals, punctuation, and hits that show only
after undoing obfuscation (digits and signs for letters, spelled-out or
stretched letters, starred-out letters).

Training reads a bounded sample of labelled rows: at most ``max_per_class``
documents of each label, those with the smallest id hashes, weighted back to
the label's share. A third of it is kept from the trees and fits the isotonic
curve. Scoring maps over all texts with the model in the task.

A null or empty text scores as a text without words. Null labels are no
labels. With no labels at all every score is 0; with one label only it is that
label. Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows, written

MAX_PER_CLASS = 3000
# Trees and their growth.
ROUNDS, DEPTH, RATE, BINS, MIN_LEAF, RIDGE = 40, 3, 0.2, 32, 5.0, 1.0
# A learned entry is in at least so many toxic sample documents, this share of them, and this many times likelier there.
MIN_DOCS, MIN_SHARE, MIN_RATIO, MIN_STEM_RATIO, MAX_LEARNED = 8, 0.01, 60.0, 200.0, 400
STEM = 4  # letters of a stem; a learned stem is written with a "^" before it
NEAR, WINDOW = 4, 40

# Common English insults.
SEED_LEXICON = (
    "airhead bastard bitch bitches bollocks bonehead brainless buffoon clown coward crap cretin cunt degenerate dickhead "
    "dimwit dipshit disgusting dolt douche douchebag dumb dumbass dummy dunce failure fool freak fuck fucker fucking garbage "
    "halfwit hypocrite idiot idiotic idiots imbecile jackass jerk liar loser losers lowlife lunatic maggot moron moronic morons "
    "motherfucker nitwit numbskull parasite pathetic pervert pig prick psycho retard scum scumbag scumbags shit shithead simpleton "
    "slut sucker swine thug traitor trash twat twit useless vermin weakling weirdo whore worm worthless wretch stupid"
).split()
# Second-person words.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur youre du dich dir dein deine tu te toi ton ta vous votre usted ustedes vosotros".split())
# Signs and digits that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

FEATURES = (
    "seed_density", "learned_density", "log_hits", "distinct_hits", "densest_window", "near_second_person",
    "second_person_density", "log_obfuscated", "capitals", "shouted_words", "exclamations", "questions", "punctuation",
    "digits", "log_words",
)

_WORDS = re.compile(r"[^\W_]+")
_EDGE = re.compile(r"^\W+|\W+$")
_STRETCH = re.compile(r"(.)\1{2,}")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")

# Byte classes: 0 other, 1 capital, 2 small letter, 3 digit, 4 "!", 5 "?", 6 other punctuation.
_CLASS = np.zeros(256, np.uint8)
for _c in range(33, 127):
    _CLASS[_c] = 1 if chr(_c).isupper() else 2 if chr(_c).islower() else 3 if chr(_c).isdigit() else 4 if _c == 33 else 5 if _c == 63 else 6


def undisguised(token: str, lexicon: frozenset, by_length: dict[int, list[str]]) -> str | None:
    """The lexicon word that a token with signs inside stands for, if any."""
    core = _EDGE.sub("", token)
    if not core or core.isalpha() and not _STRETCH.search(core):
        return None
    if "*" in core:
        fits = [w for w in by_length.get(len(core), ()) if all(a in ("*", b) for a, b in zip(core, w, strict=True))]
        if fits and core.count("*") < len(core) - 1:
            return fits[0]
    plain = re.sub(r"[^a-z]", "", core.translate(LEET))
    for guess in (plain, _STRETCH.sub(r"\1", plain), _STRETCH.sub(r"\1\1", plain)):
        if guess in lexicon:
            return guess
    return None


class Featurizer:
    def __init__(self, learned: list[str]):
        self.learned = frozenset(w for w in learned if w[0] != "^")
        self.stems = frozenset(w[1:] for w in learned if w[0] == "^")
        self.seed = frozenset(SEED_LEXICON)
        self.all = self.seed | self.learned
        self.by_length: dict[int, list[str]] = {}
        for w in sorted(self.all):
            self.by_length.setdefault(len(w), []).append(w)

    def __call__(self, text: str) -> list[float]:
        low = text.lower()
        words = _WORDS.findall(low)
        n = max(1, len(words))
        known, stems = self.all, self.stems
        hits = [i for i, w in enumerate(words) if w in known or w[:STEM] in stems and len(w) > STEM]
        second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        # Spelled-out words first ("i.d.i.o.t" is a token; "i d i o t" is not), then tokens with signs inside.
        odd = [t for t in low.split() if not t.isalpha()]
        if _STRETCH.search(low):
            odd += [t for t in words if len(t) > 3 and _STRETCH.search(t)]
        disguised = sum(1 for t in odd if _EDGE.sub("", t) not in self.all and undisguised(t, self.all, self.by_length))
        near = 0
        if hits and second:
            s = np.asarray(second)
            h = np.asarray(hits)
            k = np.searchsorted(s, h)
            gap = np.minimum(np.abs(s[np.minimum(k, len(s) - 1)] - h), np.abs(s[np.maximum(k - 1, 0)] - h))
            near = int((gap <= NEAR).sum())
        densest = max((np.searchsorted(hits, h + WINDOW) - i for i, h in enumerate(hits)), default=0) if hits else 0
        found = [words[i] for i in hits]
        kinds = np.bincount(_CLASS[np.frombuffer(text.encode(), np.uint8)], minlength=7)
        chars = max(1, len(text))
        letters = max(1, int(kinds[1] + kinds[2]))
        return [
            100 * sum(w in self.seed for w in found) / n,
            100 * sum(w in self.learned or w[:STEM] in stems for w in found) / n,
            float(np.log1p(len(hits))),
            float(len(set(found))),
            float(densest),
            100 * near / n,
            100 * len(second) / n,
            float(np.log1p(disguised)),
            float(kinds[1]) / letters,
            len(_SHOUT.findall(text)) / n,
            float(kinds[4]) / chars,
            float(kinds[5]) / chars,
            float(kinds[6]) / chars,
            float(kinds[3]) / chars,
            float(np.log1p(len(words))),
        ]


@dataclass
class Trees:
    """Complete trees of one depth in level order: a node's feature and threshold, a leaf's value."""

    base: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> Trees:
    """Logistic boosting; each split maximises the second-order gain over quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    rate = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
    model = Trees(base=float(np.log(rate / (1 - rate))))
    f = np.full(len(x), model.base)
    inner = 2**DEPTH - 1
    features, cuts, leaves = [], [], []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-f))
        g, h = w * (y - p), w * np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(x), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = 1e-9
            if len(rows):
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for c, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[rows, c]
                    gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                    gain = gl**2 / (hl + RIDGE) + (total_g - gl) ** 2 / (total_h - hl + RIDGE) - total_g**2 / (total_h + RIDGE)
                    gain[(nl < MIN_LEAF) | (len(rows) - nl < MIN_LEAF)] = -1
                    if gain.max() > best:
                        best, feature[k], cut[k] = gain.max(), c, e[int(gain.argmax())]
            if len(rows):
                node[rows] = 2 * k + 1 + (x[rows, feature[k]] > cut[k])
        slot = node - inner
        size = inner + 1
        value = RATE * np.bincount(slot, g, size) / (np.bincount(slot, h, size) + RIDGE)
        f += value[slot]
        features.append(feature)
        cuts.append(cut)
        leaves.append(value)
    model.feature, model.cut, model.leaf = np.array(features), np.array(cuts), np.array(leaves)
    return model


def fit_isotonic(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots of a rising curve from margin to probability."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # weighted sum, weight, lowest and highest margin
    for m, t, v in zip(margin[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        blocks.append([t * v, v, m, m])
        while len(blocks) > 1 and (blocks[-2][3] == blocks[-1][2] or blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]):
            s, v2, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += v2
            blocks[-1][3] = hi
    knots = [(x, b[0] / b[1]) for b in blocks for x in dict.fromkeys((b[2], b[3]))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


@dataclass
class ToxicityModel:
    learned: list[str]
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray] | None

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.knots is None:
            return np.full(len(texts), self.trees.base)
        make = Featurizer(self.learned)
        if not texts:
            return np.zeros(0)
        return np.interp(self.trees.margin(np.array([make(t) for t in texts])), *self.knots)


def text_mark(text) -> F.Column:
    """The smallest hash of a text's 3-word runs: near copies mostly share it, other texts do not."""

    def least(w):
        runs = F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) >= 3, F.array_min(runs)).otherwise(F.xxhash64(w))

    return F.transform(F.array(F.split(F.lower(text), r"\s+")), least)[0]


def learned_words(sample: DataFrame) -> list[str]:
    """At most MAX_LEARNED words and stems that toxic documents of ``sample (toxic, text)`` use far more often.

    Toxic documents count once per mark, or every rare word of a much copied one would look like an insult.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    stems = F.transform(F.filter("words", lambda w: F.length(w) > STEM), lambda w: F.concat(F.lit("^"), F.substring(w, 1, STEM)))
    marked = sample.select("toxic", text_mark(F.col("text")).alias("mark"), words.alias("words"))
    toxic_mark = F.when(F.col("toxic") == 1, F.col("mark"))
    totals = marked.agg(F.count_distinct(toxic_mark).alias("t"), F.sum(1 - F.col("toxic")).alias("f")).first()
    entries = marked.select("toxic", "mark", F.explode(F.array_distinct(F.concat("words", stems))).alias("word"))
    counts = entries.groupBy("word").agg(F.count_distinct(toxic_mark).alias("t"), F.sum(1 - F.col("toxic")).alias("f"))
    rate_1, rate_0 = F.col("t") / totals["t"], (F.col("f") + 0.5) / totals["f"]
    ratio = F.when(F.col("word").startswith("^"), MIN_STEM_RATIO).otherwise(MIN_RATIO)
    kept = counts.where((F.col("t") >= MIN_DOCS) & (rate_1 >= MIN_SHARE) & (rate_1 >= ratio * rate_0))
    return [r["word"] for r in kept.orderBy((rate_1 / rate_0).desc(), "word").limit(MAX_LEARNED).collect()]


def held_out(id_col) -> F.Column:
    """Rows whose labels are never read: crc32 of the id as text divisible by 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> ToxicityModel:
    """Fit on a bounded sample of ``labels (doc_id, toxic)`` outside the held-out rows."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return ToxicityModel([], Trees(base=float(next(iter(totals), 0))), None)
    rank = F.xxhash64("doc_id")
    picks = [known.where(F.col("toxic") == c).orderBy(rank, "doc_id").limit(max_per_class) for c in (0, 1)]
    # At most 2 * max_per_class rows of an id and a label: a proven bound for the broadcast.
    chosen = F.broadcast(picks[0].union(picks[1]))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = written(spark, rows.join(chosen, "doc_id"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel([], Trees(base=float(next(iter(sizes), 0))), None)
    learned = learned_words(sample)

    def run(batches):
        make = Featurizer(learned)
        for b in batches:
            yield {"doc_id": b["doc_id"], "toxic": b["toxic"], "x": [make(t) for t in b["text"]]}

    got = map_rows(sample.select("doc_id", "toxic", "text"), run, "doc_id long, toxic int, x array<double>").collect()
    got.sort(key=lambda r: (r["doc_id"], r["toxic"], r["x"]))
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], float)
    w = np.where(y == 1, totals[1] / sizes[1], totals[0] / sizes[0])
    w /= w.mean()
    turn = np.zeros(len(y), bool)
    for c in (0, 1):  # every third row of each label calibrates
        turn[np.flatnonzero(y == c)[2::3]] = True
    if len(set(y[turn])) < 2:
        turn[:] = True
    fit_on = ~turn if len(set(y[~turn])) == 2 else np.ones(len(y), bool)
    trees = fit_trees(x[fit_on], y[fit_on], w[fit_on])
    return ToxicityModel(learned, trees, fit_isotonic(trees.margin(x[turn]), y[turn], w[turn]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs``."""

    def run(batches):
        for b in batches:
            s = np.clip(model.scores(b["text"]), 0, 1)
            yield {"doc_id": b["doc_id"], "score": s.tolist(), "predicted": (s >= 0.5).astype(int).tolist()}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_rows(rows, run, "doc_id long, score double, predicted int")
