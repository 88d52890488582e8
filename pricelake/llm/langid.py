"""Language identification: a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into segments of ``SEGMENT`` bytes that cover it
whole. A forward and a backward gated recurrent layer read each segment, and a
softmax over both states labels every byte position. A document's
probabilities are the mean over its positions.

The network is trained in numpy by backpropagation through time on a bounded
sample: about ``per_language`` documents of each language, ``SAMPLE_SEGMENTS``
segments spread over each. Prediction reads whole texts.

A text that is null or has no letter is ``und`` with score 0. With no labelled
rows every text is ``und``. Rows that repeat each give a row; a null id counts
as empty text for the fold; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows

SEGMENT, HIDDEN = 64, 8
PER_LANGUAGE, SAMPLE_SEGMENTS = 400, 6
STEPS, BATCH, RATE, CLIP = 260, 128, 0.02, 1.0
# Segments that one pass of the network holds: bounds memory whatever the length of a text.
BLOCK = 4096
UNKNOWN = "und"
PAD = 256  # row of the input table for positions after a segment's end


def segments(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of several texts: codes (n, SEGMENT) padded with PAD, the text of each, real positions of each."""
    counts = [-(-len(r) // SEGMENT) for r in raws]
    codes = np.full((sum(counts), SEGMENT), PAD, np.int16)
    flat = codes.reshape(-1)
    at = 0
    for r, c in zip(raws, counts, strict=True):
        flat[at : at + len(r)] = np.frombuffer(r, np.uint8)
        at += c * SEGMENT
    return codes, np.repeat(np.arange(len(raws)), counts), (codes != PAD).sum(axis=1)


# The gates are hard sigmoids, clip(SLOPE * x + 1/2, 0, 1): as good here as the smooth ones and far cheaper.
SLOPE = 0.25


class Layer:
    """One direction: rows of ``table`` are the input's share of update, reset and candidate; ``u`` and ``c`` the state's."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.params = {
            "table": rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32),
            "u": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 2 * hidden)).astype(np.float32),
            "c": rng.normal(0, 1 / np.sqrt(hidden), (hidden, hidden)).astype(np.float32),
        }
        self.params["table"][:, :hidden] -= 0.5  # start with slower updates

    def states(self, codes: np.ndarray) -> np.ndarray:
        """States after each position, (SEGMENT, hidden, n), for codes of (SEGMENT, n). Hidden-major, so every gate is one block."""
        d = self.hidden
        scale, shift = np.repeat([SLOPE, SLOPE, 1.0], d), np.repeat([0.5, 0.5, 0.0], d)
        inputs = np.ascontiguousarray((self.params["table"] * scale + shift).T, dtype=np.float32)
        u = np.ascontiguousarray((self.params["u"] * SLOPE).T)
        c = np.ascontiguousarray(self.params["c"].T)
        steps, n = codes.shape
        out = np.empty((steps, d, n), np.float32)
        h, a = np.zeros((d, n), np.float32), np.empty((3 * d, n), np.float32)
        zr, t = np.empty((2 * d, n), np.float32), np.empty((d, n), np.float32)
        for s in range(steps):
            np.take(inputs, codes[s], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=zr)
            zr += a[: 2 * d]
            np.clip(zr, 0, 1, out=zr)
            np.multiply(zr[d:], h, out=t)
            cand = out[s]
            np.matmul(c, t, out=cand)
            cand += a[2 * d :]
            np.tanh(cand, out=cand)
            cand -= h
            cand *= zr[:d]
            cand += h
            h = cand
        return out

    def forward(self, codes: np.ndarray):
        """States with what backpropagation needs; codes (steps, n), states row-major here."""
        d, p = self.hidden, self.params
        h = np.zeros((codes.shape[1], d), np.float32)
        kept = []
        for s in range(len(codes)):
            a = p["table"][codes[s]]
            zr = np.clip(SLOPE * (a[:, : 2 * d] + h @ p["u"]) + 0.5, 0, 1)
            z, r = zr[:, :d], zr[:, d:]
            n = np.tanh(a[:, 2 * d :] + (r * h) @ p["c"])
            kept.append((h, z, r, n))
            h = (1 - z) * h + z * n
        return kept, np.stack([(1 - z) * h0 + z * n for h0, z, r, n in kept])

    def backward(self, codes: np.ndarray, kept, d_states: np.ndarray) -> dict[str, np.ndarray]:
        d, p = self.hidden, self.params
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        carry = np.zeros_like(d_states[0])
        for s in range(len(codes) - 1, -1, -1):
            h, z, r, n = kept[s]
            dh = d_states[s] + carry
            dn = dh * z * (1 - n * n)
            dz = SLOPE * dh * (n - h) * ((z > 0) & (z < 1))
            drh = dn @ p["c"].T
            dr = SLOPE * drh * h * ((r > 0) & (r < 1))
            dzr = np.concatenate((dz, dr), axis=1)
            grads["c"] += (r * h).T @ dn
            grads["u"] += h.T @ dzr
            np.add.at(grads["table"], codes[s], np.concatenate((dzr, dn), axis=1))
            carry = dh * (1 - z) + drh * r + dzr @ p["u"].T
        return grads


@dataclass
class LanguageModel:
    languages: list[str]
    ahead: Layer | None = None
    back: Layer | None = None
    out: np.ndarray | None = None  # (2 * hidden + 1, languages), the last row the bias

    def position_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Label probabilities of every position, (SEGMENT, languages, n), for segments (n, SEGMENT)."""
        steps = np.ascontiguousarray(codes.T)
        d = self.ahead.hidden
        h1 = self.ahead.states(steps)
        h2 = self.back.states(steps[::-1])[::-1]
        logits = np.matmul(self.out[:d].T, h1)
        logits += np.matmul(self.out[d : 2 * d].T, h2)
        logits += self.out[2 * d][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def probabilities(self, raws: list[bytes]) -> np.ndarray:
        """Mean over all positions of each text, (texts, languages)."""
        codes, owner, sizes = segments(raws)
        total = np.zeros((len(raws), len(self.languages)))
        for a in range(0, len(codes), BLOCK):
            part = codes[a : a + BLOCK]
            p = self.position_probabilities(part)
            if sizes[a : a + BLOCK].min() < SEGMENT:
                p *= (part != PAD).T[:, None, :]
            np.add.at(total, owner[a : a + BLOCK], p.sum(axis=0).T)
        return total / np.maximum(1, [[len(r)] for r in raws])


def train(languages: list[str], samples: list[tuple[bytes, int]], seed: int = 7) -> LanguageModel:
    """Adam on the cross-entropy of every position."""
    if not samples:
        return LanguageModel([])
    rng = np.random.default_rng(seed)
    model = LanguageModel(languages, Layer(rng, HIDDEN), Layer(rng, HIDDEN))
    model.out = rng.normal(0, 0.3, (2 * HIDDEN + 1, len(languages))).astype(np.float32)
    codes, owner, _ = segments([s for s, _ in samples])
    labels = np.array([k for _, k in samples])[owner]
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    groups = [g for g in groups if len(g)]
    moments: dict[int, list[np.ndarray]] = {}
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
        x, y = np.ascontiguousarray(codes[rows].T), labels[rows]
        kept_1, h1 = model.ahead.forward(x)
        kept_2, h2 = model.back.forward(x[::-1])
        h2 = h2[::-1]
        both = np.concatenate((h1, h2, np.ones((*h1.shape[:2], 1), np.float32)), axis=2)
        logits = both @ model.out
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(len(y)), y] -= 1
        real = (x != PAD)[:, :, None]
        p = (p * real / max(1, real.sum())).astype(np.float32)
        d_out = np.tensordot(both, p, axes=((0, 1), (0, 1)))
        d_both = p @ model.out.T
        g1 = model.ahead.backward(x, kept_1, d_both[:, :, :HIDDEN])
        g2 = model.back.backward(x[::-1], kept_2, d_both[::-1, :, HIDDEN : 2 * HIDDEN])
        pairs = [(model.ahead.params[k], g1[k]) for k in g1] + [(model.back.params[k], g2[k]) for k in g2] + [(model.out, d_out)]
        norm = np.sqrt(sum(float((g * g).sum()) for _, g in pairs))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, (value, grad) in enumerate(pairs):
            grad = grad * min(1.0, CLIP / max(norm, 1e-12))
            m = moments.setdefault(k, [np.zeros_like(value), np.zeros_like(value)])
            m[0] = 0.9 * m[0] + 0.1 * grad
            m[1] = 0.99 * m[1] + 0.01 * grad * grad
            value -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return model


def held_out(id_col) -> F.Column:
    """Rows that training never reads: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Train on about ``per_language`` labelled documents of each language, drawn by id hash outside the held-out rows."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([])
    shares = F.create_map(*(x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, per_language / counts[lang])))))
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 30)) / float(1 << 30)
    picked = known.where(draw < shares[F.col("lang")])
    code = {lang: k for k, lang in enumerate(languages)}

    def run(batches):
        for b in batches:
            pieces, labels = [], []
            for text, lang in zip(b["text"], b["lang"], strict=True):
                raw = text.encode()
                last = max(0, len(raw) - SEGMENT)
                for at in sorted({last * k // max(1, SAMPLE_SEGMENTS - 1) for k in range(SAMPLE_SEGMENTS)}):
                    if raw[at : at + SEGMENT].strip():
                        pieces.append(bytes(raw[at : at + SEGMENT]))
                        labels.append(code[lang])
            yield {"piece": pieces, "label": labels}

    rows = map_rows(picked.select("lang", "text"), run, "piece binary, label int").collect()
    return train(languages, sorted((bytes(r["piece"]), r["label"]) for r in rows))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, from its text alone."""

    def run(batches):
        for b in batches:
            languages, scores = [UNKNOWN] * len(b["doc_id"]), [0.0] * len(b["doc_id"])
            rows = [i for i, letters in enumerate(b["letters"]) if letters and model.languages]
            if rows:
                p = model.probabilities([b["text"][i].encode() for i in rows])
                for i, row in zip(rows, p, strict=True):
                    languages[i], scores[i] = model.languages[int(row.argmax())], float(min(1.0, row.max()))
            yield {"doc_id": b["doc_id"], "lang_pred": languages, "score": scores}

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    return map_rows(rows, run, "doc_id long, lang_pred string, score double")
