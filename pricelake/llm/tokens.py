"""Token counts of whole texts, huge documents by overlap resynchronisation.

A document above ``chunk_bytes`` is encoded as overlapping chunks with
byte offsets. Two neighbouring chunks are spliced at a boundary inside
their overlap that both encodings show and that is *proven stable*: no
vocabulary piece holds its two neighbouring characters side by side, so no
merge can ever cross it and the tokens on either side do not depend on the
other. If an overlap holds no such boundary it is doubled and encoded again,
up to the whole rest of the text.

Shorter documents are encoded directly; each worker encodes a distinct segment
between stable spaces once.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows each give a row.
Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows

CHUNK_BYTES = 32768
OVERLAP_BYTES = 256
TOKEN_LIMIT = 4096
# Segments of up to so many characters are remembered, until so many characters are.
CACHE_LENGTH, CACHE_CHARS = 64, 8 << 20

SPACE = "▁"  # how the vocabulary writes a space
_SEGMENT = re.compile(r"(?<=[^ ]) ")


class PieceCounter:
    """Counts of one sentencepiece model."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
        self.joined = {pair for p in pieces for pair in zip(p, p[1:])}
        # No piece holds a space after another character: then every such space starts a token of its own.
        self.space_stable = not any(b == SPACE and a != SPACE for a, b in self.joined)
        # UTF-8 bytes that a token stands for.
        self.sizes = np.array([1 if sp.is_byte(i) else len(sp.id_to_piece(i).replace(SPACE, " ").encode()) for i in range(sp.vocab_size())])
        self.known: dict[str, int] = {}
        self.held = 0  # characters of the segments known

    def stable(self, left: str, right: str) -> bool:
        pair = (SPACE if left == " " else left, SPACE if right == " " else right)
        return pair not in self.joined

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets at which the tokens begin and end. Byte 0 is the space the library puts before a text."""
        ends = np.cumsum(self.sizes[np.asarray(self.sp.encode(text), dtype=np.int64)])
        return np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1])), ends

    def splice(self, raw: bytes, left, left_at: int, right, right_at: int):
        """First boundary of both encodings that is stable: tokens of left and of right before it."""
        shift = right_at - left_at
        at, i, j = np.intersect1d(left[0], right[0] + shift, assume_unique=True, return_indices=True)
        for p, x, y in zip((at + left_at - 1).tolist(), i.tolist(), j.tolist(), strict=True):
            if y and x and raw[p] & 0xC0 != 0x80:
                before = p - 1
                while raw[before] & 0xC0 == 0x80:
                    before -= 1
                if self.stable(raw[before:p].decode(), raw[p : p + 4].decode(errors="ignore")[0]):
                    return x, y
        return None

    def count_long(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of ``text`` from chunks of about ``chunk`` bytes that overlap by ``overlap`` bytes or more."""
        raw = text.replace(SPACE, " ").encode()  # the vocabulary holds both as the same character

        def cut(p: int) -> int:
            while p < len(raw) and raw[p] & 0xC0 == 0x80:
                p += 1
            return min(p, len(raw))

        def encoded(a: int, b: int):
            return self.encode(raw[a:b].decode())

        total, skip, at, wide, end = 0, 0, 0, overlap, cut(chunk + overlap)
        left = encoded(0, end)
        while end < len(raw):
            start = cut(max(at + 1, end - wide))
            stop = cut(max(start + chunk, end + wide))
            right = encoded(start, stop)
            met = self.splice(raw, left, at, right, start)
            if met is None:
                # Widen: the left chunk grows to the right, so that the overlap holds more boundaries.
                wide *= 2
                end = cut(end + wide)
                left = encoded(at, end)
                continue
            total += met[0] - skip
            left, skip, at, end, wide = right, met[1], start, stop, overlap
        return total + len(left[0]) - skip

    def count_words(self, words: list[str]) -> list[int]:
        """Tokens of words that neither are empty nor end in a space, each with the space before it: one call encodes all."""
        begins, _ = self.encode(" ".join(words))
        starts = np.cumsum([0] + [1 + len(w.encode()) for w in words])
        return np.diff(np.searchsorted(begins, starts)).tolist()

    def count_batch(self, texts: list[str]) -> list[int]:
        """Counts of short texts. Each distinct segment between stable spaces is encoded once."""
        if not self.space_stable:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        out = []
        for text in texts:
            parts = _SEGMENT.split(text.replace(SPACE, " "))
            # A space that ends the text leaves a part that is empty or spaces only; "" alone stands for no text.
            tail = 0
            if parts[-1][-1:] in ("", " "):
                last = parts.pop()
                tail = len(self.sp.encode(last)) if last or not parts else 1
            known = self.known
            new = list({p for p in parts if p not in known})
            if new:
                if self.held > CACHE_CHARS:
                    known.clear()
                    self.held, new = 0, list(set(parts))
                counts = dict(zip(new, self.count_words(new), strict=True))
                short = [p for p in new if len(p) <= CACHE_LENGTH]
                known.update((p, counts[p]) for p in short)
                self.held += sum(map(len, short))
                # Long segments, whole texts in scripts without spaces, are counted and forgotten.
                total = sum(known[p] if p in known else counts[p] for p in parts) if len(short) < len(new) else sum(map(known.__getitem__, parts))
            else:
                total = sum(map(known.__getitem__, parts))
            out.append(total + tail)
        return out


@lru_cache(maxsize=4)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    overlap_bytes: int = OVERLAP_BYTES,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``; see the module docstring."""

    def run(batches):
        c = counter(model_path)
        for b in batches:
            counts = [0] * len(b["text"])
            short = [i for i, t in enumerate(b["text"]) if b["n_bytes"][i] <= chunk_bytes]
            for i, n in zip(short, c.count_batch([b["text"][i] for i in short]), strict=True):
                counts[i] = n
            for i, t in enumerate(b["text"]):
                if b["n_bytes"][i] > chunk_bytes:
                    counts[i] = c.count_long(t, chunk_bytes, overlap_bytes)
            yield {"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return map_rows(rows, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
