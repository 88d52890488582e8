import random

import public_tokenizers
import pytest
from helpers import EDGE, edge_docs, no_docs, rows_of

from pricelake.llm.tokens import counter, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*"ab the  ▁ \n\té世界𐍈<>s/0x ing", "</s>", "<s>", "  ", "<0x0A>", "ing", "the"]


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_the_library(seed):
    c, rnd = counter(MODEL), random.Random(seed)
    for _ in range(400):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 90)))
        n = len(c.sp.encode(text))
        assert c.count_batch([text]) == [n]
        assert c.count_long(text, rnd.randint(5, 30), rnd.randint(1, 8)) == n


def test_overlaps_widen_where_no_boundary_is_stable():
    c = counter(MODEL)
    text = "the" * 3000  # one word: only pairs that no piece joins can part it
    assert c.count_long(text, 200, 4) == len(c.sp.encode(text))
    assert c.count_long("ab " * 3000, 200, 4) == len(c.sp.encode("ab " * 3000))


def test_query_rows(spark):
    c = counter(MODEL)
    expected = sorted(((i, len((t or "").encode()), len(c.sp.encode(t or "")), len(c.sp.encode(t or "")) > 4096) for i, t, *_ in EDGE), key=repr)
    assert rows_of(token_counts(edge_docs(spark), MODEL)) == expected
    assert rows_of(token_counts(edge_docs(spark), MODEL, chunk_bytes=64, overlap_bytes=8)) == expected
    assert rows_of(token_counts(no_docs(spark), MODEL)) == []


def test_long_segments_are_counted_and_not_kept(monkeypatch):
    from pricelake.llm import tokens

    c = tokens.PieceCounter(MODEL)
    monkeypatch.setattr(tokens, "CACHE_CHARS", 2000)
    rnd = random.Random(11)
    for _ in range(60):
        text = " ".join("".join(rnd.choice("世界né") for _ in range(rnd.choice([3, 500]))) for _ in range(rnd.randint(1, 9)))
        assert c.count_batch([text, text]) == [len(c.sp.encode(text))] * 2
    assert max(map(len, c.known)) <= tokens.CACHE_LENGTH and sum(map(len, c.known)) == c.held <= 2000 + 9 * 64
