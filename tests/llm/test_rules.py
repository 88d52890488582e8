import collections
import random

from helpers import EDGE, WORD, edge_docs, no_docs, rows_of

from pricelake.llm import rules


def measure(text):
    text = text or ""
    words = WORD.findall(text)
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    again = {j for i, t in enumerate(zip(words, words[1:], words[2:])) if triples[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
    }


def test_measurements_and_bits(spark):
    rnd = random.Random(1)
    texts = [t for _, t, *_ in EDGE]
    for _ in range(60):
        texts.append("".join(rnd.choice(["a", "b", "c#", "\n", " ", " ", "d|e", "\x0b", "\xa0", "é "]) for _ in range(rnd.randint(0, 200))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rules.ledger(docs).collect():
        want = measure(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
        failed = [want["n_words"] < 50, 100 * want["n_repeat_words"] > 50 * want["n_words"], 10 * want["n_symbols"] > want["word_chars"],
                  want["n_lines"] >= 4 and 2 * want["n_dup_lines"] > want["n_lines"], want["word_chars"] < 2 * want["n_words"],
                  want["word_chars"] > 40 * want["n_words"]]
        assert r.fail_bits == sum(1 << i for i, f in enumerate(failed) if f)


def test_policies_and_ablation(spark):
    rows = rules.ledger(edge_docs(spark))
    assert rows.count() == len(EDGE)
    base = rules.mask(rules.BASE_RULES)
    kept = rules.apply_policy(rows, "v1").collect()
    assert all(r.kept == (r.fail_bits & base == 0) for r in kept)
    cost = {r.rule: (r.failed, r.failed_alone) for r in rules.ablation(rows, "v1").collect()}
    bits = [r.fail_bits & base for r in kept]
    assert cost["too_few_words"] == (sum(b & 1 for b in bits), sum(b == 1 for b in bits))
    assert rows_of(rules.apply_policy(rules.ledger(no_docs(spark)))) == [] == rows_of(rules.ablation(rules.ledger(no_docs(spark))))


def test_sort_of_windows_agrees_with_sort_of_keys(spark, monkeypatch):
    texts = ["a b c a b c d a b", "x " * 40, "p q r s t u", "a b c x a b c y a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by_keys = rows_of(rules.ledger(docs))
    monkeypatch.setattr(rules, "_PLACE_BITS", 2)  # texts then have more windows than places
    assert rows_of(rules.ledger(docs)) == by_keys
