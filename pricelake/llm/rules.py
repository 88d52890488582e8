"""Quality rules as a bitmask ledger.

Every rule is evaluated once. The ledger holds, per document, the measurements
and one bit per failed rule. A policy is a versioned mask over these bits:
applying one, comparing versions, or asking what a rule costs (its ablation)
is bit arithmetic over the ledger and never reads a text again.

All of it is DataFrame expressions; one pass over the texts and no shuffle.
Only the ablation aggregates, over at most 2^rules distinct masks.

Null texts have no words. Repeated rows each give a row. Other columns are
ignored. An empty table gives an empty ledger and no ablation rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import WORD_RE

NO_SYMBOL_RE = r"[^#*$%&|<>]+"
SPACE_RE = r"[\x20\x09-\x0D]+"

# Rule name -> condition over the measurements under which a document fails. The bit is the rule's place here;
# new rules go to the end, so that older ledgers stay readable.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "duplicate_lines": "n_lines >= 4 and 2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 40 * n_words",
}
BASE_RULES = ("too_few_words", "repeated_windows")
# Policy version -> rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE_RULES,
    "v2": (*BASE_RULES, "symbols", "duplicate_lines"),
    "v3": tuple(RULES),
}
CURRENT_POLICY = "v3"


def mask(rules) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


# A window's place in its text takes this many bits of a sort key, the rest are its hash.
_PLACE_BITS = 24


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``.

    Hashes decide the common case: if all window hashes differ, so do the
    windows. Otherwise keys of hash and place are sorted as plain longs and
    neighbours with equal hashes compared word by word. If any two of them
    differ after all, or a text has more windows than places, the windows
    themselves are sorted instead.
    """

    def bound(value: Column, f) -> Column:
        # A lambda variable evaluates ``value`` once, however often ``f`` names it.
        return F.transform(F.array(value), f)[0]

    def windows(w, make):
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: make(x, F.get(w, i + 1), F.get(w, i + 2), i))

    def covered(places):
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

    def by_windows(w):
        ordered = F.sort_array(windows(w, lambda a, b, c, i: F.struct(F.struct(a, b, c).alias("w"), i.alias("i"))))

        def repeated(s):
            return F.filter(s, lambda e, j: (F.get(s, j - 1)["w"] == e["w"]) | (F.get(s, j + 1)["w"] == e["w"]))

        return bound(ordered, lambda s: covered(F.transform(repeated(s), lambda e: e["i"])))

    def by_keys(w, hashes):
        place = F.lit((1 << _PLACE_BITS) - 1)
        keys = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long"))))

        def hash_of(key):
            return F.shiftright(key, _PLACE_BITS)

        def place_of(key):
            return key.bitwiseAND(place).cast("int")

        def differ(x, y):
            return (F.get(w, x) != F.get(w, y)) | (F.get(w, x + 1) != F.get(w, y + 1)) | (F.get(w, x + 2) != F.get(w, y + 2))

        def counted(s):
            near = F.filter(s, lambda e, j: (hash_of(F.get(s, j - 1)) == hash_of(e)) | (hash_of(F.get(s, j + 1)) == hash_of(e)))

            def checked(n):
                clash = F.filter(
                    n, lambda e, j: (hash_of(F.get(n, j - 1)) == hash_of(e)) & differ(place_of(F.get(n, j - 1)), place_of(e))
                )
                return F.when(F.size(clash) > 0, by_windows(w)).otherwise(covered(F.transform(n, place_of)))

            return bound(near, checked)

        return bound(keys, counted)

    def counted(w):
        def from_hashes(h):
            unique = F.size(F.array_distinct(h)) == F.size(h)
            return F.when(unique, 0).when(F.size(h) >= 1 << _PLACE_BITS, by_windows(w)).otherwise(by_keys(w, h))

        return F.when(F.size(w) < 3, 0).otherwise(bound(windows(w, lambda a, b, c, i: F.xxhash64(a, b, c)), from_hashes))

    return bound(words, counted).cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits`` of every document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "words", F.regexp_extract_all("text", F.lit(f"({WORD_RE})"), F.lit(1))
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_RE))
    measured = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE_RE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", NO_SYMBOL_RE, "")).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda a: F.struct(F.size(a).alias("n"), F.size(F.array_distinct(a)).alias("d")))[0].alias("lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
    ).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("lines.n").cast("long").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    bits = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(0) for i, rule in enumerate(RULES.values())), F.lit(0).cast("long"))
    return measured.withColumn("fail_bits", bits.cast("long"))


def apply_policy(rows: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """The ledger with ``kept`` under a policy version."""
    return rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(rows: DataFrame, policy: str = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects (kept if it were dropped)."""
    masks = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("long").alias("bit")) for r in POLICIES[policy]))
    per_rule = masks.select("bits", "n", F.explode(rules).alias("r")).where(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
    return per_rule.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum("n").alias("failed"), F.sum(F.when(F.bit_count("bits") == 1, F.col("n")).otherwise(0)).alias("failed_alone")
    )
