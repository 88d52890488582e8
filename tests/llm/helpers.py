"""Shared rows of the operator tests: nulls, empty and long texts, repeats, clashing columns."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"long{i % 997}x{i % 31}" for i in range(9000))
EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "one", None, "a", 3),
    (5, LONG, "en", "b", len(LONG)),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG + " and a little more", "en", "b", 1),
    (None, "a text that nobody numbered", "en", None, 1),
    (7, "12345 67890 !!!", "en", "c", 1),
    (8, "né à côté du café, 世界 𐍈", "fr", "c", 1),
]


def edge_docs(spark):
    """The edge rows with extra columns whose names operators use inside."""
    rows = [(*r, "x", 1, 2.0) for r in EDGE]
    return spark.createDataFrame(rows, DOCS + ", digest string, words int, score double")


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
