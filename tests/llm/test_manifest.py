import random
import zlib

import pytest
from helpers import EDGE, edge_docs, no_docs, rows_of, sha

from pricelake.llm import manifest


def runs(nodes):
    return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]


def climb(nodes):
    """All levels of a list of digests, the lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(r)) for r in runs(levels[-1])])
    return levels


def path(levels, i):
    """(left, right) siblings of node i on every level."""
    out = []
    for level in levels[:-1]:
        a = i - i % 8
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 8])))
        i //= 8
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, text, lang, source, n_chars)."""

    def leaf(doc_id, text, lang, source, n_chars):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    groups = {}
    for r in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "") if r[1] is not None else None
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups.setdefault(r[2], []).append((r[0], leaf(*r), leaf(r[0], lower, *r[2:]) if tampered else leaf(*r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = climb([x[1] for x in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (doc_id, own, claim) in enumerate(groups[g]):
            proof = path(trees[g], i) + path(top, k)
            for left, right in proof:
                claim = sha(left + claim + right)
            out.append((doc_id, own, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in proof)), claim, claim == top[-1][0]))
    return sorted(out, key=repr)


def query(docs, levels=manifest.LEVELS):
    rows = manifest.manifest(manifest.document_leaves(docs), levels)
    return rows.select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_equal_to_brute_force(spark, levels):  # with small blocks there are many rounds
    rnd = random.Random(levels)
    langs = [None, "", "en", "é", "zz", "one"] + [f"l{i}" for i in range(11)]
    sizes = [1, 8, 9, 700, 64, 65] + [rnd.randint(1, 30) for _ in range(11)]
    rows = [(i, rnd.choice(["Text", "text", None, ""]) , lang, rnd.choice(["a", None]), i % 7) for lang, n in zip(langs, sizes) for i in rnd.sample(range(10**6), n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert rows_of(query(docs, levels)) == brute(rows)


def test_edge_rows_and_empty_table(spark):
    # Identical rows differ in their places, and so in their proofs, but in nothing else.
    got = rows_of(query(edge_docs(spark)))
    assert got == brute(EDGE)
    assert query(no_docs(spark)).count() == 0


def test_one_row(spark):
    ((_, leaf, subroot, root, proof, folded, verified),) = query(edge_docs(spark).where("doc_id = 4")).collect()
    assert leaf == subroot == root == folded and proof == sha("") and verified


def test_proofs_fold_to_the_root_and_nothing_else_does(spark):
    rows = [(i, f"g{i % 3}", sha(str(i)), None) for i in range(300)]
    out = manifest.manifest(spark.createDataFrame(rows, "key long, grp string, leaf string, claim string")).collect()
    assert len({r.root for r in out}) == 1 and all(r.verified for r in out)
    for r in out:
        assert manifest.folded(r.leaf, r.proof) == r.root != manifest.folded(sha("x"), r.proof)
