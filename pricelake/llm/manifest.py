"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf: a hash of its fields. Within a group (a language, say) the
leaves stand in key order; every ``FANOUT`` consecutive nodes become their hash
until one is left, the group's subroot, and the subroots of all groups become
the root in the same way. A leaf's proof holds its siblings on every level.

Forward: a node's label is the place of the last leaf below it and its level.
Digests are messages to the parent's label; a queue ordered by label hands them
over once all children have sent theirs. Spark is that queue on the outside:
nodes are dealt by block (``FANOUT ** LEVELS`` consecutive nodes of a group)
and sorted by place, in an external sort. Within a task a heap holds the
messages of the block that runs, at most FANOUT a level. The tops of the blocks
are the nodes of the next round, so 10^12 leaves need four rounds.

Backward: the same rounds in reverse. The block's top receives the suffix of
its proof as a message that sorts before the block's nodes; the sweep goes from
the top's label down and gives each child its siblings and the suffix, and
the leaves' round ends with whole proofs. A block (4,096 digests) is all a task holds.

Places come from a range sort by group, key and leaf, numbered per partition
with the counts before it: no group is ever in one task, however hot. All
levels pass only digests, never texts; each round is a written table, so a
lost executor costs a re-read.

Null keys come first, a null group is a group of its own and comes first. Rows
that tie are ordered by leaf, and identical rows among themselves in any way
(they differ in nothing but their proofs). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows, placed, written

FANOUT, LEVELS = 8, 4
TAMPER_EVERY = 3


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_digest(*columns) -> F.Column:
    """The leaf of a row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its value, hashed together."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)).cast("binary"), 256)


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


# --- forward


def _forward(blocks: Iterator[tuple], levels: int) -> Iterator[tuple]:
    """``(grp, block, n above, digest)`` of every block of rows ``(grp, block, place, n, digest)`` in order."""
    queue: list[tuple[int, int, int, str]] = []  # (last leaf below the target, its level, sender's place, digest)
    for grp, block, place, n, digest in blocks:
        top = min(levels, levels_of(n))
        if not top:
            yield grp, block, 1, digest
            continue

        def send(level, at, message):
            """To the parent of node ``at`` of the level below ``level``."""
            last = min((at // FANOUT + 1) * FANOUT**level, n) - 1
            heapq.heappush(queue, (last, level, at, message))

        send(1, place, digest)
        while queue and queue[0][0] <= place:
            last, level, at, _ = queue[0]
            found = []
            while queue and queue[0][:2] == (last, level):
                found.append(heapq.heappop(queue)[3])
            if level == top:
                yield grp, block, -(-n // FANOUT**levels), digest_of(*found)
            else:
                send(level + 1, at // FANOUT, digest_of(*found))


def _blocks(nodes: DataFrame, levels: int, *extra) -> DataFrame:
    return nodes.select("grp", F.expr(f"place div {FANOUT**levels}").alias("block"), "place", "n", "digest", *extra)


def _next_round(nodes: DataFrame, levels: int) -> DataFrame:
    dealt = _blocks(nodes, levels).repartition("grp", "block").sortWithinPartitions("grp", "block", "place")

    def run(batches):
        rows = (r for b in batches for r in zip(b["grp"], b["block"], b["place"], b["n"], b["digest"], strict=True))
        for grp, block, n, digest in _forward(rows, levels):
            yield {"grp": [grp], "place": [block], "n": [n], "digest": [digest]}

    return map_rows(dealt, run, "grp long, place long, n long, digest string")


def rounds_of(nodes: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """The rounds of ``nodes (grp, place, n, digest)``, the given ones first; in the last one each group has one node."""
    rounds = [nodes]
    while not rounds[-1].where("n > 1").isEmpty():
        rounds.append(written(nodes.sparkSession, _next_round(rounds[-1], levels), name))
    return rounds


# --- backward: a proof is text, one level after another: "left siblings,right siblings;"


def _levels(digests: list[str], top: int) -> list[list[str]]:
    out = [digests]
    for _ in range(top):
        below = out[-1]
        out.append([digest_of(*below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def _suffixes(digests: list[str], n: int, suffix: str, levels: int) -> list[str]:
    """The proof of every node of a block whose top has the proof ``suffix``."""
    told = [suffix]
    for level in reversed(_levels(digests, min(levels, levels_of(n)))[:-1]):
        below = []
        for i in range(len(level)):
            a = i - i % FANOUT
            below.append(f"{''.join(level[a:i])},{''.join(level[i + 1 : a + FANOUT])};{told[i // FANOUT]}")
        told = below
    return told


def folded(digest: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    for level in proof.split(";")[:-1]:
        left, right = level.split(",")
        digest = digest_of(left, digest, right)
    return digest


def _told(batches, levels: int, extra: tuple[str, ...] = ()) -> Iterator[tuple]:
    """``(message, nodes, proofs)`` per block of rows that begin with the block's message."""
    names = ("grp", "block", "place", "n", "digest", "suffix", "subroot", "root", *extra)
    message, nodes = None, []
    for b in batches:
        for row in zip(*(b[k] for k in names), strict=True):
            if row[5] is not None:
                if nodes:
                    yield message, nodes, _suffixes([x[4] for x in nodes], nodes[0][3], message[5], levels)
                message, nodes = row, []
            else:
                nodes.append(row)
    if nodes:
        yield message, nodes, _suffixes([x[4] for x in nodes], nodes[0][3], message[5], levels)


def _delivered(nodes: DataFrame, messages: DataFrame, levels: int, *extra: str) -> DataFrame:
    """Blocks of ``nodes``, each after its message ``(grp, place of the block, suffix, subroot, root)``, dealt and sorted."""
    none = [F.lit(None).cast("string").alias(c) for c in ("suffix", "subroot", "root")]
    own = _blocks(nodes, levels, *none, *extra)
    kinds = {f.name: f.dataType for f in own.schema}
    sent = messages.select("grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("n"),
                           F.lit(None).cast("string").alias("digest"), "suffix", "subroot", "root", *(F.lit(None).cast(kinds[c]).alias(c) for c in extra))
    return own.unionByName(sent).repartition("grp", "block").sortWithinPartitions("grp", "block", "place")


def _round_back(nodes: DataFrame, messages: DataFrame, levels: int) -> DataFrame:
    """The messages of the round below: one per node of this round."""

    def run(batches):
        for message, found, proofs in _told(batches, levels):
            yield {
                "grp": [message[0]] * len(found),
                "place": [x[2] for x in found],
                "suffix": proofs,
                "subroot": [message[6]] * len(found),
                "root": [message[7]] * len(found),
            }

    return map_rows(_delivered(nodes, messages, levels), run, "grp long, place long, suffix string, subroot string, root string")


def _back(rounds: list[DataFrame], messages: DataFrame, name: str, levels: int) -> DataFrame:
    """Messages for the blocks of the first round, from those for the last round's nodes."""
    for nodes in reversed(rounds[1:-1]):
        messages = written(messages.sparkSession, _round_back(nodes, messages, levels), name)
    return messages


# --- the operator


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs of ``leaves (key, grp, leaf, claim)``: ``key, leaf, subroot, root, proof, proof_sha256, folded_root, verified``.

    ``claim`` is the leaf as someone presents it now (null: unchanged); ``folded_root`` is what it leads to with the
    proof of the original, and ``verified`` whether that is the root. ``proof_sha256`` hashes the proof's siblings,
    level by level, left to right.
    """
    spark = leaves.sparkSession
    by = ["grp", "key", "leaf"]
    rows = placed(leaves.select("key", F.col("grp").alias("grp"), "leaf", "claim"), by, "manifest-leaves")
    groups = placed(rows.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), ["grp"], "manifest-groups")
    groups = written(spark, groups.withColumnRenamed("place", "id"), "manifest-groups")
    # Groups are as few as the sizes say: AQE broadcasts them, or splits a hot group's rows.
    named = groups.select(F.col("grp").alias("_grp"), "first", "n", "id")
    rows = rows.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "key", "claim", F.col("id").alias("grp"), (F.col("place") - F.col("first")).alias("place"), "n", F.col("leaf").alias("digest")
    )
    rows = written(spark, rows, "manifest-nodes")
    rounds = rounds_of(rows.select("grp", "place", "n", "digest"), "manifest-forward", levels)
    subroots = rounds[-1].select(F.col("grp").alias("place"), F.col("digest"))
    many = groups.count()
    tops = written(spark, subroots.select(F.lit(0).cast("long").alias("grp"), "place", F.lit(many).cast("long").alias("n"), "digest"), "manifest-subroots")
    upper = rounds_of(tops, "manifest-top", levels)
    # The root's message, then one per subroot, then one per block of leaves.
    root = upper[-1].select("grp", "place", F.lit("").alias("suffix"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    told = written(spark, _round_back(tops, _back(upper, root, "manifest-back", levels), levels), "manifest-back")
    told = told.join(tops.select("place", "digest"), "place").select(
        F.col("place").alias("grp"), F.lit(0).cast("long").alias("place"), "suffix", F.col("digest").alias("subroot"), "root"
    )
    told = _back(rounds, written(spark, told, "manifest-back"), "manifest-back", levels)

    def run(batches):
        for message, found, proofs in _told(batches, levels, ("key", "claim")):
            claimed = [folded(x[9] or x[4], p) for x, p in zip(found, proofs, strict=True)]
            yield {
                "key": [x[8] for x in found],
                "leaf": [x[4] for x in found],
                "subroot": [message[6]] * len(found),
                "root": [message[7]] * len(found),
                "proof": proofs,
                "proof_sha256": [digest_of(p.replace(",", "").replace(";", "")) for p in proofs],
                "folded_root": claimed,
                "verified": [c == message[7] for c in claimed],
            }

    kind = leaves.schema["key"].dataType.simpleString()
    columns = f"key {kind}, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string, verified boolean"
    return map_rows(_delivered(rows, told, levels, "key", "claim"), run, columns)


def document_leaves(docs: DataFrame, every: int = TAMPER_EVERY) -> DataFrame:
    """Leaves of ``documents``, grouped by language; where ``every`` divides crc32 of the id, the claim is of the text in lower-case A-Z."""
    fields = lambda text: field_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    text = F.col("text").cast("string")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return docs.select(F.col("doc_id").alias("key"), F.col("lang").cast("string").alias("grp"), fields(text).alias("leaf"), F.when(tampered, fields(lower)).alias("claim"))
