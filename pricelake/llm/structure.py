"""Conversation structure repair: the cheapest edits, found by a Viterbi search whose survivors coalesce.

A conversation is well formed when its role initials read ``(s?(ua)+)?`` and no
row is blank, a duplicate or truncated. Edits, row by row: keep (0), give the
role user or assistant (1), delete (2; the only one for blank and duplicate
rows), insert an empty message of either role anywhere (5); a truncated row
that is not deleted costs 5 more. Of equally cheap repairs the one whose edit
initials (K, R, D, I) come first in ASCII order is taken.

The search runs through a conversation's rows once and keeps, for each state of
the pattern, the best way to it as a path in a tree of back pointers. Nodes
count their references; a path that no state needs is dropped with all its own
nodes, and as soon as all states share an ancestor the edits up to it are final:
they are written out and forgotten, texts included. Ties compare the unresolved
suffixes in full, back to where they part. A state that another one beats by
more than what any continuation could win back is dropped as well, which lets
the others coalesce. What is held is thus the unresolved stretch (a row that
must be deleted holds no text), however long the conversation.

Spark groups equal rows of a turn with a combine before the shuffle (their
copies are duplicates at once), marks the first turn of every (role, text) of a
conversation by a second aggregate, deals conversations to tasks and sorts them
there; a task streams its rows. Only the search itself is sequential within a
conversation.

Rows of a conversation are taken by turn, nulls first, then role and text.
Null roles and texts are one space. A null ``conv_id`` names a conversation
too. ``copies`` (where the column exists) says how often a row stands there; 0
only names its conversation. Empty tables give empty results; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_rows, written

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
OK, TRUNCATED, FORCED = 0, 1, 2  # a row's fault, as the search sees it

# States of the pattern: nothing yet, after s, after u, after a; where each initial leads.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
# AHEAD[t][s]: what remains costs from t at most so much more than from s (t does what s would, with these edits beside it).
AHEAD = ((0, 0, 5, 0), (10, 0, 5, 10), (7, 5, 0, 5), (2, 0, 5, 0))


class Node:
    """The end of a path: edits in order, the message they leave, and how many paths and states hang on it."""

    __slots__ = ("children", "depth", "edits", "held", "message", "parent")

    def __init__(self, parent, edits: str, message=None):
        self.parent, self.edits, self.message = parent, edits, message
        self.children: set[Node] = set()
        self.held = 0
        self.depth = 0
        if parent is not None:
            self.depth = parent.depth + 1
            parent.children.add(self)


def _drop(node: Node) -> None:
    """Take back what only this path needed."""
    while node.parent is not None and not node.held and not node.children:
        parent, node.parent = node.parent, None
        parent.children.discard(node)
        node = parent


def _comes_first(a: Node, b: Node) -> bool:
    """Whether the unresolved edits of ``a`` sort before those of ``b``; both are compared from where they part."""
    left: list[str] = []
    right: list[str] = []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edits)
            a = a.parent
        else:
            right.append(b.edits)
            b = b.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Search:
    """The survivors of one conversation. Feed rows, take what is final from :meth:`resolved`, then :meth:`finish`."""

    def __init__(self):
        self.root = Node(None, "")
        self.root.held = 1
        self.best: list[tuple[int, Node] | None] = [(0, self.root), None, None, None]
        self.cost: int | None = None

    def _take(self, table, state: int, cost: int, parent: Node, edits: str, message=None) -> None:
        """Enter a candidate where it beats what the state has."""
        now = table[state]
        if now is not None and cost > now[0]:
            return
        node = Node(parent, edits, message)
        if now is not None and cost == now[0] and not _comes_first(node, now[1]):
            _drop(node)
            return
        node.held = 1
        table[state] = (cost, node)
        if now is not None:
            now[1].held -= 1
            _drop(now[1])

    def _insertions(self) -> None:
        for _ in range(2):  # two in a row at most: more come back to the same state
            for state, then in enumerate(NEXT):
                for initial, role in ROLES.items():
                    if initial in then and self.best[state] is not None:
                        cost, node = self.best[state]
                        self._take(self.best, then[initial], cost + INSERT_COST, node, INSERT, (role, ""))

    def feed(self, role: str, text: str | None, fault: int, times: int = 1) -> None:
        """The next row; ``times`` copies of it if it must be deleted."""
        self._insertions()
        table: list[tuple[int, Node] | None] = [None] * 4
        for state, now in enumerate(self.best):
            if now is None:
                continue
            cost, node = now
            if fault == FORCED:
                self._take(table, state, cost + DELETE_COST * times, node, DELETE * times)
                continue
            self._take(table, state, cost + DELETE_COST, node, DELETE)
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            if role[:1] in NEXT[state]:
                self._take(table, NEXT[state][role[:1]], cost + more, node, KEEP, (role, text))
            for initial, name in ROLES.items():
                if initial in NEXT[state]:
                    self._take(table, NEXT[state][initial], cost + more + REROLE_COST, node, REROLE, (name, text))
        for s, now in enumerate(table):  # what can no longer win
            if now is not None and any(o is not None and o[0] + AHEAD[t][s] < now[0] for t, o in enumerate(table)):
                table[s] = None
                now[1].held -= 1
                _drop(now[1])
        self._settle(table)

    def _settle(self, table) -> None:
        old, self.best = self.best, table
        for now in old:
            if now is not None:
                now[1].held -= 1
                _drop(now[1])

    def resolved(self) -> Iterator[tuple[str, tuple[str, str] | None]]:
        """Edits that every survivor shares, with the message each leaves (``None``: deleted)."""
        while not self.root.held and len(self.root.children) == 1:
            (child,) = self.root.children
            child.parent = None
            self.root = child
            yield child.edits, child.message

    def finish(self) -> Iterator[tuple[str, tuple[str, str] | None]]:
        """The edits that are left once no more rows come; sets ``cost``."""
        self._insertions()
        table: list[tuple[int, Node] | None] = [None] * 4
        for state in FINAL:
            if self.best[state] is not None:
                self._take(table, 0, *self.best[state], "")
        self.cost = table[0][0]
        self._settle(table)
        yield from self.resolved()

    def unresolved(self) -> int:
        """Nodes held."""
        count, todo = 0, [self.root]
        while todo:
            node = todo.pop()
            count += 1
            todo += node.children
        return count


# --- rows


def prepared(messages: DataFrame) -> DataFrame:
    """Rows as the search takes them, equal rows of a turn together: ``conv_id, turn, role, text, n, fault, again``.

    ``n`` copies stand there; ``again`` says that the first of them was seen in an earlier turn. A row without role
    and text only names its conversation.
    """
    spark = messages.sparkSession
    copies = F.col("copies") if "copies" in messages.columns else F.lit(1)
    there = copies > 0
    only = lambda c: F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    rows = messages.select("conv_id", F.when(there, F.col("turn").cast("long")).alias("turn"), only("role").alias("role"), only("text").alias("text"), copies.alias("n"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    name = F.to_json(F.struct("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("t")))
    rows = written(spark, rows.withColumn("_said", F.sha2(name.cast("binary"), 256)), "structure-rows")
    # Only what is said in several turns needs its first one; a null turn comes first.
    first = (
        rows.where("role is not null")
        .groupBy("_said")
        .agg(F.count(F.lit(1)).alias("turns"), F.when(F.max(F.col("turn").isNull()), None).otherwise(F.min("turn")).alias("_first"))
        .where("turns > 1")
        .select("_said", "_first")
    )
    first = written(spark, first.withColumn("_many", F.lit(True)), "structure-first")
    rows = rows.join(first, "_said", "left")
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    fault = F.when(last == "", FORCED).when(last.isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    again = F.coalesce(F.col("_many") & ~F.col("turn").eqNullSafe(F.col("_first")), F.lit(False))
    return rows.select("conv_id", "turn", "role", "text", F.col("n").cast("long").alias("n"), fault.alias("fault"), again.alias("again"))


def _by_conversation(batches) -> Iterator[tuple[object, Iterable]]:
    """``(conv_id, its rows)``; each conversation's rows must be taken before the next one."""
    rows = (r for b in batches for r in zip(*(b[k] for k in ("conv_id", "turn", "role", "text", "n", "fault", "again")), strict=True))
    row = next(rows, None)
    while row is not None:
        conv = row[0]

        def own():
            nonlocal row
            while row is not None and row[0] == conv:
                yield row
                row = next(rows, None)

        yield conv, own()


def _dealt(messages: DataFrame) -> DataFrame:
    return prepared(messages).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _edits(rows, tally: dict) -> Iterator[tuple[str, tuple[str, str] | None]]:
    """The repair of a conversation's rows, edit by edit as it becomes final; counts go into ``tally``."""
    search, role_before, low, high, turns = Search(), None, None, None, 0
    for _, turn, role, text, n, fault, again in rows:
        if role is None:
            continue
        if turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
        first = 0 if fault == FORCED or again else 1
        if fault == FORCED:
            tally["blank"] += n
        else:
            tally["duplicate"] += n - first
            tally["truncated"] += first * (fault == TRUNCATED)
        if role_before is not None:
            tally["illegal"] += role_before[:1] + role[:1] not in ("su", "ua", "au")
        tally["illegal"] += n - 1
        role_before = role
        if first:
            search.feed(role, text, fault)
        if n > first:
            search.feed(role, None, FORCED, n - first)
        yield from search.resolved()
    tally["gaps"] = high - low + 1 - turns if turns else 0
    yield from search.finish()
    tally["cost"] = search.cost


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(messages: DataFrame) -> DataFrame:
    """Per conversation of ``messages (conv_id, turn, role, text)``: faults, cost, edit initials and the digest of what is left.

    ``repaired_sha256`` hashes the repaired ``role:text``, joined by line feeds.
    """

    def run(batches):
        for conv, rows in _by_conversation(batches):
            tally, audit, digest, some = dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False
            for edits, message in _edits(rows, tally):
                audit.append(edits)
                if message is not None:
                    digest.update((("\n" if some else "") + f"{message[0]}:{message[1]}").encode())
                    some = True
            yield {"conv_id": [conv], **{k: [v] for k, v in tally.items()}, "audit": ["".join(audit)], "repaired_sha256": [digest.hexdigest()]}

    kind = messages.schema["conv_id"].dataType.simpleString()
    return map_rows(_dealt(messages), run, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def repaired(messages: DataFrame) -> DataFrame:
    """The repaired messages themselves: ``conv_id, place`` (from 0), ``edit`` (K, R or I), ``role, text``."""

    def run(batches):
        for conv, rows in _by_conversation(batches):
            place = 0
            for edits, message in _edits(rows, dict.fromkeys(COUNTS, 0)):
                if message is not None:
                    yield {"conv_id": [conv], "place": [place], "edit": [edits], "role": [message[0]], "text": [message[1]]}
                    place += 1

    kind = messages.schema["conv_id"].dataType.simpleString()
    return map_rows(_dealt(messages), run, f"conv_id {kind}, place long, edit string, role string, text string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults dealt by ``crc32(conv_id:turn) % 20``: dropped, emptied, unpunctuated, repeated or given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
