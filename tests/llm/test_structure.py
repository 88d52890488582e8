import functools
import itertools
import random
import re
import zlib

from conftest import SF_SMALL
from helpers import rows_of, sha

from pricelake.llm import queries, structure

PATTERN = re.compile(r"(s?(ua)+)?")
ROLES = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """The cheapest repair of rows (role, text, fault) by a recursion over whole suffixes: cost, audit, messages."""

    @functools.cache
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        if inserted < 2:
            for x, role in ROLES.items():
                if x in structure.NEXT[state]:
                    c, a, m = best(i, structure.NEXT[state][x], inserted + 1)
                    options.append((c + 5, "I" + a, ((role, ""), *m)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, m = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, m))
            if fault != structure.FORCED:
                more = 5 * (fault == structure.TRUNCATED)
                if role[:1] in structure.NEXT[state]:
                    c, a, m = best(i + 1, structure.NEXT[state][role[:1]], 0)
                    options.append((c + more, "K" + a, ((role, text), *m)))
                for x, name in ROLES.items():
                    if x in structure.NEXT[state]:
                        c, a, m = best(i + 1, structure.NEXT[state][x], 0)
                        options.append((c + more + 1, "R" + a, ((name, text), *m)))
        return min(options, default=(10**9, "", ()))

    return best(0, 0, 0)


def brute(conv_rows):
    """Counts, audit and digest of a conversation's rows (turn, role, text) in order."""
    seen, faults, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in conv_rows:
        shown = WORDS.findall(text)
        kind = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            counts[kind] += 1
        faults.append((role, text, {None: structure.OK, "truncated": structure.TRUNCATED}.get(kind, structure.FORCED)))
    turns = [t for t, *_ in conv_rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(conv_rows))
    cost, audit, left = cheapest(tuple(faults))
    assert PATTERN.fullmatch("".join(r[:1] for r, _ in left))
    return (gaps, *counts.values(), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left)))


def broken(rows):
    """The damage of the contract, row by row."""
    out = {}
    for conv, turn, role, text in rows:
        name = " " if conv is None else conv
        kind = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: sorted(r, key=key) for conv, r in out.items()}


def check(spark, rows):
    got = structure.summaries(structure.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert rows_of(got) == sorted(((conv, *brute(r)) for conv, r in broken(rows).items()), key=repr)


def test_search_is_the_cheapest_and_first_of_all_repairs():
    rnd = random.Random(1)
    for _ in range(400):
        rows = tuple((rnd.choice(["user", "assistant", "system", "tool", ""]), str(i), rnd.choice([0, 0, 0, 1, 2])) for i in range(rnd.randint(0, 12)))
        search, edits, left = structure.Search(), "", []
        for role, text, fault in rows:
            search.feed(role, text, fault)
            for e, m in search.resolved():
                edits += e
                left += [m] if m else []
        for e, m in search.finish():
            edits += e
            left += [m] if m else []
        assert (search.cost, edits, tuple(left)) == cheapest(rows)


def test_what_remains_never_costs_more_than_the_table_says():
    for n in range(5):
        for rows in itertools.product([("user", 0), ("assistant", 0), ("system", 1), ("system", 0), ("x", 2)], repeat=n):
            costs = []
            for state in range(4):
                search = structure.Search()
                search.best = [None] * 4
                search.best[state] = (0, search.root)
                for role, fault in rows:
                    search.feed(role, "", fault)
                list(search.finish())
                costs.append(search.cost)
            assert all(costs[t] <= costs[s] + structure.AHEAD[t][s] for t in range(4) for s in range(4))


def test_long_conversations_hold_little():
    rnd = random.Random(3)
    search, most = structure.Search(), 0
    for i in range(20000):
        search.feed(rnd.choice(["user", "assistant", "assistant", "system"]), "x", rnd.choice([0, 0, 0, 1, 2]))
        for _ in search.resolved():
            pass
        most = max(most, search.unresolved())
    assert most < 200


def test_equal_to_brute_force_on_the_table_and_on_odd_rows(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_structure_repair(spark, SF_SMALL)
    assert rows_of(got) == sorted(((conv, *brute(r)) for conv, r in broken(table).items()), key=repr)
    rnd = random.Random(4)
    odd = [
        (rnd.choice([None, -3, *range(30)]), rnd.choice([None, *range(9), 10**6]), rnd.choice([None, "", "user", "assistant", "system", "ugh"]),
         rnd.choice([None, "", " \n", "a b.", "a b", "é!", "x ", " ", "long " * 5000]))
        for _ in range(400)
    ]
    check(spark, odd + odd[:60] + [(99, 1, "user", "again.")] * 300 + [(100, None, None, None)])


def test_repaired_messages_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (2, 0, "system", ""), (None, 3, "assistant", "So.")]
    df = spark.createDataFrame([(*r, "q", 3) for r in rows], SCHEMA + ", edit string, n int")
    got = rows_of(structure.repaired(df))
    assert got == sorted([(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Well?")], key=repr)
    none = spark.createDataFrame([], SCHEMA)
    assert structure.summaries(structure.damaged(none)).count() == 0 == structure.repaired(none).count()
