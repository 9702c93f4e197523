import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHES
from tidemill.llm import queries, roles

MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}      # of s?(ua)+ by hand


def cheapest(symbols):
    """Least (cost, audit) by a table over rows and places in the pattern, whole strings compared."""
    def inserted(best):
        best, todo = dict(best), list(best)
        while todo:
            at = todo.pop()
            for r in "ua":
                to, way = MOVES.get((at, r)), (best[at][0] + 2, best[at][1] + "I")
                if to is not None and (to not in best or way < best[to]):
                    best[to] = way
                    todo.append(to)
        return best
    best = {0: (0, "")}
    for role, fault in zip(symbols[::2], symbols[1::2]):
        after = defaultdict(list)
        for at, (cost, audit) in inserted(best).items():
            after[at].append((cost + 3, audit + "D"))
            if fault not in "bd":
                for to, more, e in [(MOVES.get((at, role)), 0, "K"), (MOVES.get((at, "u")), 2, "R"), (MOVES.get((at, "a")), 2, "R")]:
                    after[to].append((cost + more + (fault == "t"), audit + e))
        best = {at: min(ways) for at, ways in after.items() if at is not None}
    return min(w for at, w in inserted(best).items() if at in (0, 3))


def random_symbols(rng, most):
    return "".join(rng.choice("suax") + rng.choice("---tbd") for _ in range(rng.randint(0, most)))


def test_repairs_are_cheapest():
    rng = random.Random(1)
    for _ in range(3000):
        symbols = random_symbols(rng, 10)
        cost, audit = roles.repair(symbols)
        assert (cost, audit) == cheapest(symbols)
        left = roles.plan(audit, symbols[::2], roles.STACKS.start)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] if role else symbols[2 * i] for i, role in left))


def test_folded_segments_give_the_same():
    rng = random.Random(2)
    for _ in range(500):
        parts = [random_symbols(rng, 3) or "u-" for _ in range(rng.randint(1, 6))]
        tables, audits = [], []
        for p in parts:
            ways = [(s, t, c, a) for s in roles.NODES for t, (c, a) in roles.parse(p, s).items()]
            ranks = {a: i for i, a in enumerate(sorted({w[3] for w in ways}))}
            audits.append({w[:2]: w[3] for w in ways})
            tables.append([(s, t, c, ranks[a]) for s, t, c, a in ways])
        cost, path, tail = roles.fold(tables)
        assert (cost, "".join(a[p] for a, p in zip(audits, path)) + tail) == roles.repair("".join(parts))


def by_hand(rows):
    """Everything the query returns of a conversation, from its damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    symbols, seen, faults = "", set(), {"b": 0, "d": 0, "t": 0, "-": 0}
    for _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else "-"
        seen.add((role, text))
        faults[fault] += 1
        symbols += (role[:1] if role[:1] in ("s", "u", "a") else "x") + fault
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(symbols)
    lines, at, before = [], 0, ""
    for e in audit:
        if e == "K":
            lines.append(f"{rows[at][1]}:{rows[at][2]}")
        elif e != "D":
            role = "assistant" if before == "u" else "user"
            lines.append(f"{role}:{rows[at][2] if e == 'R' else ''}")
        before = lines[-1][0] if e != "D" else before
        at += e != "I"
    return (gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            held += [row] * (2 if kind == 3 else 1)
    return out


def given(spark):
    """Conversations with every kind of null, repeated rows, equal turns, other roles and one much longer than the others."""
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "No!", "Why", " \t", "", "é?\n", "Yes. "]))
            for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(77, rng.randint(0, 300), rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"{i}.", f"{i}"])) for i in range(400)]
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (5, None, "assistant", "Late."), (5, None, "assistant", "Late."), (6, 2, None, "x"),
             (7, 3, "user", None), (8, None, None, None), (9, 4, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    return rows, df.withColumns({c: F.lit(f"own {c}") for c in [*CLASHES, "c", "seg", "at", "plan", "found", "rows"]})


@pytest.mark.parametrize("short,segment", [(500, 256), (3, 2), (100, 16)])
def test_conversations(spark, short, segment):
    rows, df = given(spark)
    want = damaged(rows)
    marked = queries.damaged_turns(df)
    got = roles.repair_conversations(marked, present=F.col("present"), short=short, segment=segment).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: by_hand(held) for c, held in want.items()} and len(got) == len(want)
    repaired = defaultdict(list)
    for r in roles.repaired_rows(marked.filter("present"), short=short, segment=segment).orderBy("conv_id", "seg", "at").collect():
        repaired[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(repaired[r.conv_id]).encode()).hexdigest() == r.repaired_sha256 for r in got)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_role_repair"](spark, sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: by_hand(held) for c, held in damaged(rows).items()}


def test_empty_table(spark):
    assert roles.repair_conversations(given(spark)[1].filter("false")).collect() == []
