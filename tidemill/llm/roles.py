"""Repair of the roles of conversations by generalised LR parsing with weighted edits.

A conversation should be an optional system turn and then pairs of a user and an assistant turn. The parser reads its
rows with an LR automaton built from the role grammar. Its stacks form one graph: a node is an automaton state above
another node, so stacks share what lies below their tops. Every row may be kept, reroled or deleted, and turns may be inserted before
it; each edit moves a top to other nodes. Equal tops are merged by the least (cost, audit), where the audit is the string of
the initials of the edits. Blank and duplicate rows must be deleted.

Conversations up to ``SHORT`` rows are parsed whole. Longer ones are sorted across the cluster and cut into segments; each
segment is parsed once from every node of the graph, a table of least ways from node to node, and these tables are folded along the
conversation. Inserts stand before a row of their segment, so of two ways of equal cost none is a prefix of the other, and ranks
of audits decide as the whole audits would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, drop_stage

SHORT = 500             # rows, and
SHORT_BYTES = 1 << 23   # bytes of text, up to which a conversation is parsed by one call
SEGMENT = 256           # rows of a segment of a longer one
LAST_SEGMENT = (1 << 63) - 1    # holds the closing inserts

# the role grammar: left side and right side; small letters are the initials of roles
GRAMMAR = (("S", "C"), ("C", ""), ("C", "sP"), ("C", "P"), ("P", "ua"), ("P", "Pua"))
ROLES = {"u": "user", "a": "assistant"}             # those that reroling and inserting can give
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1      # costs; the last one for a truncated row that stays

Way = tuple[int, str]   # cost and audit


# ---- the automaton and its graph of stacks ------------------------------------------------------------

def _closure(items: frozenset) -> frozenset:
    """LR(0) items ``(rule, dot)`` with those that may start at their dots."""
    todo, out = list(items), set(items)
    while todo:
        rule, dot = todo.pop()
        for i, (left, _) in enumerate(GRAMMAR):
            if GRAMMAR[rule][1][dot:dot + 1] == left and (i, 0) not in out:
                out.add((i, 0))
                todo.append((i, 0))
    return frozenset(out)


def _goto(items: frozenset, symbol: str) -> frozenset:
    return _closure(frozenset((r, d + 1) for r, d in items if GRAMMAR[r][1][d:d + 1] == symbol))


class Stacks:
    """Nodes of the graph of stacks: each is an automaton state above another node; equal ones are one node."""

    def __init__(self):
        self.nodes: list[tuple[frozenset, int]] = []
        self.numbers: dict[tuple[frozenset, int], int] = {}
        self.moves: dict[tuple[int, str], tuple[int, ...]] = {}
        self.start = self._node(_closure(frozenset([(0, 0)])), -1)

    def _node(self, state: frozenset, below: int) -> int:
        if (state, below) not in self.numbers:
            self.numbers[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.numbers[state, below]

    def _reads_on(self, node: int) -> bool:
        return any(GRAMMAR[r][1][d:d + 1].islower() for r, d in self.nodes[node][0])

    def _reduced(self, node: int) -> list[int]:
        """The node and all that reductions lead to from it."""
        out = [node]
        for at in out:
            for rule, dot in self.nodes[at][0]:
                left, right = GRAMMAR[rule]
                if rule and dot == len(right):
                    base = at
                    for _ in right:
                        base = self.nodes[base][1]
                    new = self._node(_goto(self.nodes[base][0], left), base)
                    if new not in out:
                        out.append(new)
        return out

    def shift(self, node: int, role: str) -> tuple[int, ...]:
        """Nodes after reading a role on top of ``node``, without those that only a reduction leads on from."""
        if (node, role) not in self.moves:
            state = _goto(self.nodes[node][0], role)
            tops = self._reduced(self._node(state, node)) if state else []
            self.moves[node, role] = tuple(t for t in tops if self._reads_on(t))
        return self.moves[node, role]

    def accepted(self, node: int) -> bool:
        """Whether the whole input is read: the top, possibly after reductions, is the start symbol's."""
        return any(self.nodes[t][0] >= {(0, 1)} for t in self._reduced(node))

    def all(self) -> list[int]:
        """Every node that any sequence of roles leads to; finite, as the grammar's recursion is on the left."""
        seen = [self.start]
        for at in seen:
            for role in "sua":
                seen += [t for t in self.shift(at, role) if t not in seen]
        return seen


STACKS = Stacks()
NODES = STACKS.all()


def _better(tops: dict[int, Way], node: int, way: Way) -> bool:
    """Merge a way into the tops; whether it is now the least to its node."""
    if node in tops and tops[node] <= way:
        return False
    tops[node] = way
    return True


def _inserted(tops: dict[int, Way]) -> dict[int, Way]:
    """The tops with those that inserts lead to."""
    out, todo = dict(tops), list(tops)
    while todo:
        node = todo.pop()
        cost, audit = out[node]
        for role in ROLES:
            todo += [t for t in STACKS.shift(node, role) if _better(out, t, (cost + INSERT, audit + "I"))]
    return out


def parse(symbols: str, start: int) -> dict[int, Way]:
    """Least (cost, audit) from one node of the graph to all others over rows ``symbols``.

    Two characters a row: the initial of its role and its fault, ``b`` and ``d`` for rows that must go, ``t`` for truncated.
    """
    tops: dict[int, Way] = {start: (0, "")}
    for initial, fault in zip(symbols[::2], symbols[1::2]):
        after: dict[int, Way] = {}
        for node, (cost, audit) in _inserted(tops).items():
            _better(after, node, (cost + DELETE, audit + "D"))
            if fault in "bd":
                continue
            stay = cost + (TRUNCATED if fault == "t" else 0)
            for top in STACKS.shift(node, initial):
                _better(after, top, (stay, audit + "K"))
            for role in ROLES:
                for top in STACKS.shift(node, role):
                    _better(after, top, (stay + REROLE, audit + "R"))
        tops = after
    return tops


def finish(tops: dict[int, Way]) -> Way:
    """The least way that ends as the grammar asks, with closing inserts."""
    return min(way for node, way in _inserted(tops).items() if STACKS.accepted(node))


def repair(symbols: str) -> Way:
    """Least (cost, audit) of a whole conversation."""
    return finish(parse(symbols, STACKS.start))


def plan(audit: str, initials: str, start: int) -> list[tuple[int, str]]:
    """What an audit leaves of the rows, from a node on: (row or -1, new role or empty)."""
    after_user = any(STACKS.shift(start, "a"))
    out, row = [], 0
    for edit in audit:
        if edit != "D":
            role = "a" if after_user else "u"
            kept_system = edit == "K" and initials[row] == "s"
            out.append((-1 if edit == "I" else row, "" if edit == "K" else ROLES[role]))
            after_user = not after_user and not kept_system
        row += edit != "I"
    return out


# ---- over tables ---------------------------------------------------------------------------------------

LEGAL = ("su", "ua", "au")
PLAN = "array<struct<row:int,role:string>>"
REPAIR = f"cost:long,audit:string,plan:{PLAN}"
KNOWN = 1 << 14         # repairs a task remembers


def _named(edits: list[tuple[int, str]]) -> list[dict]:
    return [{"row": i, "role": r} for i, r in edits]


PLAN_TYPE = pa.list_(pa.struct([("row", pa.int32()), ("role", pa.string())]))
REPAIR_TYPE = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("plan", PLAN_TYPE)])


def _whole(symbols: Column) -> Column:
    """Cost, audit and plan of a whole conversation from the symbols of its rows."""
    @F.arrow_udf(f"struct<{REPAIR}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, dict] = {}     # most conversations have the symbols of others
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                if text not in known:
                    if len(known) == KNOWN:
                        known.clear()
                    cost, audit = repair(text)
                    known[text] = {"cost": cost, "audit": audit, "plan": _named(plan(audit, text[::2], STACKS.start))}
                out.append(known[text])
            yield pa.array(out, REPAIR_TYPE)
    return run(symbols)


def _symbol(role: Column, text: Column) -> Column:
    """Initial and fault of a row, without duplicates."""
    initial = F.when(F.left(role, F.lit(1)).isin("s", "u", "a"), F.left(role, F.lit(1))).otherwise("x")
    last = F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", "b").when(last.isin(".", "!", "?"), "-").otherwise("t")
    return F.concat(initial, fault)


def _counts(symbols: Column) -> dict[str, Column]:
    """How often each fault occurs, and how many neighbours are illegal."""
    faults, initials = F.regexp_replace(symbols, "(.)(.)", "$2"), F.regexp_replace(symbols, "(.)(.)", "$1")
    count = {name: F.length(F.regexp_replace(faults, f"[^{f}]", "")).cast("long") for name, f in
             (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))}
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(initials), F.lit(1))), lambda i: F.substr(initials, i, F.lit(2)))
    return count | {"illegal": F.size(F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin(*LEGAL))).cast("long")}


def _repaired(rows: Column, edits: Column) -> Column:
    """The rows a plan leaves, as (role, text)."""
    def one(e):
        at = F.get(rows, e["row"])
        return F.struct(F.when(e["role"] == "", at["role"]).otherwise(e["role"]).alias("role"),
                        F.when(e["row"] < 0, "").otherwise(at["text"]).alias("text"))
    return F.transform(edits, one)


def _lines(repaired: Column) -> Column:
    return F.array_join(F.transform(repaired, lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


def _gaps(turns: Column) -> Column:
    turns = F.array_distinct(F.array_compact(turns))
    return F.coalesce(F.array_max(turns) - F.array_min(turns) + 1 - F.size(turns), F.lit(0)).cast("long")


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", present: Column | None = None, short: int = SHORT,
                         segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are read by turn (nulls first), then role and text; null roles and texts count as one space. ``gaps`` are missing turn numbers. A row is
    blank without a character other than ASCII white space, else a duplicate if its role and text came earlier, else
    truncated if its last such character is no ``.!?``; ``illegal`` counts neighbours whose roles may not follow each other. An empty
    role can't be kept. The digest is of ``role:text`` lines. Null is a conversation of its own. Rows
    that are not ``present`` only name their conversation; one without rows has zeros, an empty audit and the digest of no text.
    An empty table gives an empty result. See ``repaired_rows`` for the rows themselves.
    """
    docs = _prepared(rows, conv_col, turn_col, role_col, text_col, present)
    long_ones = _long(docs, short)
    out = _short_repairs(docs, long_ones).select("c", *_MEASURED, F.sha2(_lines(_repaired(F.col("rows"), F.col("plan"))), 256).alias("repaired_sha256"))
    if long_ones is not None:
        parsed, folded = _long_repairs(docs, long_ones, segment)
        lines = parsed.select("c", "seg", _lines(_repaired(F.col("rows"), F.col("plan"))).alias("lines"),
                              (F.size("plan") > 0).alias("any"))
        audits = parsed.groupBy("c").agg(F.array_join(F.array_sort(F.collect_list(F.struct("seg", "audit")))["audit"], "").alias("audit"))
        whole = folded.join(audits, "c").join(_digests(lines, folded), "c")
        out = out.unionByName(whole.select("c", *[F.concat("audit", "tail").alias("audit") if c == "audit" else F.col(c) for c in _MEASURED],
                                           "repaired_sha256"))
    return out.select("c.*", *_MEASURED, "repaired_sha256")


_MEASURED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def repaired_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", short: int = SHORT, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations as rows ``conv_id, seg, at, role, text``, in order of ``seg`` and ``at``; see ``repair_conversations``."""
    docs = _prepared(rows, conv_col, turn_col, role_col, text_col, None)
    long_ones = _long(docs, short)
    left = _repaired(F.col("rows"), F.col("plan")).alias("left")
    # all columns are staged: inlined as the function's only input, the lambdas over rows can't be evaluated
    parts = cut_lineage(_short_repairs(docs, long_ones)).select("c", F.lit(0).cast("long").alias("seg"), left)
    if long_ones is not None:
        parsed, folded = _long_repairs(docs, long_ones, segment)
        tail = F.transform("tail_roles", lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
        parts = parts.unionByName(parsed.select("c", "seg", left)).unionByName(folded.select("c", F.lit(LAST_SEGMENT).alias("seg"), tail.alias("left")))
    return parts.select("c", "seg", F.posexplode("left").alias("at", "r")).select("c.*", "seg", "at", "r.role", "r.text")


def _prepared(rows, conv_col, turn_col, role_col, text_col, present) -> DataFrame:
    """``c`` (the conversation as a struct, so that null is a key like any other), ``turn, role, text, present``."""
    return rows.select(F.struct(F.col(conv_col).alias(conv_col)).alias("c"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
                       (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))


def _long(docs: DataFrame, short: int) -> DataFrame | None:
    """Conversations beyond what one call may hold, or None; by counting, a share of at most 1 / short of all rows."""
    sizes = docs.filter("present").groupBy("c").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    found = cut_lineage(sizes.filter((F.col("n") > short) | (F.col("bytes") > SHORT_BYTES)).select("c"))
    return None if found.isEmpty() else found


def _short_repairs(docs: DataFrame, long_ones: DataFrame | None) -> DataFrame:
    """``c``, the counts, the audit, the plan and the rows in order, for all conversations but the long ones."""
    if long_ones is not None:
        docs = docs.join(long_ones, "c", "left_anti")
    row = F.when(F.col("present"), F.struct("turn", "role", "text"))        # a list leaves nulls out
    grouped = docs.groupBy("c").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def symbol(r, i):
        own = _symbol(r["role"], r["text"])
        again = F.exists(F.slice("rows", 1, i), lambda x: (x["role"] == r["role"]) & (x["text"] == r["text"]))
        return F.when(again & ~own.endswith("b"), F.concat(F.left(own, F.lit(1)), F.lit("d"))).otherwise(own)
    marked = grouped.select("c", "rows", F.array_join(F.transform("rows", symbol), "").alias("symbols"))
    found = marked.select("c", "rows", "symbols", _whole(F.col("symbols")).alias("found"))
    counts = [c.alias(n) for n, c in _counts(F.col("symbols")).items()]
    return found.select("c", "rows", _gaps(F.col("rows.turn")).alias("gaps"), *counts, "found.*")


# ---- long conversations -----------------------------------------------------------------------------------

WAYS = "array<struct<start:int,stop:int,cost:long,audit:string>>"
WAYS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _table(symbols: Column) -> Column:
    """Least ways of a segment from every node to every node."""
    @F.arrow_udf(WAYS)
    def run(given: pa.Array) -> pa.Array:
        return pa.array([[{"start": s, "stop": t, "cost": c, "audit": a} for s in NODES for t, (c, a) in parse(x, s).items()]
                         for x in given.to_pylist()], WAYS_TYPE)
    return run(symbols)


def fold(tables: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """Least way through segments with ways (start, stop, cost, rank): its cost, the nodes each segment starts and stops at, and closing inserts.

    Tops carry the rank of their audit among the tops; pairs of ranks order whole audits.
    """
    tops, back = {STACKS.start: (0, 0)}, []
    for ways in tables:
        after: dict[int, tuple[int, int, int, int]] = {}
        for start, stop, cost, rank in ways:
            if start in tops:
                way = (tops[start][0] + cost, tops[start][1], rank, start)
                after[stop] = min(after.get(stop, way), way)
        ranks = {r: i for i, r in enumerate(sorted({w[1:3] for w in after.values()}))}
        back.append({stop: w[3] for stop, w in after.items()})
        tops = {stop: (w[0], ranks[w[1:3]]) for stop, w in after.items()}
    best = None
    for node, (cost, rank) in tops.items():
        ends = [(c, a) for t, (c, a) in _inserted({node: (0, "")}).items() if STACKS.accepted(t)]
        if ends:
            more, audit = min(ends)
            best = min(best or (cost + more, rank, audit, node), (cost + more, rank, audit, node))
    cost, _, tail, node = best
    path = []
    for step in reversed(back):
        path.append((step[node], node))
        node = step[node]
    return cost, path[::-1], tail


FOLDED = "cost:long,path:array<struct<start:int,stop:int>>,tail:string,tail_roles:array<string>"
FOLDED_TYPE = pa.struct([("cost", pa.int64()), ("path", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                         ("tail", pa.string()), ("tail_roles", pa.list_(pa.string()))])


def _folded(tables: Column) -> Column:
    @F.arrow_udf(f"struct<{FOLDED}>")
    def run(given: pa.Array) -> pa.Array:
        out = []
        for tables in given:
            cost, path, tail = fold([[(w["start"], w["stop"], w["cost"], w["rank"]) for w in t] for t in tables.as_py()])
            out.append({"cost": cost, "path": [{"start": s, "stop": t} for s, t in path], "tail": tail,
                        "tail_roles": [r for _, r in plan(tail, "", path[-1][1])]})
        return pa.array(out, FOLDED_TYPE)
    return run(tables)


def _planned(audit: Column, initials: Column, start: Column) -> Column:
    @F.arrow_udf(PLAN)
    def run(audits: pa.Array, initials: pa.Array, starts: pa.Array) -> pa.Array:
        return pa.array([_named(plan(*x)) for x in zip(audits.to_pylist(), initials.to_pylist(), starts.to_pylist())], PLAN_TYPE)
    return run(audit, initials, start)


def _long_repairs(docs: DataFrame, long_ones: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Segments ``c, seg, rows, audit, plan`` and conversations ``c``, counts, ``cost, tail, tail_roles`` of the long ones."""
    rows = docs.filter("present").join(long_ones, "c", "left_semi").drop("present")
    key = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
    rows = cut_lineage(rows.withColumns({"rid": F.monotonically_increasing_id(), "key": key}))
    # the first of equal rows is one row by number, so the join back has no hot key
    firsts = rows.groupBy("c", "key").agg(F.min(F.struct("turn", "rid"))["rid"].alias("rid")).select("rid", F.lit(True).alias("first"))
    marked = rows.drop("key").join(firsts, "rid", "left")
    order = ["c", "turn", "role", "text", "rid"]
    placed = cut_lineage(marked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    symbol = _symbol(F.col("role"), F.col("text"))
    symbol = F.when(F.col("first").isNull() & ~symbol.endswith("b"), F.concat(F.left(symbol, F.lit(1)), F.lit("d"))).otherwise(symbol)
    # rows of a partition are numbered without gaps, so a segment never crosses partitions
    seg = F.shiftright("at", 33) * (1 << 33) + F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / segment)
    grouped = placed.withColumn("symbol", symbol).groupBy("c", seg.cast("long").alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("at", "turn", "role", "text", "symbol"))).alias("rows"))
    symbols = F.array_join("rows.symbol", "")
    staged = cut_lineage(grouped.select("c", "seg", "rows", symbols.alias("symbols"), _table(symbols).alias("ways")))
    drop_stage(rows)
    drop_stage(placed)
    initials = F.regexp_replace("symbols", "(.)(.)", "$1")
    turns = F.array_distinct(F.array_compact("rows.turn"))
    audits = F.array_sort(F.array_distinct("ways.audit"))
    light = staged.select(
        "c", "seg", *[c.alias(n) for n, c in _counts(F.col("symbols")).items()], F.left(initials, F.lit(1)).alias("head"),
        F.right(initials, F.lit(1)).alias("last"),
        F.size(turns).alias("turns"), F.array_min(turns).alias("low"), F.array_max(turns).alias("high"),
        F.transform("ways", lambda w: F.struct(w["start"], w["stop"], w["cost"], F.array_position(audits, w["audit"]).alias("rank"))).alias("ways"))
    before = Window.partitionBy("c").orderBy("seg")
    light = light.withColumns({"crossing": F.concat(F.lag("last").over(before), "head"), "seen": F.lag("high").over(before)})
    folded = light.groupBy("c").agg(
        *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.count_if(~F.col("crossing").isin(*LEGAL))).cast("long").alias("illegal"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns") + F.count_if(F.col("seen") == F.col("low")), F.lit(0)).cast("long").alias("gaps"),
        F.array_sort(F.collect_list(F.struct("seg", "ways"))).alias("steps"))
    folded = cut_lineage(folded.withColumn("f", _folded(F.col("steps.ways"))).select(
        "c", "gaps", "blank", "duplicate", "truncated", "illegal", "f.*", F.col("steps.seg").alias("segs")))
    path = folded.select("c", F.explode(F.arrays_zip("segs", "path")).alias("p")).select("c", F.col("p.segs").alias("seg"), "p.path")
    chosen = staged.join(path, ["c", "seg"])
    way = F.filter("ways", lambda w: (w["start"] == F.col("path.start")) & (w["stop"] == F.col("path.stop")))[0]
    parsed = chosen.select("c", "seg", "rows", way["audit"].alias("audit"), initials.alias("initials"), F.col("path.start").alias("start"))
    parsed = parsed.select("c", "seg", "rows", "audit", _planned(F.col("audit"), F.col("initials"), F.col("start")).alias("plan"))
    return parsed, folded.drop("segs", "path")


def _digests(lines: DataFrame, folded: DataFrame) -> DataFrame:
    """SHA-256 of the repaired lines of each conversation; a digest is sequential, so a task reads a conversation's segments
    in order as a stream and holds one batch of them."""
    tail = folded.select("c", F.lit(LAST_SEGMENT).alias("seg"), F.array_join(F.transform("tail_roles", lambda r: F.concat(r, F.lit(":"))), "\n").alias("lines"),
                         (F.size("tail_roles") > 0).alias("any"))
    ordered = lines.unionByName(tail).repartition("c").sortWithinPartitions("c", "seg")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, begun = None, None, False

        def done():
            return pa.RecordBatch.from_arrays([pa.array([current], batch.schema.field("c").type), pa.array([digest.hexdigest()])], ["c", "repaired_sha256"])
        for batch in batches:
            for c, text, some in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if digest is None or c != current:
                    if digest is not None:
                        yield done()
                    current, digest, begun = c, hashlib.sha256(), False
                if some:
                    digest.update((b"\n" if begun else b"") + text.encode("utf-8"))
                    begun = True
        if digest is not None:
            yield done()
    return ordered.mapInArrow(run, "c " + folded.schema["c"].dataType.simpleString() + ", repaired_sha256 string")
