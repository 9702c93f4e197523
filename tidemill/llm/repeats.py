"""Repeated passages: every byte covered by a string of ``length`` bytes that also starts anywhere else.

Shards of documents are merged like sorted suffix lists, refined from common prefix to common prefix, but the
suffixes are thinned out first: only those at *anchors* take part, the places where the hash of ``GRAM`` bytes is
the smallest of ``WINDOW`` neighbours. Equal strings have equal anchors, and any string of ``length`` bytes has an
anchor among its first ``WINDOW`` bytes, so with ``reach = length - WINDOW + 1`` bytes to its right inside.

1. Interleave refinement: every shard sends the names (hashes) of the prefixes at its anchors, in order and
   Golomb-coded, to the owners, who merge the lists. Prefixes that occur once can't be extended; the others are
   refined to longer prefixes, up to ``reach``. What is left are the repeated intervals, here called classes.
2. The context of an anchor is its class and everything else that a string of ``length`` bytes around it may
   hold. Contexts that occur twice are repeated as a whole, so all their strings are.
3. Only where a class also has contexts that occur once, single strings are compared: there a passage ends.

Each step is one exchange of names; the texts stay with their shard. Names are 64-bit polynomial hashes over
random byte values: with n names, the chance that any two different strings get one name is about n * n / 2 ** 65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, drop_stage
from .common import bucketed_stage, drop_bucketed
from .exchange import LISTS, Lists, answered, exchanged, owners_for

GRAM, WINDOW = 16, 64
FIRST_PREFIX = 96
BATCH_BYTES = 1 << 17       # texts that are hashed together; a longer one alone
ROWS_PER_OWNER = 200_000
PLACE = (1 << 33) - 1       # bits of ``rid`` that hold the place of a row in its run
BASE = 0x9E3779B97F4A7C15
NONE = np.uint32(0xFFFFFFFF)


class Hashed:
    """Some bytes with the sums from which the hash of any of their substrings follows at once."""

    powers: dict = {}

    def __init__(self, data: bytes | np.ndarray):
        values = np.frombuffer(data, dtype=np.uint8)
        n = len(values)
        if not self.powers:
            parts = [hashlib.sha256(bytes([b])).digest()[:8] for b in range(256)]
            self.powers["values"] = np.frombuffer(b"".join(parts), dtype=np.uint64)     # a fixed random number a byte
        if len(self.powers.get("up", ())) < n + 1:
            for name, step in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                table = np.full(max(n, BATCH_BYTES) + 1, step, dtype=np.uint64)
                table[0] = 1
                self.powers[name] = np.multiply.accumulate(table)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.powers["values"][values] * self.powers["up"][:n], dtype=np.uint64, out=self.sums[1:])

    def names(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A name for the bytes from each start to its end; equal bytes have equal names."""
        return self._spread((self.sums[ends] - self.sums[starts]) * self.powers["down"][starts])

    def windows(self, width: int) -> np.ndarray:
        """The names of the ``width`` bytes from every place on."""
        return self._spread((self.sums[width:] - self.sums[:-width]) * self.powers["down"][:len(self.sums) - width])

    @staticmethod
    def _spread(raw: np.ndarray) -> np.ndarray:
        """A fresh array of numbers spread over all bits, in place."""
        raw ^= raw >> np.uint64(31)
        raw *= np.uint64(0xBF58476D1CE4E5B9)
        raw ^= raw >> np.uint64(29)
        return raw


def _sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op``, a minimum or maximum, over every window of ``width`` neighbours, from two smaller windows that may overlap."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = op(x[:-step], x[step:])
        have += step
    return x


def anchors(hashed: Hashed, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Anchors of texts laid end to end. Windows across two texts can only add some."""
    grams = (hashed.windows(GRAM) >> np.uint64(32)).astype(np.uint32)
    grams[grams == NONE] -= np.uint32(1)
    for end in (starts + sizes)[:-1]:
        grams[max(0, end - GRAM + 1):end] = NONE
    least = _sliding(np.minimum, grams, WINDOW)
    edge = np.zeros(WINDOW - 1, dtype=np.uint32)
    chosen = _sliding(np.maximum, np.concatenate([edge, least, edge]), WINDOW)
    return np.flatnonzero((grams == chosen) & (grams != NONE))


def _batches(sizes: np.ndarray) -> Iterator[slice]:
    """Neighbouring texts that are hashed together."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BATCH_BYTES:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if held:
        yield slice(start, len(sizes))


def _anchor_rows(length: int):
    """mapInArrow over (run, rid, text): per text its anchors with ``reach`` bytes to the right, and their first names.

    The texts are hashed where they lie in the batch, without a copy.
    """
    reach = length - WINDOW + 1
    schema = pa.schema([("run", pa.int64()), ("rid", pa.int64()), ("at", pa.binary()), ("names", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
            out = [], [], []
            for part in _batches(np.diff(edges)):
                sizes = np.diff(edges[part.start:part.stop + 1])
                if sizes.max() < length:
                    continue
                starts, hashed = np.cumsum(sizes) - sizes, Hashed(data[edges[part.start]:edges[part.stop]])
                at = anchors(hashed, starts, sizes)
                text = np.searchsorted(starts + sizes, at, side="right")
                at = at[at + reach <= (starts + sizes)[text]]
                names = hashed.names(at, at + FIRST_PREFIX)
                cuts = np.searchsorted(at, np.append(starts, sizes.sum()))
                for j in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[j], cuts[j + 1])
                    for column, x in zip(out, (part.start + j, (at[own] - starts[j]).astype(np.uint32).tobytes(),
                                               names[own].tobytes()), strict=True):
                        column.append(x)
            chosen = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("run").take(chosen), batch.column("rid").take(chosen),
                                              pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], schema=schema)
    return run


def _held(found: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names the sorted ``found`` holds."""
    if not len(found):
        return np.zeros(len(names), dtype=bool)
    return found[np.minimum(np.searchsorted(found, names), len(found) - 1)] == names


def _found(answers: pd.DataFrame, column: str) -> np.ndarray:
    """The one answer to a run, sorted; nothing if there is none."""
    value = answers[column].iloc[0] if len(answers) else None
    return np.empty(0, np.uint64) if value is None else np.sort(np.array(value, dtype=np.int64).view(np.uint64))


def _refine(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """cogroup by run: keep the anchors whose name was found, as one array over the places of the texts in the run."""
    found, out = _found(answers, "found"), {}
    for row in rows.itertuples(index=False):
        keep = _held(found, np.frombuffer(row.names, dtype=np.uint64))
        if keep.any():
            out[row.rid & PLACE] = np.frombuffer(row.at, dtype=np.uint32)[keep].tobytes()
    ats = [out.get(place) for place in range(max(out, default=-1) + 1)]
    return pd.DataFrame({"run": rows["run"].iloc[:1], "ats": [ats]} if out else {"run": [], "ats": []})


class Around:
    """A text with its anchors in repeated intervals: names of classes, contexts and single strings."""

    def __init__(self, text: str, at: bytes, length: int, classes: np.ndarray | None):
        self.data, self.length = text.encode(), length
        self.hashed, self.at = Hashed(self.data), np.frombuffer(at, dtype=np.uint32).astype(np.int64)
        self.classes = self.hashed.names(self.at, self.at + length - WINDOW + 1)
        if classes is not None:     # those that were found to be repeated
            keep = _held(classes, self.classes)
            self.at, self.classes = self.at[keep], self.classes[keep]
        self.low = np.maximum(self.at - WINDOW + 1, 0)
        self.high = np.minimum(self.at + length, len(self.data))

    def contexts(self) -> np.ndarray:
        """Names of the bytes around each anchor, together with how far they reach to both sides."""
        shape = ((self.at - self.low) * (self.length + 1) + (self.high - self.at)).astype(np.uint64)
        names = self.hashed.names(self.low, self.high) + shape * np.uint64(BASE)
        return (names ^ (names >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)

    def wide(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From where to where the contexts of the chosen anchors reach that hold a string of ``length`` bytes."""
        low, high = self.low[chosen], self.high[chosen]
        return low[high - low >= self.length], high[high - low >= self.length]

    def starts(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of all strings of ``length`` bytes in the contexts of the chosen anchors."""
        low, high = self.wide(chosen)
        return np.flatnonzero(_covered(low, high - self.length + 1, len(self.data)))

    def strings(self, starts: np.ndarray) -> np.ndarray:
        return self.hashed.names(starts, starts + self.length)


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some interval from a start up to its end."""
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def _classes(around: Around, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    return around.classes, np.zeros(len(around.at), dtype=bool)


def _contexts(around: Around, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    return around.contexts(), np.zeros(len(around.at), dtype=bool)


def _ends(around: Around, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    """The classes, marked where the context occurs once."""
    return around.classes, ~_held(answers["contexts"], around.contexts())


def _strings(around: Around, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    """The single strings around the anchors of classes where a passage ends.

    All contexts that occur once are taken, and of the others one copy: the first in the run that leads.
    """
    names = around.contexts()
    chosen = _held(answers["ends"], around.classes)
    once = chosen & ~_held(answers["contexts"], names)
    leads = np.flatnonzero(chosen & _held(answers["leads"], names))
    seen = answers.setdefault("seen", set())
    new = [i for i, name in zip(leads.tolist(), names[leads].tolist(), strict=True) if not (name in seen or seen.add(name))]
    once[new] = True
    strings = around.strings(around.starts(once))
    return strings, np.zeros(len(strings), dtype=bool)


def _asked(length: int, wanted: Callable, known: list[str], owners: int, flagged: bool):
    """cogroup by run of texts with the answers so far: coded lists of the names ``wanted`` of all texts."""
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        found, out, lists = {k: _found(answers, k) for k in known}, [], Lists(owners, flagged)
        for row in rows.itertuples(index=False):
            names, marks = wanted(Around(row.text, row.at, length, found.get("classes")), found)
            out += lists.add(row.run, names, marks)
        return lists.frame(out + lists.flush())
    return run


def _digest(length: int, keep_bytes: bool):
    """cogroup by run: what is left of each text."""
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        found, out = {k: _found(answers, k) for k in ("classes", "contexts", "ends", "strings")}, []
        for row in rows.itertuples(index=False):
            around = Around(row.text, row.at, length, found["classes"])
            repeated = _held(found["contexts"], around.contexts())
            low, high = around.wide(repeated)
            single = around.starts(_held(found["ends"], around.classes) & ~repeated)
            single = single[_held(found["strings"], around.strings(single))]
            removed = _covered(np.append(low, single), np.append(high, single + length), len(around.data))
            edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
            kept = np.frombuffer(around.data, dtype=np.uint8)[~removed].tobytes()
            out.append((row.id, len(around.data), int(removed.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(),
                        edges.tolist(), kept if keep_bytes and len(edges) else None))
        return pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "edges", "kept"])
    return run


def _cogroup(rows: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    return rows.groupBy("run").cogroup(answers.groupBy("run")).applyInPandas(fn, schema)


def _repeated(staged: DataFrame, length: int) -> DataFrame:
    """``run, ats``: the anchors whose first prefix occurs twice, by the places of their texts in the run; null for texts without any."""
    rows = bucketed_stage(staged.select("run", "rid", "text").mapInArrow(
        _anchor_rows(length), "run long, rid long, at binary, names binary"), "run")
    n = F.octet_length("names") / 8
    total, runs = rows.agg(F.coalesce(F.sum(n), F.lit(0)), F.count_distinct("run")).first()
    names = rows.select("run", F.col("names").alias("fp"), F.repeat(F.lit("\0"), n.cast("int")).cast("binary").alias("mark"))
    answers = exchanged(names, int(total), runs, ROWS_PER_OWNER)
    kept = cut_lineage(_cogroup(rows, answers, _refine, "run long, ats array<binary>"))
    drop_bucketed(rows)
    drop_stage(answers)
    return kept


def repeated_passages(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                      keep_bytes: bool = True) -> DataFrame:
    """One row per input row: ``id_col, n_bytes, n_removed, n_spans, kept_sha256, edges, kept``.

    Texts are UTF-8 bytes, null is empty. ``edges`` holds the byte offsets where removed runs start and end, in
    turn. With ``keep_bytes``, ``kept`` are the remaining bytes of texts that lose some, else null. Matches never
    cross texts; a row that is repeated, with or without the same id, repeats its text. ``length`` is at least
    ``WINDOW + FIRST_PREFIX``. An empty table gives an empty result.
    """
    if length < WINDOW + FIRST_PREFIX:
        raise ValueError(f"length must be at least {WINDOW + FIRST_PREFIX}")
    id_type = docs.schema[id_col].dataType
    staged = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                         F.monotonically_increasing_id().alias("rid"))
    staged = bucketed_stage(staged.withColumn("run", F.shiftright("rid", 33)), "run")
    ats = _repeated(staged, length)
    # read by place and not searched, so that no row carries a copy of its run's array
    at = F.get("ats", F.col("rid").bitwiseAND(F.lit(PLACE)).cast("int"))
    joined = staged.join(ats.hint("shuffle_hash"), "run", "left").select("run", "id", "text", at.alias("at"))
    texts = bucketed_stage(joined.filter("at is not null").select("run", F.col("id").cast("string").alias("id"), "text", "at"), "run")
    total, runs = texts.agg(F.coalesce(F.sum(F.octet_length("at")), F.lit(0)) / 4, F.count_distinct("run")).first()
    answers = texts.select("run").distinct()
    known: list[str] = []
    for name, wanted, more in (("classes", _classes, 1), ("contexts", _contexts, 1), ("ends", _ends, 1),
                               ("strings", _strings, 2)):
        owners, flagged = owners_for(int(total) * more, runs, ROWS_PER_OWNER), name == "ends"
        lists = cut_lineage(_cogroup(texts, answers, _asked(length, wanted, list(known), owners, flagged), LISTS))
        found = answered(lists, owners, flagged).withColumnRenamed("found", name)
        found = found.withColumnRenamed("lead", "leads") if name == "contexts" else found.drop("lead")
        before, answers = answers, cut_lineage(answers.join(found, "run", "left"))
        drop_stage(lists)
        drop_stage(before)
        known += [name, "leads"] if name == "contexts" else [name]
    changed = _cogroup(texts, answers, _digest(length, keep_bytes),
                       "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                       "edges array<long>, kept binary")
    none = F.lit(0).cast("long")
    whole = joined.filter("at is null").select(
        F.col("id").alias(id_col), F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        F.array().cast("array<long>").alias("edges"), F.lit(None).cast("binary").alias("kept"))
    return whole.unionByName(changed.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col))
