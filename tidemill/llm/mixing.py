"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source should appear ``target / source size`` times. The whole part is certain; the
fraction is a probability. The pivotal method takes two documents with fractional probabilities and moves
words from one to the other, in a random direction whose odds keep both expectations, until one probability
is 0 or 1. So the words taken stay the same but for one last document. Chunks of a source are rounded in
parallel, the longest documents first and each against all shorter ones as a pool. Each chunk leaves one, usually its
shortest, open, and these residuals are combined in a tree of further rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import global_index
from ..session import cut_lineage
from .common import join_classes, n_words, packed, uniform

ROWS_PER_CHUNK = 1_000
FAN_IN = 64
SEED = "mix"
EDGE = 1e-12


def _units(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows with the same id, source and text are one unit with ``n`` members, which share their copies."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        n_words(F.col(text_col)).alias("size"), F.xxhash64(text).alias("h"))
            .groupBy("id", "source", "size", "h").agg(F.count("*").alias("n")))


def _key():
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")


def targets(units: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Per source: ``key, units, source_size, target``, capped at ``cap`` times the size, the excess reshared.

    Sources in code point order, null last, take the weights in turn.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                          F.count("*").alias("units"))
    sources = global_index(sources, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = cut_lineage(sources.select(_key(), "units", "source_size", weight.cast("double").alias("weight")))
    total, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total / all_weights if total else 0.0), -1
    limit = F.col("source_size") * cap
    while True:   # each round caps at least one more source, usually nearly all of them at once
        above = F.col("weight") * level > limit
        taken, free, now = sources.agg(F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
                                       F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
                                       F.count(F.when(above, 1))).first()
        if now == full or not total or not free:
            break
        level, full = (total - taken) / free, now
    return sources.select("key", "units", "source_size",
                          F.least(limit, F.col("weight") * level).alias("target"))


def _transfer(p: float, mass: float, q: float, weight: float, coin: float) -> tuple[float, float, float]:
    """Move words between two open shares, ``p`` of ``mass`` words and ``q`` of ``weight``, until one is integral.

    The odds of the direction keep both expectations. The coin that decides is stretched back to a uniform number.
    """
    gain = min(mass * (1 - p), weight * q)      # words the first can take over
    loss = min(mass * p, weight * (1 - q))      # words it can give away
    odds = loss / (gain + loss)
    if coin < odds:
        return p + gain / mass, q - gain / weight, coin / odds
    return p - loss / mass, q + loss / weight, (coin - odds) / (1 - odds)


def _open(p: float) -> bool:
    return EDGE < p < 1 - EDGE


def _round_pool(rows: list[dict]) -> None:
    """Rows by descending mass with one common probability: each is paired with the pool of all lighter ones.

    The pool keeps a common probability, so its state is two numbers, and the last open row is the lightest,
    unless a row outweighs all that follow.
    """
    left, p = float(sum(r["mass"] for r in rows)), rows[0]["p"] if rows else 0.0
    for row in rows:
        row["p"], left = p, left - row["mass"]
        if row["mass"] and left > 0 and _open(p):
            row["p"], p, row["coin"] = _transfer(p, row["mass"], p, left, row["coin"])


def _round_pairs(rows: list[dict]) -> None:
    """Rows with different probabilities: the open one is paired with the next."""
    held = None
    for row in rows:
        if held and row["mass"] and _open(row["p"]):
            row["p"], held["p"], row["coin"] = _transfer(row["p"], row["mass"], held["p"], held["mass"], row["coin"])
        if row["mass"] and _open(row["p"]):
            held = row


def _pivot(first: bool, last: bool):
    """mapInArrow over rows sorted by (key, chunk): decide all but one document of each chunk.

    ``coin`` is a uniform number per row, ``mass`` its words. With ``last`` the remaining one is drawn as well.
    """
    def rounded(rows: list[dict]) -> list[dict]:
        (_round_pool if first else _round_pairs)(rows)
        for row in rows:
            row["open"] = bool(row["mass"]) and _open(row["p"]) and not last
            if not row["open"]:
                row["p"] = float(row["coin"] < row["p"]) if row["mass"] and _open(row["p"]) else float(round(row["p"]))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []       # of the chunk that may go on: chunks are small
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (row["key"], row["chunk"]) != (held[0]["key"], held[0]["chunk"]):
                    out += rounded(held)
                    held = []
                held.append(row)
            schema = _schema(batch.schema.field("id").type)
            yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(rounded(held), schema)
    return run


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("key", pa.string()), ("chunk", pa.int64()), ("id", id_type), ("source", pa.string()),
                      ("size", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("sure", pa.int64()),
                      ("source_size", pa.int64()), ("target", pa.float64()), ("mass", pa.int64()),
                      ("p", pa.float64()), ("open", pa.bool_())])


def _row(id_type: str) -> str:
    return (f"key string, chunk long, id {id_type}, source string, size long, h long, n long, sure long, source_size long, "
            "target double, mass long, p double, open boolean")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per unit: ``id, source, size, h, n, source_size, target, copies``.

    Size is the number of words (null text: 0). Documents without words get no copies, nothing is left of an
    empty table. All random choices depend on the documents alone, so reruns agree. ``h`` is ``xxhash64`` of
    the text, ``n`` the number of equal rows that share the decision. Ids may be of any type that can be sorted.
    """
    units = cut_lineage(_units(docs, id_col, text_col, source_col).withColumn("key", _key()))
    plan = targets(units, weights, cap)
    total, widest = plan.agg(F.coalesce(F.sum("units"), F.lit(0)), F.coalesce(F.max("units"), F.lit(1))).first()
    rows = join_classes(units, plan, "key", "units", total)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.select("*", F.floor(rate).alias("sure"), (rate - F.floor(rate)).alias("p"),
                       (F.col("size") * F.col("n")).alias("mass"),
                       F.pmod(F.xxhash64("id", "h", F.lit(SEED)),
                              F.ceil(F.col("units") / ROWS_PER_CHUNK)).alias("chunk")).drop("units")
    width, level, decided, row = math.ceil(widest / ROWS_PER_CHUNK), 0, [], _row(units.schema["id"].dataType.simpleString())
    while True:
        coins = rows.withColumn("coin", uniform("id", "h", "size", F.lit(f"{SEED} {level}")))
        coins = coins.repartition("key", "chunk").sortWithinPartitions(
            "key", "chunk", F.col("mass").desc(), F.xxhash64("id", "h", F.lit(SEED)), "id", "h")
        rounded = cut_lineage(coins.mapInArrow(_pivot(first=level == 0, last=width <= 1), row))
        decided.append(rounded.filter(~F.col("open")))
        if width <= 1:
            break
        rows = rounded.filter("open").drop("open").withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
        width, level = math.ceil(width / FAN_IN), level + 1
    everything = decided[0]
    for more in decided[1:]:
        everything = everything.unionByName(more)
    copies = F.when(F.col("size") > 0, F.col("sure") + F.round("p").cast("long")).otherwise(F.lit(0))
    return everything.select("id", "source", "size", "h", "n", "source_size", "target",
                             copies.cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every input row as often as it was drawn, with all its columns."""
    drawn = (mix(docs, weights, cap, id_col, text_col, source_col).filter("copies > 0")
             .select("id", "source", "size", "h", "copies"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(packed(docs), F.col(id_col).alias("i"), F.col(source_col).alias("s"),
                       F.xxhash64(text).alias("x"))
    same = F.col("i").eqNullSafe(F.col("id")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("x") == F.col("h"))
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return rows.join(drawn, same).select("row", once).select("row.*")
