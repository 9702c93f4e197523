"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import bucketed_stage, drop_bucketed    # noqa: F401  the operators take them from here

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
HOT_CLASSES = 1000


def packed(docs: DataFrame) -> Column:
    """The whole input row as one struct, so that no column of it can clash with an internal name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def count_upto(values: Column, x: Column, size: int | None = None) -> Column:
    """How many entries of the sorted array ``values`` are at most ``x``, by halving steps over its index.

    ``values`` should be a column or a constant that the optimizer can fold, as it is read at every step.
    ``size``: its length, if that is known.
    """
    if size is None:
        steps = F.transform(F.sequence(F.lit(30), F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))
        steps = F.filter(steps, lambda s: s <= F.size(values))
    else:
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))]).cast("array<int>")
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= F.size(values)) & (F.get(values, at + s - 1) <= x), at + s).otherwise(at))


def uniform(*keys: Column | str) -> Column:
    """A number from 0 up to 1 that depends on ``keys`` alone."""
    return F.call_function("shiftrightunsigned", F.xxhash64(*keys), F.lit(11)) / float(1 << 53)


def join_classes(rows: DataFrame, classes: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per class, where single classes may hold a large share of the rows.

    A class with more than ``total / HOT_CLASSES`` of the rows is hot; by counting there are fewer than
    ``HOT_CLASSES`` of them, so these are broadcast and their rows stay where they are. All others are
    joined by a shuffle whose partitions are then even. ``total``: the sum of ``count`` over all classes.
    """
    hot = F.broadcast(classes.filter(F.col(count) * HOT_CLASSES > total))
    cold = classes.filter(F.col(count) * HOT_CLASSES <= total)
    return (rows.join(hot, key, "inner")
            .unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, "left")))
