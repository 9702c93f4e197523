"""Grouped statistics. All of them are partial + final hash aggregates, so hot keys shrink map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .ordering import index_within, quantiles


PAIRS_PER_PASS = 500


def daily_stats(df: DataFrame, ts: str, value: str, digits: int = 3) -> DataFrame:
    """Sum, mean, sample standard deviation, maximum and minimum per calendar day."""
    stats = {"total": F.sum, "mean": F.avg, "std": F.stddev_samp, "maximum": F.max, "minimum": F.min}
    return (df.groupBy(F.col(ts).cast("date").alias("day"))
              .agg(*[F.round(fn(value), digits).alias(n) for n, fn in stats.items()])
              .orderBy("day"))


def reduce_by_key(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Reduce with any associative aggregates, given as ``{output name: aggregate}``."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def sum_items(df: DataFrame, group: Sequence[str], items: str, item: str = "item", qty: str = "qty") -> DataFrame:
    """Total quantity per group and item of an ``array<struct<item, qty>>`` column."""
    return (df.select(*group, F.explode(items).alias("_e"))
              .groupBy(*group, F.col(f"_e.{item}").alias("item"))
              .agg(F.sum(f"_e.{qty}").alias("qty")))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole over all rows as one aggregate expression."""
    return F.round(F.try_divide(F.sum(part) * 100.0, F.sum(whole)), digits)


def mode_value(df: DataFrame, value: str, by: Sequence[str] = (), ignore: str | None = None) -> DataFrame:
    """Most frequent value, the smallest one on ties; NULL and the ``ignore`` sentinel never win."""
    kept = df.where(F.col(value).isNotNull())
    if ignore is not None:
        kept = kept.where(F.col(value) != ignore)
    counts = kept.groupBy(*by, value).agg(F.count("*").alias("n"))
    ranked = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(value).alias("v"))).alias("_b"))
    return ranked.select(*by, F.col("_b.v").alias("mode"), (-F.col("_b.neg")).alias("n"))


def iqr_bounds(df: DataFrame, value: str, by: Sequence[str] = (), t: float = 1.5) -> DataFrame:
    """Quartiles and the fences ``q1 - t*iqr`` and ``q3 + t*iqr``."""
    iqr = F.col("q3") - F.col("q1")
    return (quantiles(df, value, [0.25, 0.75], by, ["q1", "q3"])
            .withColumn("lower", F.col("q1") - t * iqr)
            .withColumn("upper", F.col("q3") + t * iqr))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, distinct, mean, deviation, extremes, quartiles, most frequent value and its frequency per column.

    The moments come from one wide aggregation; everything that needs order or
    frequency works on the value counts, which are taken once.
    """
    moments = df.agg(*[F.struct(F.lit(c).alias("variable"), F.count(c).alias("n"), F.avg(c).alias("mean"),
                                F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("minimum"),
                                F.max(F.col(c).cast("double")).alias("maximum")).alias(f"s{i}") for i, c in enumerate(cols)])
    basic = moments.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("e")).select("e.*")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols])).alias("e")).select("e.*")
    counts = cut_lineage(long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count("*").alias("freq")))
    top = (counts.groupBy("variable")
                 .agg(F.count("*").alias("n_distinct"),
                      F.min(F.struct((-F.col("freq")).alias("neg"), F.col("value").alias("v"))).alias("_b"))
                 .select("variable", "n_distinct", F.col("_b.v").alias("top"), (-F.col("_b.neg")).alias("freq")))
    quart = quantiles(counts, "value", [0.25, 0.5, 0.75], ["variable"], ["q1", "median", "q3"], weight="freq")
    return basic.join(top, "variable", "left").join(quart, "variable", "left")


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """All pairwise Pearson correlations, as rows (a, b, corr) for both orders.

    Each pair uses the rows where both of its columns are present, for any number of columns. A pass
    over the table covers ``PAIRS_PER_PASS`` pairs.
    """
    pairs = list(combinations(cols, 2))
    parts = [_correlations(df, pairs[i:i + PAIRS_PER_PASS], digits) for i in range(0, len(pairs), PAIRS_PER_PASS)]
    itself = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, corr double")
    return reduce(DataFrame.unionByName, parts, itself)


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int) -> DataFrame:
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.round(f"`{a}|{b}`", digits).alias("corr"))
               for a, b in pairs for x, y in ((a, b), (b, a))]
    return wide.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _on_axis(df: DataFrame, place: Column, axis: DataFrame, name: str) -> DataFrame:
    """Counts per place; places of the axis that are empty count 0, and others appear when they occur."""
    counted = df.groupBy(place.cast("bigint").alias(name)).agg(F.count("*").alias("n"))
    empty = axis.select(F.col("id").alias(name), F.lit(0).cast("bigint").alias("n"))
    return counted.unionByName(empty).groupBy(name).agg(F.sum("n").alias("n"))


def histogram(df: DataFrame, value: str, width: float = 10, bins: int = 11) -> DataFrame:
    """Counts per ``min(value div width, bins - 1)``; empty bins are kept with count 0.

    If there are any, values below 0 are counted in bin -1 and missing ones in bin NULL.
    """
    place = F.greatest(F.least(F.floor(F.col(value) / width), F.lit(bins - 1)), F.lit(-1))
    return _on_axis(df, F.when(F.col(value).isNotNull(), place), df.sparkSession.range(bins), "bin")


def band_counts(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts per half-open band ``[edge, next edge)``, the last one unbounded; empty bands count 0.

    If there are any, values below the first edge are counted in band -1 and missing ones in band NULL.
    """
    band = F.when(F.col(value).isNotNull(), F.lit(-1))
    for i, low in enumerate(edges):
        band = F.when(F.col(value) >= low, F.lit(i)).otherwise(band)
    return _on_axis(df, band, df.sparkSession.range(len(edges)), "band")



def missing_counts(df: DataFrame, cols: Sequence[str] | None = None, sentinel: str = "NA") -> DataFrame:
    """Sentinel and NULL counts of all columns in one pass, as rows (column_name, n_sentinel, n_null)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).cast("string") == sentinel).alias(f"s_{c}") for c in cols],
                  *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s_{c}").alias("n_sentinel"),
                              F.col(f"n_{c}").alias("n_null")) for c in cols])
    return wide.select(F.explode(rows).alias("_e")).select("_e.*")


def others_bucket(df: DataFrame, key: str, value: str, main: Sequence, by: Sequence[str] = (),
                  others: str = "Others") -> DataFrame:
    """Group sums with every key outside ``main`` pooled under one label."""
    label = F.when(F.col(key).isin(*main), F.col(key)).otherwise(F.lit(others))
    return df.groupBy(*by, label.alias(key)).agg(F.sum(value).alias(value))


def valid_extent(df: DataFrame, value: str) -> DataFrame:
    """Minimum ignoring zeros and maximum, both ignoring NULL."""
    return df.agg(F.min(F.nullif(F.col(value), F.lit(0.0))).alias("low"), F.max(value).alias("high"))


def zipf_rank(df: DataFrame, term: str, by: Sequence[str] = ()) -> DataFrame:
    """Terms with their counts and 1-based frequency rank (ties in term order), per corpus if ``by`` is given."""
    counts = df.groupBy(*by, term).agg(F.count("*").alias("n"))
    return (index_within(counts, by, [F.desc("n"), F.asc(term)], name="_pos")
            .withColumn("rank", F.col("_pos") + 1).drop("_pos"))


def count_of_counts(df: DataFrame, term: str, by: Sequence[str] = ()) -> DataFrame:
    """How many terms share each frequency."""
    counts = df.groupBy(*by, term).agg(F.count("*").alias("n"))
    return counts.groupBy(*by, "n").agg(F.count("*").alias("n_terms"))
