"""Filters on flags, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def flag_sum_filter(df: DataFrame, flags: Sequence[Column], wanted: int | None = None) -> DataFrame:
    """Rows on which exactly ``wanted`` (default: all) of the conditions hold; NULL counts as false."""
    total = sum((F.when(f, 1).otherwise(0) for f in flags[1:]), F.when(flags[0], 1).otherwise(0))
    return df.where(total == (len(flags) if wanted is None else wanted))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide to long: one row (ids, variable, value) per value column."""
    return df.unpivot(list(ids), list(values), "variable", "value")


def invert_map(df: DataFrame, key: str, values: str) -> DataFrame:
    """(key, array of values) to one row (value, key), values upper-cased."""
    return df.select(F.explode(F.transform(values, F.upper)).alias("value"), F.col(key).alias("key"))


def complete_axis(df: DataFrame, day: str, value: str, low: str, high: str) -> DataFrame:
    """Every day from ``low`` to ``high``, with 0 where the daily table has no row."""
    axis = df.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(low).cast("date"), F.lit(high).cast("date"))).alias(day))
    return axis.join(df, day, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def set_split(left: DataFrame, right: DataFrame, name: str = "key") -> DataFrame:
    """Members of two one-column tables tagged ``both``, ``left`` or ``right``, by one shared aggregation."""
    sides = (left.toDF(name).withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
             .unionByName(right.toDF(name).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))))
    seen = sides.groupBy(name).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.select(name, F.when(F.col("_l") + F.col("_r") == 2, "both")
                       .when(F.col("_l") == 1, "left").otherwise("right").alias("side"))
