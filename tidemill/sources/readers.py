"""Readers, each with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str], separator: str | None = None) -> DataFrame:
    """Text lines; a literal ``separator`` splits records inside the reader, without loading a file whole."""
    reader = spark.read
    if separator is not None:
        reader = reader.option("lineSep", separator)
    return reader.text(paths)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(paths)


def read_xml(spark: SparkSession, paths: str, row_tag: str, schema: str) -> DataFrame:
    """One row per ``row_tag`` element; attributes are the ``_``-prefixed columns."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(paths)


def union_sources(spark: SparkSession, paths: Sequence[str], schema: str, dedup: bool = True) -> DataFrame:
    """Read several CSV feeds as one table; equal rows of overlapping feeds appear once."""
    df = read_csv(spark, list(paths), schema)
    return df.dropDuplicates() if dedup else df
