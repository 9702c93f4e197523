"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], kinds: Sequence | None = None,
                      rows_per_file: int = 5_000_000) -> None:
    """Route rows to one folder per class; with ``kinds`` all other classes (of the first key) are dropped.

    Rows are rebalanced by class first: small classes share few files, and adaptive execution splits a hot class.
    """
    if kinds is not None:
        df = df.where(F.col(by[0]).isin(*kinds))
    df.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by).option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def vocabulary_lines(vocab: DataFrame, term: str = "term", index: str = "term_index") -> DataFrame:
    """Lines ``term:index``."""
    return vocab.select(F.concat_ws(":", term, F.col(index).cast("string")).alias("value"))


def sparse_vector_lines(counts: DataFrame, doc: str, index: str = "term_index", n: str = "n",
                        docs: DataFrame | None = None) -> DataFrame:
    """Lines ``doc,idx:n,idx:n`` with ascending indexes; a line is bounded by the vocabulary.

    ``docs`` may list all documents: those without any term get a line of their id alone.
    """
    pairs = F.transform(F.array_sort(F.collect_list(F.struct(index, n))),
                        lambda e: F.concat_ws(":", e[index].cast("string"), e[n].cast("string")))
    lines = counts.groupBy(doc).agg(F.array_join(pairs, ",").alias("_pairs"))
    if docs is not None:
        lines = docs.select(doc).distinct().join(lines, doc, "left")
    return lines.select(F.concat_ws(",", F.col(doc).cast("string"), "_pairs").alias("value"))


def append_rows(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """Append rows to the parquet table at ``path``; a key that is repeated, or there already, raises and adds nothing."""
    there = df.sparkSession.read.parquet(path).select(*key)
    clash = df.groupBy(*key).count().where("count > 1").select(*key).unionByName(df.select(*key).join(there, list(key), "left_semi"))
    taken = clash.limit(1).collect()
    if taken:
        raise ValueError(f"key {tuple(taken[0])} is not unique")
    df.write.mode("append").parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.text(path)
