"""Exact duplicates found by exchanging Golomb-coded fingerprints.

1. Every input partition (a *run*) keeps its rows in a stage table and sends each owner, a range of the
   fingerprint space, its distinct 64-bit fingerprints sorted and Golomb-Rice coded: about
   ``64 - log2(list length * owners)`` + 2 bits each.
2. An owner merges its lists and answers each with a bitmap: which of its fingerprints also occur elsewhere.
3. Runs mark their rows with the answers. Rows not marked are unique and never leave their place. Only
   suspects are shuffled, grouped by fingerprint and by the bytes of the text itself.

Texts are equal when identical after replacing each run of ASCII white space by one space; null counts as
empty. Of equal texts the row with the smallest id stays (a null id comes last; among repeated ids one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .common import SPACES, bucketed_stage, count_upto, join_classes, packed
from .exchange import exchanged

ROWS_PER_OWNER = 20_000     # an owner is worth a task


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The rows with ``id, sha, fp, rid, row`` and ``suspect``, and their number."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    staged = docs.select(F.col(id_col).alias("id"), packed(docs), norm.alias("norm"))
    staged = staged.select("id", "row", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("fp"),
                           F.monotonically_increasing_id().alias("rid"))
    staged = bucketed_stage(staged.withColumn("run", F.shiftright("rid", 33)), "run")
    total, runs = staged.agg(F.count("*"), F.count_distinct("run")).first()
    suspects = exchanged(staged.select("run", "fp", F.lit(False).alias("mark")), total, runs, ROWS_PER_OWNER)
    marked = staged.join(suspects.hint("shuffle_hash"), "run", "left")
    place = count_upto(F.col("found"), F.col("fp")) - 1
    suspect = F.coalesce(F.get("found", place) == F.col("fp"), F.lit(False))
    return marked.withColumn("suspect", suspect).drop("found", "lead", "run"), total


def _classes(suspects: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """One row per distinct text among the suspects, grouped by the bytes of the text."""
    norm = F.regexp_replace(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), SPACES, " ")
    best = F.min(F.struct(F.col("id").isNull(), "id", "rid", *keep)).alias("best")
    return suspects.groupBy("fp", norm.alias("norm")).agg(best, F.count("*").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty and are equal to each other; an empty table gives an empty result. Rows
    repeated with the same id are members like any other, and one of them is kept.
    """
    marked, total = _marked(docs, id_col, text_col)
    one = F.lit(1).cast("long")
    single = marked.filter(~F.col("suspect")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), one.alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    suspects = marked.filter("suspect")
    classes = cut_lineage(_classes(suspects, text_col).select(
        F.sha2("norm", 256).alias("sha"), F.col("best.id").alias("keep_id"),
        F.col("best.rid").alias("keep_rid"), "group_size"))
    joined = join_classes(suspects.select("id", "sha", "rid"), classes, "sha", "group_size", total)
    return single.unionByName(joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The smallest row of each class travels through the aggregation itself, so nothing is joined back.
    """
    marked, _ = _marked(docs, id_col, text_col)
    single = marked.filter(~F.col("suspect")).select("row.*")
    return single.unionByName(_classes(marked.filter("suspect"), text_col, "row").select("best.row.*"))
