"""From raw documents to token ids in five stages; each calls one operator of ``tidemill.llm``.

Every stage works on all rows that the one before has kept, and all but the last return the columns of
``documents``. ``run`` writes each result to the shared folder, so a lost executor never replays a finished stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, exact, language, mixing, simhash
from tidemill.llm.queries import documents, vocabulary
from tidemill.session import cut_lineage

# language identification learns from the data, SimHash and the transducer are no SQL
ORACLE_SQL: str | None = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents too far from every language learned from the labelled ones go, as do those without a letter."""
    return language.drop_rejected(docs, language.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of exactly equal texts, the document with the smallest id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash (4 words, at most 4 bits), the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn; a document comes as often as it is drawn, three times at most."""
    return mixing.mixed_documents(docs, weights=(5, 2, 1), cap=3.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents with token ids in place of the text."""
    return bpe.with_ids(docs, *vocabulary(spark))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
