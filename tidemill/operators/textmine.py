"""Text mining over document tables: counts, bigrams, vocabularies, sparse vectors, TF-IDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import bigrams
from ..session import cut_lineage
from .ordering import global_index, index_within

MAX_LITERAL_WORDS = 1000
BROADCAST_TERMS = 100_000
SLICE_BYTES = 1 << 20    # of token arrays that are Python objects at a time


def count_words(df: DataFrame, tokens: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Word counts of an array-of-words expression; empty words are dropped."""
    return df.select(*keep, F.explode(tokens).alias("word")).where("word <> ''").groupBy(*keep, "word").agg(F.count("*").alias("n"))


def drop_words(df: DataFrame, word: str, stop: Sequence[str] | DataFrame) -> DataFrame:
    """Remove stop words: a short list becomes a literal predicate, a table an anti-join."""
    if isinstance(stop, DataFrame):
        return df.join(stop.toDF("_stop").distinct(), F.lower(word) == F.col("_stop"), "left_anti")
    if len(stop) > MAX_LITERAL_WORDS:
        return drop_words(df, word, df.sparkSession.createDataFrame([(w,) for w in stop], "_stop string"))
    return df.where(~F.lower(word).isin(*stop))


def top_bigrams(df: DataFrame, tokens: Column, stop: Sequence[str], n: int = 200, min_freq: int = 2) -> DataFrame:
    """The ``n`` most frequent adjacent pairs free of stop words, ties in pair order."""
    pairs = df.select(F.explode(bigrams(tokens)).alias("p")).select("p.a", "p.b")
    kept = drop_words(drop_words(pairs, "a", stop), "b", stop)
    return (kept.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= min_freq)
                .orderBy(F.desc("n"), "a", "b").limit(n))


def merge_bigrams(df: DataFrame, tokens: Column, pairs: Sequence[tuple[str, str]], name: str,
                  joiner: str = "__") -> DataFrame:
    """Merge listed pairs in each token array, greedily from the left (the list is a top-n, so it is short). NULL stays NULL."""
    wanted = frozenset(pairs)

    def join_pairs(tokens):
        if tokens is None:
            return None
        out, i = [], 0
        while i < len(tokens):
            hit = i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in wanted
            out.append(f"{tokens[i]}{joiner}{tokens[i + 1]}" if hit else tokens[i])
            i += 2 if hit else 1
        return out

    @F.arrow_udf("array<string>")
    def merged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = max(1, len(batch) * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, max(1, len(batch)), rows):
                yield pa.array([join_pairs(t.as_py()) for t in batch.slice(at, rows)], pa.list_(pa.string()))

    return df.withColumn(name, merged(tokens))


def document_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery; on a plain table this needs no column at all."""
    return docs.agg(F.count("*").cast("double")).scalar()


def _names(doc: str | Sequence[str]) -> list[str]:
    return [doc] if isinstance(doc, str) else list(doc)


def term_counts(df: DataFrame, doc: str | Sequence[str], term: str) -> DataFrame:
    """(doc, term, n): occurrences per document, the common base of vocabulary and weights. Several columns may name a document."""
    return df.groupBy(*_names(doc), term).agg(F.count("*").alias("n"))


def prune_vocab(counts: DataFrame, term: str, n_docs: Column, min_df: float | int = .03, max_df: float = .95) -> DataFrame:
    """Terms of (doc, term, n) rows with ``min_df <= df < max_df``, and their document frequency.

    ``min_df`` is a share of the documents, or an absolute count if it is an integer; ``max_df``
    is a share. The frequency is counted over ``n`` so that a plan which also uses the counts
    shuffles them once.
    """
    low = F.lit(min_df) if isinstance(min_df, int) else F.lit(min_df) * n_docs
    return (counts.groupBy(term).agg(F.count_if(F.col("n") > 0).alias("df"))
                  .where((F.col("df") >= low) & (F.col("df") < F.lit(max_df) * n_docs)))


def vocab_index(vocab: DataFrame, term: str, name: str = "term_index") -> DataFrame:
    """Dense 0-based index in term order."""
    return global_index(vocab, [term], name=name)


def stem_vocab(df: DataFrame, term: str, stemmer: Callable[[Column], Column], min_length: int = 3,
               joiner: str = "__") -> DataFrame:
    """Distinct words with plain lower-case ones stemmed; results shorter than ``min_length`` are dropped.

    Words are made distinct before the stemmer runs, so it sees each word once. They are stored, as Spark drops a
    ``distinct`` whose result is made distinct again.
    """
    plain = F.col(term).rlike("^[a-z]") & ~F.contains(F.col(term), F.lit(joiner))
    distinct = cut_lineage(df.select(term).distinct())
    stemmed = F.when(plain, stemmer(F.col(term))).otherwise(F.col(term))
    return distinct.select(stemmed.alias(term)).distinct().where(F.length(term) >= min_length)


def doc_term_counts(counts: DataFrame, doc: str, term: str, vocab: DataFrame, index: str = "term_index") -> DataFrame:
    """(doc, index, n) for the terms of the vocabulary.

    A vocabulary of up to ``BROADCAST_TERMS`` terms is sent to the counts; a larger one is joined by a shuffle.
    """
    side = vocab.select(term, index)
    side = F.broadcast(side) if vocab.count() <= BROADCAST_TERMS else side
    return counts.join(side, term).select(doc, index, "n")


def tfidf(counts: DataFrame, doc: str, term: str, n_docs: Column, min_df: float | int = 8, max_df: float = .95) -> DataFrame:
    """Sublinear tf times smooth idf, L2-normalised per document, in long form (doc, term, weight)."""
    return tfidf_by(counts, doc, term, idf_weights(counts, term, n_docs, min_df, max_df))


def idf_weights(counts: DataFrame, term: str, n_docs: Column, min_df: float | int = 8, max_df: float = .95) -> DataFrame:
    """(term, idf) of the terms whose document frequency is in bounds; learn it from the training documents alone."""
    return prune_vocab(counts, term, n_docs, min_df, max_df).select(term, (F.log((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf_by(counts: DataFrame, doc: str | Sequence[str], term: str, idf: DataFrame, index: str | None = None) -> DataFrame:
    """Weights (doc, term, weight) of any documents' counts by given idf values; terms without one are left out.

    Several columns may name a document. ``index`` is a column of ``idf`` that stands for the term from here on, such as its number.
    """
    raw = counts.join(idf, term).select(*_names(doc), F.col(index or term).alias(term), ((F.log("n") + 1) * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*_names(doc))))
    return raw.select(*_names(doc), term, (F.col("_w") / norm).alias("weight"))


def concat_by(df: DataFrame, owner: str, order: str, text: str, separator: str = " ",
              rows_per_part: int = 10_000, chars_per_part: int = 50_000_000) -> DataFrame:
    """All texts of an owner joined in order, as (owner, part, text).

    One rule holds for every owner: its rows are cut into blocks of ``rows_per_part``, and a block into pieces
    whose texts start within the same ``chars_per_part`` characters. ``part`` is
    ``block * 1000000 + piece``, so parts of an owner are in order, and no task gathers more than
    one block; nothing is left out.
    """
    placed = index_within(df.select(owner, order, text), [owner], [order, text], name="_pos")
    placed = placed.withColumn("_block", F.floor(F.col("_pos") / rows_per_part).cast("bigint"))
    length = F.coalesce(F.length(text), F.lit(0)) + len(separator)
    before = F.sum(length).over(Window.partitionBy(owner, "_block").orderBy("_pos")) - length
    placed = placed.withColumn("part", F.col("_block") * 1_000_000 + F.floor(before / chars_per_part).cast("bigint"))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", text))), lambda e: e[text]), separator)
    return placed.groupBy(owner, "part").agg(texts.alias(text))
