import math
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.functions.stem import stem
from tidemill.operators import textmine as T


def docs(spark):
    return spark.createDataFrame([(1, "new york is big"), (2, "new york new york"), (3, "big apple")], "d int, t string")


def test_bigrams_merge_greedily(spark):
    df = spark.createDataFrame([(["a", "b", "b", "c", "a", "b"],), (["b"],), ([],)], "t array<string>")
    out = T.merge_bigrams(df, F.col("t"), [("a", "b"), ("b", "b"), ("b", "c")], "m")
    assert [r["m"] for r in out.collect()] == [["a__b", "b__c", "a__b"], ["b"], []]


def test_top_bigrams_skip_stop_words(spark):
    out = T.top_bigrams(docs(spark), F.split("t", " "), stop=["is"])
    assert rows(out) == [("new", "york", 3)]


def test_vocabulary_bounds(spark):
    counts = T.term_counts(docs(spark).select("d", F.explode(F.split("t", " ")).alias("w")), "d", "w")
    out = T.prune_vocab(counts, "w", T.document_count(docs(spark)), min_df=2 / 3, max_df=.95)
    assert rows(out, "w") == [("big", 2), ("new", 2), ("york", 2)]


def test_tfidf_by_hand(spark):
    counts = T.term_counts(docs(spark).select("d", F.explode(F.split("t", " ")).alias("w")), "d", "w")
    got = {(r["d"], r["w"]): r["weight"] for r in T.tfidf(counts, "d", "w", F.lit(3.0), min_df=1, max_df=1.1).collect()}
    idf = lambda df: math.log(4 / (1 + df)) + 1
    raw = {"new": (1 + math.log(2)) * idf(2), "york": (1 + math.log(2)) * idf(2)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert math.isclose(got[2, "new"], raw["new"] / norm) and math.isclose(
        sum(v * v for (d, _), v in got.items() if d == 1), 1.0)


def test_stem_vocabulary(spark):
    df = spark.createDataFrame([("running",), ("runs",), ("Running",), ("new__york",), ("is",)], "w string")
    assert rows(T.stem_vocab(df, "w", stem), "w") == [("Running",), ("new__york",), ("run",)]


def test_long_stop_lists_come_as_tables(spark):
    df = spark.createDataFrame([("The",), ("cat",)], "w string")
    stop = spark.createDataFrame([("the",)], "s string")
    assert rows(T.drop_words(df, "w", stop)) == [("cat",)]


def test_merging_keeps_missing_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, None), (3, []), (4, ["a", None, "a", "b"])], "id int, t array<string>")
    got = {r.id: r.m for r in T.merge_bigrams(df, F.col("t"), [("a", "b")], "m").collect()}
    assert got == {1: ["a__b", "b"], 2: None, 3: [], 4: ["a", None, "a__b"]}


def test_merging_holds_few_tokens_at_a_time(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(T.F, "arrow_udf", lambda kind: lambda fn: seen.append(fn) or (lambda col: col))
    T.merge_bigrams(docs(spark).select(F.split("t", " ").alias("t")), F.col("t"), [("a", "b")], "m")
    batch = pa.array([["a", "b", f"word{i}"] * 100 for i in range(10_000)], pa.list_(pa.string()))
    merged, rows_out = seen[0](iter([batch])), 0
    tracemalloc.start()
    for part in merged:
        rows_out += len(part)
        assert part[0].as_py()[:2] == ["a__b", f"word{rows_out - len(part)}"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows_out == 10_000 and peak < 30e6


def test_the_stemmer_sees_each_word_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def shorter(words):
        seen.add(len(words))
        return words.str.rstrip("s")

    df = spark.range(600).select(F.element_at(F.array(*map(F.lit, ("rivers", "river", "Rivers"))), (F.col("id") % 3 + 1).cast("int")).alias("w"))
    assert rows(T.stem_vocab(df, "w", shorter), "w") == [("Rivers",), ("river",)]
    assert seen.value <= 6      # the filter on the length may ask again


def test_documents_may_be_named_by_two_columns_and_terms_by_numbers(spark):
    tokens = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (2, "a", "y"), (2, "a", "z")], "d long, p string, w string")
    counts = T.term_counts(tokens, ["d", "p"], "w")
    assert rows(counts, "d", "p", "w") == [(1, "a", "x", 2), (1, "b", "y", 1), (2, "a", "y", 1), (2, "a", "z", 1)]
    idf = spark.createDataFrame([("x", 1.0, 7), ("y", 3.0, 8), ("z", 4.0, 9)], "w string, idf double, i long")
    assert rows(T.tfidf_by(counts, ["d", "p"], "w", idf, "i"), "d", "p", "w") == [(1, "a", 7, 1.0), (1, "b", 8, 1.0), (2, "a", 8, .6), (2, "a", 9, .8)]
