import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHES, DOCS, none, odd
from tidemill.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def wanted(sizes, weights=(5, 2, 1), cap=3):
    """Targets by the rule: share by weight, stop at the cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, full, left, free = {}, set(), sum(sizes.values()), set(order)
    while True:
        target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = cap * sizes[s]
        full |= over
        free -= over
        left = sum(sizes.values()) - sum(target[s] for s in full)


def test_targets_and_copies_of_odd_rows(spark):
    got = mixing.mix(odd(spark)).collect()
    sizes = defaultdict(int)
    for _, text, _, source in DOCS:
        sizes[source] += words(text)
    target = wanted(sizes)
    assert sum(r.n for r in got) == len(DOCS)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.copies in (0, 1, 2, 3) and (r.size or not r.copies)


def test_words_taken_come_near_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, again = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect())) for n in (2, 5))
    assert first == again
    taken, target = defaultdict(int), {}
    for _, source, size, _, n, _, t, copies in first:
        taken[source] += size * n * copies
        target[source] = t
    assert sum(target.values()) == pytest.approx(sum(r[2] * r[4] for r in first))
    assert sorted(abs(taken[s] - target[s]) / target[s] for s in target)[-1] <= 0.03


def test_chunks_are_joined_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_CHUNK", 5)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
                                    F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"))
    got = mixing.mix(docs).collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.size * r.copies
    assert len(got) == 1000 and all(abs(taken[r.source] - r.target) <= 7 for r in got)


def test_expectation_is_kept(spark):
    """Of many equal documents, each is as likely as any other to be drawn."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"),
                                    F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    got = mixing.mix(docs, weights=(1, 1, 1)).filter("source = 'a'").collect()
    assert sum(r.copies for r in got) == 1500
    low = sum(r.copies for r in got if r.id < 1000)
    assert 650 < low < 850


def test_mixed_rows_keep_their_columns(spark):
    df = odd(spark)
    drawn = mixing.mixed_documents(df).collect()
    copies = {(r.id, r.source, r.h): r.copies * r.n for r in mixing.mix(df).collect()}
    assert len(drawn) == sum(copies.values()) and all(r[c] == f"own {c}" for r in drawn for c in CLASHES)


def test_empty_table(spark):
    assert mixing.mix(none(spark)).collect() == [] and mixing.mixed_documents(none(spark)).collect() == []


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r.copies, r.target) for r in mixing.mix(docs).collect()] == [(0, 0.0)] * 2


def test_ids_of_another_type(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.concat(F.lit("doc "), "doc_id").alias("doc_id"), "text", "source")
    units = mixing.mix(docs).collect()
    assert {r.id for r in units} == {r.doc_id for r in docs.collect()} and all(isinstance(r.id, str) for r in units)
    assert mixing.mixed_documents(docs).count() == sum(r.copies * r.n for r in units)
