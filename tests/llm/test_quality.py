import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, none, odd
from tidemill.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_documents(spark):
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.QUERIES["op12_additive_quality"](spark, SF).collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    judged = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    assert len(judged) > 80 and sum(p == y for p, y in judged) >= 0.97 * len(judged)


def test_pairs_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.MEASURES)))
    y = ((x[:, 2] > .5) ^ (x[:, 5] > .5)).astype(float)     # no single measure says anything
    model = quality.fit_tables(x[:3000], y[:3000], np.ones(3000))
    assert (2, 5) in model.pairs
    assert ((model.score(x[3000:]) >= .5) == y[3000:]).mean() > .9


def test_score_is_the_sum_of_its_tables():
    rng = np.random.default_rng(2)
    x = rng.random((500, len(quality.MEASURES))).round(2)
    model = quality.fit_tables(x, (x[:, 0] + x[:, 1] * x[:, 2] > .8).astype(float), np.ones(500))
    for row, score in zip(x[:50], model.score(x[:50])):
        total = model.start
        for f, (edges, entries) in enumerate(zip(model.edges, model.tables)):
            total += entries[sum(e <= row[f] for e in edges)]
        for (a, b), entries in zip(model.pairs, model.pair_tables):
            total += entries[sum(e <= row[a] for e in model.pair_edges[a]), sum(e <= row[b] for e in model.pair_edges[b])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_a_tree_has_the_best_first_cut():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h, w = rng.normal(size=12), rng.random(12) + .1, np.full(12, 10.0)
        gains = [quality._gain(g[:i].sum(), h[:i].sum()) + quality._gain(g[i:].sum(), h[i:].sum()) for i in range(1, 12)]
        assert quality._cut(g, h, w)[1] == 1 + int(np.argmax(gains))
        leaves = quality._tree(g, h, w)
        assert 2 <= len(set(leaves)) <= 4


def measured(df):
    return df.select("doc_id", quality.measures(F.col("text")).alias("measures"))


def test_odd_rows(spark):
    df = measured(odd(spark))
    got = {}
    for r in df.collect():
        assert len(r.measures) == len(quality.MEASURES) and all(np.isfinite(r.measures))
        got.setdefault(r.doc_id, []).append(r.measures)
    assert sum(map(len, got.values())) == len(DOCS) and got[4][0] == got[5][0] == got[6][0] == [0.0] * len(quality.MEASURES)
    marked = df.withColumn("label", F.when(F.col("doc_id") < 4, 1).when(F.col("doc_id") < 8, 0))
    model = quality.fit(marked)
    scores = [r.s for r in df.select(quality.predict(F.col("measures"), model, spark).alias("s")).collect()]
    assert len(scores) == len(DOCS) and all(0 <= s <= 1 for s in scores)


def test_whole_texts_count(monkeypatch):
    text = "Some words, again and AGAIN! " * 50
    whole = quality.measure(text)
    monkeypatch.setattr(quality, "_CHUNK", 7)
    assert quality.measure(text) == whole


def test_nothing_or_one_label_to_learn(spark):
    df = measured(odd(spark))
    empty = quality.fit(df.withColumn("label", F.lit(None).cast("int")))
    assert {r.s for r in df.select(quality.predict(F.col("measures"), empty, spark).alias("s")).collect()} == {0.5}
    good = quality.fit(df.withColumn("label", F.lit(1)))
    assert all(r.s > .9 for r in df.select(quality.predict(F.col("measures"), good, spark).alias("s")).collect())
    assert measured(none(spark)).select(quality.predict(F.col("measures"), good, spark)).collect() == []


def test_sample_is_bounded_and_copies_weigh(spark, monkeypatch):
    seen, fit_tables = [], quality.fit_tables

    def watched(x, y, weight):
        seen.append((x, y, weight))
        return fit_tables(x, y, weight)
    monkeypatch.setattr(quality, "fit_tables", watched)
    rows = [(1, [float(i)] * 14) for i in range(300)] + [(0, [-1.0] * 14)] * 900 + [(0, [-2.0] * 14)] * 100
    quality.fit(spark.createDataFrame(rows, "label int, measures array<double>"), sample=40)
    x, y, weight = seen[0]
    assert (y == 1).sum() == 40 and (y == 0).sum() == 2
    assert np.isclose(weight[y == 1].sum() / weight[y == 0].sum(), 0.3) and np.isclose(weight[x[:, 0] == -1] / weight[x[:, 0] == -2], 9)
