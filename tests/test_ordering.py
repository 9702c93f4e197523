"""Positions, quantiles and rolling windows against plain computations, with hot groups and repeated values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import aggregates as A, ordering as O, textmine as T


def skewed(spark, n=3000, seed=3):
    """A third of all rows in one group, and a third of the values equal."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "k": np.where(rng.random(n) < .34, "hot", rng.integers(0, 9, n).astype(str)),
                        "v": np.where(rng.random(n) < .34, 7.0, rng.normal(size=n).round(3))})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_global_index_is_dense(spark):
    pdf, df = skewed(spark)
    out = O.global_index(df, ["v", "id"]).orderBy("idx").toPandas()
    want = pdf.sort_values(["v", "id"])["id"].to_numpy()
    assert (out["idx"].to_numpy() == np.arange(len(pdf))).all() and (out["id"].to_numpy() == want).all()


def test_global_index_of_nothing(spark):
    _, df = skewed(spark)
    assert O.global_index(df.where("false"), ["id"]).count() == 0


both_plans = pytest.mark.parametrize("group_rows", [O.GROUP_ROWS, 5])


@both_plans
def test_index_within_groups(spark, group_rows):
    pdf, df = skewed(spark)
    out = O.index_within(df, ["k"], ["v", "id"], group_rows=group_rows).toPandas().set_index("id")["pos"]
    want = pdf.sort_values(["k", "v", "id"]).groupby("k").cumcount()
    want.index = pdf.sort_values(["k", "v", "id"])["id"]
    assert (out.sort_index() == want.sort_index()).all()


@both_plans
def test_quantiles_match_numpy(spark, group_rows):
    pdf, df = skewed(spark)
    qs = [0, .1, .25, .5, .9, 1]
    for r in O.quantiles(df, "v", qs, ["k"], group_rows=group_rows).collect():
        want = np.quantile(pdf.loc[pdf["k"] == r["k"], "v"], qs)
        assert np.allclose([r[f"p{i}"] for i in range(len(qs))], want)
    assert np.allclose(list(O.quantiles(df, "v", qs).first()), np.quantile(pdf["v"], qs))


@both_plans
def test_weighted_quantiles(spark, group_rows):
    pdf, df = skewed(spark)
    counts = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    for r in O.quantiles(counts, "v", [.25, .5], ["k"], weight="n", group_rows=group_rows).collect():
        assert np.allclose([r["p0"], r["p1"]], np.quantile(pdf.loc[pdf["k"] == r["k"], "v"], [.25, .5]))


@pytest.mark.parametrize("group_rows", [O.GROUP_ROWS, 1])
def test_quantiles_keep_null_groups_and_skip_null_values(spark, group_rows):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0)], "k string, v double")
    assert rows(O.medians(df, "v", ["k"], group_rows=group_rows), "k") == [(None, 2.0), ("a", 5.0)]


@both_plans
def test_rolling_mean_over_block_borders(spark, group_rows):
    pdf, df = skewed(spark)
    out = O.rolling_mean(df, ["k"], ["id"], "v", 7, block=10, group_rows=group_rows).toPandas().set_index("id")["rolling_mean"].sort_index()
    want = pdf.sort_values("id").groupby("k")["v"].transform(lambda s: s.rolling(7, center=True, min_periods=1).mean())
    assert len(out) == len(pdf) and np.allclose(out, want)


def test_last_and_first_per_key(spark):
    pdf, df = skewed(spark)
    got = {r["k"]: r["id"] for r in O.last_per_key(df, ["k"], ["v", "id"]).collect()}
    assert got == pdf.sort_values(["v", "id"]).groupby("k")["id"].last().to_dict()
    got = {r["k"]: r["id"] for r in O.first_per_key(df, ["k"], ["v", "id"]).collect()}
    assert got == pdf.sort_values(["v", "id"]).groupby("k")["id"].first().to_dict()


def test_mode_prefers_smallest_and_skips_sentinel(spark):
    df = spark.createDataFrame([("NA",)] * 5 + [("b",)] * 2 + [("a",)] * 2 + [(None,)] * 9, "v string")
    assert rows(A.mode_value(df, "v", ignore="NA")) == [("a", 2)]


def test_surrogate_keys_step(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "id long").repartition(4)
    assert rows(O.surrogate_keys(df, ["id"], "key"), "id") == [(i, 200000 + 10 * i) for i in range(20)]


def test_concat_splits_big_owners_without_loss(spark):
    data = [(1, i, f"w{i}") for i in range(25)] + [(2, 0, "x"), (2, 1, "y")]
    df = spark.createDataFrame(data, "o long, t long, s string").repartition(3)
    out = rows(T.concat_by(df, "o", "t", "s", rows_per_part=10), "o", "part")
    assert [(o, p) for o, p, _ in out] == [(1, 0), (1, 1_000_000), (1, 2_000_000), (2, 0)]
    assert " ".join(s for o, _, s in out if o == 1) == " ".join(f"w{i}" for i in range(25)) and out[-1][2] == "x y"


def test_describe_against_pandas(spark):
    pdf, df = skewed(spark)
    row = A.describe_numeric(df, ["v"]).first()
    d = pdf["v"].describe()
    assert np.allclose([row["n"], row["mean"], row["std"], row["minimum"], row["q1"], row["median"], row["q3"], row["maximum"]], d)
    assert (row["top"], row["n_distinct"]) == (7.0, pdf["v"].nunique())


def test_zipf_rank_by_corpus(spark):
    df = spark.createDataFrame([("a", w) for w in "xxyyz"] + [("b", w) for w in "zzx"], "c string, w string")
    assert rows(A.zipf_rank(df, "w", ["c"]).select("c", "rank", "w", "n"), "c", "rank") == [
        ("a", 1, "x", 2), ("a", 2, "y", 2), ("a", 3, "z", 1), ("b", 1, "z", 2), ("b", 2, "x", 1)]


def test_top_per_key_keeps_ties_apart(spark):
    df = spark.createDataFrame([("a", i, 1) for i in range(5)], "k string, id int, n int")
    out = O.top_per_key(df, ["k"], [F.desc("n"), F.asc("id")], 2)
    assert sorted(r["id"] for r in out.collect()) == [0, 1]


def test_concat_cuts_by_characters(spark):
    data = [(1, i, "abcd") for i in range(7)] + [(2, 0, None), (2, 1, "z" * 50), (2, 2, "y")]
    df = spark.createDataFrame(data, "o long, t long, s string").repartition(3)
    out = rows(T.concat_by(df, "o", "t", "s", chars_per_part=10), "o", "part")
    assert out == [(1, 0, "abcd abcd"), (1, 1, "abcd abcd"), (1, 2, "abcd abcd"), (1, 3, "abcd"), (2, 0, "z" * 50), (2, 5, "y")]


def test_sample_takes_any_key(spark):
    df = spark.createDataFrame([(2**62 + i,) for i in range(500)], "k long")
    few = rows(O.sample_rows(df, "k", 20), "k")
    assert len(set(few)) == 20 and few == rows(O.sample_rows(df.repartition(3), "k", 20), "k") != rows(O.sample_rows(df, "k", 20, seed=2), "k")


def test_many_columns_correlate_like_few(spark, monkeypatch):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(200, 4)), columns=list("abcd"))
    df = spark.createDataFrame(pdf).withColumn("b", F.expr("if(a > 0.5, null, b)"))
    few = rows(A.correlation_matrix(df, list("abcd")), "a", "b")
    monkeypatch.setattr(A, "PAIRS_PER_PASS", 2)
    assert rows(A.correlation_matrix(df, list("abcd")), "a", "b") == few
    pdf.loc[pdf["a"] > 0.5, "b"] = None
    assert all(abs(pdf[a].corr(pdf[b]) - c) < 1e-5 for a, b, c in few)


def test_rows_of_a_hot_group_are_not_moved_again(spark, capsys):
    """Next to the few shares of a range, the ranges themselves stay where they are."""
    df = spark.range(20_000).selectExpr("id % 3 as g", "id", "xxhash64(id) as x")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)
    try:
        out = O.index_within(df, ["g"], ["x"], "pos", group_rows=10)
        out.explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        assert out.groupBy("g").agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).orderBy("g").collect() == [
            (0, 6667, 0, 6666), (1, 6667, 0, 6666), (2, 6666, 0, 6665)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
