import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import clustering as K, metrics as M, models as L, regression as RG, scaling as S


def blobs(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    y = np.where(rng.random(n) < .6, 0, 1)
    x = rng.normal(size=(n, 2)) + y[:, None] * 1.5
    return pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "y": y})


def test_em_likelihood_never_falls(spark):
    rng = np.random.default_rng(2)
    data = [(d, t, int(rng.integers(1, 5))) for d in range(40) for t in rng.choice(30, 8, replace=False) + 30 * (d % 2)]
    counts = spark.createDataFrame([(d, int(t), n) for d, t, n in data], "d int, t int, n int")
    posterior, _, ll = K.em_multinomial(counts, "d", "t", "n", k=2, epochs=6)
    assert all(b >= a - 1e-6 for a, b in zip(ll, ll[1:]))
    assert all(abs(sum(r["gamma"]) - 1) < 1e-9 for r in posterior.collect())
    hard, _, _ = K.em_multinomial(counts, "d", "t", "n", k=2, epochs=3, mode="hard")
    assert {tuple(sorted(r["gamma"])) for r in hard.collect()} == {(0.0, 1.0)}


def test_kmeans_cost_never_rises(spark):
    pdf = blobs(spark)
    df = spark.createDataFrame(pd.DataFrame({"id": pdf["id"], "v": list(pdf[["a", "b"]].to_numpy())}), "id long, v array<double>")
    for metric in ("l1",):
        _, costs = K.kmeans(df, "id", "v", 3, metric, 8)
        assert costs[-1] < costs[0]
    centroids, _ = K.kmeans(df, "id", "v", 3, "l2", 50)
    again, _ = K.update_centroids(df, "v", centroids)
    assert np.allclose(centroids, again)
    reps = K.representatives(df, "id", "v", k=3)
    assert reps.agg(F.sum("n")).first()[0] == len(pdf) and reps.count() == 3


def test_centroids_when_tasks_have_no_rows(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "id long, v array<double>").repartition(12)
    start = np.array([[0.0, 1.0], [3.0, 1.0]])
    assert K.update_centroids(df, "v", start)[0].tolist() == [[.5, 1], [2.5, 1]]
    assert K.update_centroids(df.where("false"), "v", start)[0].tolist() == start.tolist()


def test_codeword_shares_sum_to_one(spark):
    df = spark.createDataFrame([("x", i, [float(i)]) for i in range(5)] + [("y", 9, [4.0])], "o string, id int, v array<double>")
    out = K.codeword_histogram(df, "o", "id", "v", np.array([[0.0], [4.0]]))
    assert rows(out, "o", "cluster") == [("x", 0, .6), ("x", 1, .4), ("y", 1, 1.0)]


def test_confusion_and_sweep_agree(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 300), "s": rng.random(300).round(2)})
    df = spark.createDataFrame(pdf)
    sweep = {round(r["threshold"], 2): r for r in M.threshold_sweep(df, "y", "s").collect()}
    assert len(sweep) == 51
    for t in (0.0, 0.34, 0.5, 1.0):
        one = M.confusion(df.withColumn("p", (F.col("s") >= t - 1e-9).cast("int")), "y", "p").first()
        assert [sweep[t][c] for c in ("tp", "fp", "fn", "tn", "f1")] == [one[c] for c in ("tp", "fp", "fn", "tn", "f1")]


def test_gaussian_curve_ends_at_the_full_fit(spark):
    pdf = blobs(spark)
    df = spark.createDataFrame(pdf)
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    full = L.gaussian_predict(test, L.gaussian_fit(train, ["a", "b"], "y"))
    error = full.agg(F.avg((F.col("pred") != F.col("y")).cast("double"))).first()[0]
    curve = {r["size"]: r["error"] for r in L.learning_curve(train, test, "id", ["a", "b"], "y", [5, 20, 100, 10000]).collect()}
    assert curve[10000] == error and error < .3


def test_ridge_matches_closed_form(spark):
    pdf = blobs(spark)
    df = spark.createDataFrame(pdf)
    x, y = pdf[["a", "b"]].to_numpy(), pdf["y"].to_numpy().astype(float)
    xc, yc = x - x.mean(0), y - y.mean()
    for r in L.ridge_sweep(df, df, ["a", "b"], "y", [0.0, 0.4, 5.0]).collect():
        w = np.linalg.solve(xc.T @ xc / len(y) + r["lambda"] * np.eye(2), xc.T @ yc / len(y))
        assert np.allclose(r["coefs"], w) and np.isclose(r["mse"], ((yc - xc @ w) ** 2).mean())


def test_split_covers_all_rows_once(spark):
    df = spark.range(1000)
    parts = {r["part"]: r["count"] for r in M.hash_split(df, "id").groupBy("part").count().collect()}
    assert sum(parts.values()) == 1000 and abs(parts["test"] - 300) < 60


@pytest.mark.parametrize("scale", [100, 2**50])
def test_split_scrambles_any_key(spark, scale):
    df = spark.range(1000).selectExpr(f"id * {scale} as id")
    assert abs(M.hash_split(df, "id").where("part = 'test'").count() - 300) < 60


def test_bootstrap_is_repeatable(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "id long, v double").repartition(3)
    a, b = (rows(M.bootstrap(df, "id", "v", 50, 8), "replicate") for _ in range(2))
    assert a == b and len(a) == 8 and all(n < 50 for _, _, n in a)


def test_bootstrap_draws_are_independent(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(42)], "id long, v double")
    distinct = [n for _, _, n in rows(M.bootstrap(df, "id", "v", 20, 50), "replicate")]
    assert len(set(distinct)) > 4 and abs(np.mean(distinct) - 42 * (1 - (41 / 42) ** 20)) < 1


def test_yeo_johnson_straightens_skew(spark):
    x = np.exp(np.random.default_rng(0).normal(size=500))
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    out = S.scale(df, {"x": "yeojohnson"}, ddof=0).toPandas()["x"]
    assert abs(out.mean()) < 1e-9 and abs(out.std(ddof=0) - 1) < 1e-9 and abs(out.skew()) < .3 < abs(pd.Series(x).skew())


def test_votes_and_scores(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (1, 1, 1)], "a int, b int, c int")
    assert [r["vote"] for r in M.majority_vote(df, ["a", "b", "c"]).collect()] == [1, 0, 1]
    out = M.weighted_score(spark.createDataFrame([(2.0, 1), (4.0, 0)], "m double, z int"), {"m": 1.0, "z": -.5})
    assert [r["score"] for r in out.collect()] == [0.0, 1.0]


def test_backward_selection_and_significance(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=list("abc"))
    pdf["y"] = 2 * pdf["a"] - pdf["b"] + rng.normal(size=400)
    df = spark.createDataFrame(pdf)
    path = RG.backward_aic(df, ["a", "b", "c"], "y")
    assert set(path[-1][1].split(",")) >= {"a", "b"} and all(y[2] < x[2] for x, y in zip(path, path[1:]))
    x = np.c_[pdf[["a", "b", "c"]], np.ones(400)]
    rss = ((pdf["y"] - x @ np.linalg.lstsq(x, pdf["y"], rcond=None)[0]) ** 2).sum()
    assert np.isclose(path[0][2], 400 * (np.log(2 * np.pi * rss / 400) + 1) + 2 * 5, rtol=1e-6)
    assert {(f, s) for f, _, _, s in RG.significant_coefs(df, ["a", "b", "c"], "y")} >= {("a", "positive"), ("b", "negative")}


def test_classifiers_beat_chance(spark):
    df = L.with_vector(spark.createDataFrame(blobs(spark)), ["a", "b"]).withColumn("label", F.col("y").cast("double"))
    out = L.compare_classifiers(df.where("id % 3 > 0"), df.where("id % 3 = 0"), L.default_classifiers())
    assert out.count() == 4 and all(r["accuracy"] > .7 for r in out.collect())


def test_principal_axes(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 5)) @ np.diag([5, 3, 1, .5, .2]) @ np.linalg.qr(rng.normal(size=(5, 5)))[0] + 7
    df = spark.createDataFrame(pd.DataFrame({"id": range(200), "v": list(x)}), "id long, v array<double>").repartition(3)
    axes = K.principal_axes(df, "v", 2)
    want = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :2].T
    assert np.allclose(np.abs((axes * want).sum(axis=1)), 1, atol=1e-9)
    got = {r["id"]: r["xy"] for r in K.project(df, "id", "v").collect()}
    assert np.allclose([got[i] for i in range(200)], x @ axes.T)
    assert not K.principal_axes(df.where("false"), "v", 2).any()


def test_counts_stay_with_their_documents(spark, monkeypatch):
    """Only shares and sums per term are exchanged in a round, not the counts."""
    counts = spark.createDataFrame([(d, t, 1 + d * t % 3) for d in range(30) for t in range(d % 5, 12)], "d long, t long, n long")
    plans, cut = [], K.cut_lineage
    monkeypatch.setattr(K, "cut_lineage", lambda df: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or cut(df))
    posterior, _, _ = K.em_multinomial(counts, "d", "t", "n", k=2, epochs=2)
    rounds = [plan for columns, plan in plans if "gamma" in columns]
    assert len(rounds) == 2 and not any("hashpartitioning(doc" in plan for plan in rounds)
    assert posterior.count() == 30
