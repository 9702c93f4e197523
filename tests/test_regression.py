import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import models as L, regression as RG

FEATURES = list("abcdef")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(600, 6)) * [1, 10, .1, 5, 1, 2] + [0, 3, 1, -2, 0, 9], columns=FEATURES)
    pdf["y"] = 2 * pdf["a"] - .3 * pdf["b"] + 4 * pdf["c"] + rng.normal(size=600)
    pdf["id"] = range(600)
    pdf["part"] = np.where(pdf["id"] % 3 == 0, "test", "train")
    return pdf, spark.createDataFrame(pdf).repartition(3)


def residuals(pdf, cols):
    x = np.c_[pdf[list(cols)], np.ones(len(pdf))]
    w = np.linalg.lstsq(x, pdf["y"], rcond=None)[0]
    return pdf["y"] - x @ w


def test_sweep_inverts_and_comes_back():
    x = np.random.default_rng(1).normal(size=(30, 4))
    a = x.T @ x
    b = a
    for k in range(4):
        b = RG.sweep(b, k)
    assert np.allclose(b, -np.linalg.inv(a))
    for k in (2, 0, 3, 1):
        b = RG.unsweep(b, k)
    assert np.allclose(a, b)


def test_backward_selection_is_that_of_all_refits(table):
    pdf, df = table

    def aic(cols):
        return 600 * (np.log(2 * np.pi * (residuals(pdf, cols) ** 2).mean()) + 1) + 2 * (len(cols) + 2)
    kept, want = FEATURES, [(0, ",".join(FEATURES), aic(FEATURES))]
    while len(kept) > 1:
        best = min((aic(c), c) for c in itertools.combinations(kept, len(kept) - 1))
        if best[0] >= want[-1][2]:
            break
        kept = best[1]
        want.append((len(want), ",".join(kept), best[0]))
    got = RG.backward_aic(df, FEATURES, "y")
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])
    assert len(got) > 2


def test_student_p_values():
    # fixed values: critical points of the Student distribution
    for t, dof, p in [(12.706205, 1, .05), (2.228139, 10, .05), (3.169273, 10, .01), (1.959966, 10**6, .05), (0.0, 5, 1.0), (-2.228139, 10, .05)]:
        assert abs(RG.two_sided_p(t, dof) - p) < 2e-6
    assert RG.two_sided_p(60, 1000) < 1e-20


def test_combined_and_missing_features(table):
    pdf, df = table
    with pytest.raises(ValueError, match="combination"):
        RG.backward_aic(df.withColumn("g", F.col("a") - 2 * F.col("b")), [*FEATURES, "g"], "y")
    with pytest.raises(ValueError, match="no row"):
        RG.backward_aic(df.withColumn("a", F.lit(None).cast("double")), FEATURES, "y")
    holes = df.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    got = RG.backward_aic(holes, FEATURES, "y")
    rss = (residuals(pdf[pdf["id"] % 5 > 0], FEATURES) ** 2).mean()
    assert np.isclose(got[0][2], 480 * (np.log(2 * np.pi * rss) + 1) + 16)


def test_elastic_net_meets_its_conditions(table):
    pdf, df = table
    train, test = pdf[pdf["part"] == "train"], pdf[pdf["part"] == "test"]
    x, y = train[FEATURES].to_numpy(), train["y"].to_numpy()
    sd, centre = x.std(0), x.mean(0)
    z = (x - centre) / sd
    seen = {}
    for lam, alpha, train_mse, test_mse, nonzero in RG.elastic_net_path(df, "part", FEATURES, "y", [0.0, .01, .3, 50.0], [0.0, .5, 1.0]):
        w = RG._descend(np.corrcoef(x.T), z.T @ (y - y.mean()) / len(y), np.zeros(6), lam * alpha, lam * (1 - alpha), 10_000, 1e-14)
        slope = z.T @ (y - y.mean() - z @ w) / len(y) - lam * (1 - alpha) * w
        assert np.all(np.abs(slope[w != 0] - lam * alpha * np.sign(w[w != 0])) < 1e-9) and np.all(np.abs(slope[w == 0]) <= lam * alpha + 1e-9)
        assert nonzero == np.count_nonzero(w) and np.isclose(train_mse, ((y - y.mean() - z @ w) ** 2).mean())
        assert np.isclose(test_mse, ((test["y"] - y.mean() - (test[FEATURES].to_numpy() - centre) / sd @ w) ** 2).mean())
        seen[lam, alpha] = train_mse, nonzero
    assert seen[50.0, 1.0][1] == 0 and seen[.3, 1.0][1] < 6 and np.isclose(seen[0.0, 0.0][0], (residuals(train, FEATURES) ** 2).mean())


def test_training_error_of_ridge(table):
    pdf, df = table
    train, test = df.where("part = 'train'"), df.where("part = 'test'")
    first, last = L.ridge_sweep(train, test, FEATURES, "y", [0.0, 10.0]).collect()
    assert np.isclose(first["train_mse"], (residuals(pdf[pdf["part"] == "train"], FEATURES) ** 2).mean()) and first["train_mse"] < last["train_mse"]


def test_learning_curves_equal_separate_fits(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(500) < .4).astype(int)
    pdf = pd.DataFrame({"id": rng.permutation(500), "a": rng.normal(size=500) + 1.5 * y, "b": rng.normal(size=500) - y, "y": y})
    pdf.loc[pdf["id"] < 3, "y"] = 1             # the first size sees one class
    df = spark.createDataFrame(pdf).repartition(3)
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    tr, te = pdf[pdf["id"] % 4 != 0].sort_values("id"), pdf[pdf["id"] % 4 == 0]
    sizes = [2, 20, 90, 10_000]
    got = {r["size"]: r for r in L.learning_curves(train, test, "id", ["a", "b"], "y", sizes).collect()}
    assert sorted(got) == sizes
    for size in sizes:
        x, t = np.c_[np.ones(len(tr)), tr[["a", "b"]]][:size], tr["y"].to_numpy()[:size]
        w = np.zeros(3)
        for _ in range(6):
            p = 1 / (1 + np.exp(-x @ w))
            w += np.linalg.lstsq((x * (p * (1 - p))[:, None]).T @ x + np.diag([0, 1, 1]), x.T @ (t - p) - [0, w[1], w[2]], rcond=None)[0]
        assert np.isclose(got[size]["logistic_train"], np.mean((x @ w > 0) != t))
        assert np.isclose(got[size]["logistic_test"], np.mean((np.c_[np.ones(len(te)), te[["a", "b"]]] @ w > 0) != te["y"]))
        first = train.orderBy("id").limit(size)
        model = L.gaussian_fit(first, ["a", "b"], "y")
        for part, rows in (("train", first), ("test", test)):
            wrong = rows.withColumn("p", model.predict()).agg(F.avg((F.col("p") != F.col("y")).cast("double"))).first()[0]
            assert np.isclose(got[size][f"gaussian_{part}"], wrong)
    assert got[2]["gaussian_train"] == got[2]["logistic_train"] == 0.0
    with pytest.raises(ValueError, match="two classes"):
        L.learning_curves(train.withColumn("y", F.col("id") % 3), test, "id", ["a", "b"], "y", sizes)
