import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import metrics as M, perceptron as P


def blobs(spark, n=300):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 3, n)
    x = rng.normal(size=(n, 4)) + 4 * np.eye(4)[y]
    pdf = pd.DataFrame({"id": range(n), "x": list(x), "y": [f"c{v}" for v in y]})
    return x, y, spark.createDataFrame(pdf, "id long, x array<double>, y string").repartition(4)


def test_epochs_equal_whole_table_updates(spark):
    x, y, df = blobs(spark)
    model = P.train_perceptron(df, "x", "y", epochs=7, rate=.5, decay=.8)
    w, b, rate = np.zeros((3, 4)), np.zeros(3), .5
    target = np.where(np.arange(3) == y[:, None], 1.0, -1.0)
    for t in range(7):
        z = x @ w.T + b
        wrong = (z.argmax(1) != y).sum()
        assert np.isclose(model.errors[t], wrong / len(y))
        mask = target - np.where(z >= 0, 1.0, -1.0)
        w, b, rate = w + rate * mask.T @ x / len(y), b + rate * mask.sum(0) / wrong, rate * .8
    assert model.classes == ("c0", "c1", "c2") and np.allclose(model.weights, w) and np.allclose(model.offsets, b)
    got = df.select("id", model.predict(F.col("x")).alias("p")).collect()
    assert {r.id: r.p for r in got} == {i: f"c{c}" for i, c in enumerate((x @ w.T + b).argmax(1))}
    assert model.errors[-1] < .1


def test_stops_when_all_rows_are_right_and_skips_missing_ones(spark):
    data = [([1.0, 0.0], 1), ([0.0, 1.0], 2), (None, 1), ([1.0, None], 2), ([5.0, 5.0], None)]
    model = P.train_perceptron(spark.createDataFrame(data, "x array<double>, y int"), "x", "y", epochs=50)
    assert model.errors[-1] == 0.0 and len(model.errors) < 50
    with pytest.raises(ValueError, match="length"):
        P.train_perceptron(spark.createDataFrame([([1.0], 1), ([1.0, 2.0], 2)], "x array<double>, y int"), "x", "y", epochs=1)
    with pytest.raises(ValueError, match="no row"):
        P.train_perceptron(spark.createDataFrame(data, "x array<double>, y int").where("false"), "x", "y", epochs=1)


@pytest.mark.parametrize("depth", [None, 3, 10])
def test_resampled_neighbour_errors(spark, depth):
    rng = np.random.default_rng(4)
    train, test = rng.normal(size=(40, 2)).round(1), rng.normal(size=(9, 2)).round(1)
    y, t = rng.integers(0, 5, 40).astype(float), rng.integers(0, 5, 9).astype(float)

    def table(x, labels, first):
        return spark.createDataFrame(pd.DataFrame({"id": range(first, first + len(x)), "v": list(x), "y": labels}), "id long, v array<double>, y double")
    got = {(r["size"], r["replicate"], r["k"]): r["mse"] for r in
           M.bootstrap_knn(table(train, y, 0), table(test, t, 100), "id", "v", "y", [1, 2, 6], [6, 15], times=4, seed=3, depth=depth).collect()}
    assert len(got) == 2 * 4 * 3
    for size in (6, 15):
        for rep in range(4):
            picks = [int(hashlib.md5(f"boot 3 {size} {rep} {i}".encode()).hexdigest()[:15], 16) % 40 for i in range(size)]
            for k in (1, 2, 6):
                errors = []
                for q, truth in zip(test, t):
                    near = sorted(picks, key=lambda p: (np.abs(train[p] - q).sum(), p))[:k]
                    errors.append((np.mean([y[p] for p in near]) - truth) ** 2)
                assert np.isclose(got[size, rep, k], np.mean(errors))
    assert len({got[6, r, 1] for r in range(4)}) > 1
    with pytest.raises(ValueError, match="largest k"):
        M.bootstrap_knn(table(train, y, 0), table(test, t, 100), "id", "v", "y", [7], [6], times=1)
