"""Nearest-neighbour plans against brute force, and the spatial joins."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import metrics as M, neighbors as NN, spatial as S

PLANS = {"small_rows": {}, "small_queries": {"small_side": 1600}, "cells": {"small_side": 8, "block": 40, "pivots": 6}}


def vectors(spark, n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    m = rng.integers(-200, 200, size=(n, dim)) / 64        # exact in binary, so equal distances are equal
    m[:copies] = m[0]
    pdf = pd.DataFrame({"id": np.arange(n) * 3, "v": list(m)})
    return m, pdf["id"].to_numpy(), spark.createDataFrame(pdf, "id long, v array<double>").repartition(3)


def brute(qm, qid, rm, rid, k, metric, exclude):
    diff = qm[:, None, :] - rm[None, :, :]
    d = np.abs(diff).sum(2) if metric == "l1" else np.sqrt((diff ** 2).sum(2))
    out = {}
    for i, q in enumerate(qid):
        order = sorted((d[i, j], rid[j]) for j in range(len(rid)) if not (exclude and rid[j] == q))
        out[q] = [r for _, r in order[:k]]
    return out


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_plans_agree_with_brute_force(spark, plan, metric):
    qm, qid, q = vectors(spark, 60, 4, 1)
    rm, rid, r = vectors(spark, 900, 4, 2, copies=300)     # a third of the rows are one point
    if plan == "small_queries":
        q, qm, qid = q.where("id < 30"), qm[:10], qid[:10]
    out = NN.knn_join(q, r, 5, metric, **PLANS[plan]).toPandas().sort_values(["qid", "rank"])
    got = {k: list(g) for k, g in out.groupby("qid")["rid"]}
    assert got == brute(qm, qid, rm, rid, 5, metric, False)


@pytest.mark.parametrize("plan", ["small_rows", "cells"])
def test_leave_one_out(spark, plan):
    m, ids, df = vectors(spark, 200, 3, 5, copies=60)
    out = NN.knn_join(df, df, 4, "l2", exclude_self=True, **PLANS[plan]).toPandas().sort_values(["qid", "rank"])
    assert {k: list(g) for k, g in out.groupby("qid")["rid"]} == brute(m, ids, m, ids, 4, "l2", True)


def test_fewer_rows_than_k(spark):
    _, _, q = vectors(spark, 5, 2, 1)
    _, _, r = vectors(spark, 3, 2, 2)
    assert NN.knn_join(q, r, 10).count() == 15
    assert NN.knn_join(q, r, 10, small_side=1, pivots=2).count() == 15


def test_folds_cover_the_tail(spark):
    m, ids, df = vectors(spark, 23, 2, 4)
    df = df.withColumn("y", F.col("id") % 5)
    out = {r["k"]: r["n"] for r in NN.knn_cv(df, "id", "v", "y", [1, 3], folds=5).collect()}
    assert out == {1: 23, 3: 23}


def test_vote_breaks_ties_by_label(spark):
    found = spark.createDataFrame([(1, 10, .1, 1), (1, 11, .2, 2), (1, 12, .3, 3)], "qid long, rid long, dist double, rank int")
    labels = spark.createDataFrame([(10, "b"), (11, "a"), (12, "b")], "id long, y string")
    out = {r["k"]: r["pred"] for r in NN.knn_predictions(found, labels, "id", "y", [1, 2, 3], "mode").collect()}
    assert out == {1: "b", 2: "a", 3: "b"}


@pytest.mark.parametrize("plan", [{}, {"small_side": 6, "block": 30, "pivots": 5}])
def test_nearest_join_matches_haversine(spark, plan):
    rng = np.random.default_rng(0)
    lon, lat = rng.uniform(-180, 180, 200).round(2), rng.uniform(-90, 90, 200).round(2)
    left = spark.createDataFrame(pd.DataFrame({"i": range(120), "x": lon[:120], "y": lat[:120]})).union(
        spark.createDataFrame([(500, None, 1.0)], "i long, x double, y double"))
    right = spark.createDataFrame(pd.DataFrame({"j": range(80), "rx": lon[120:], "ry": lat[120:]}))
    out = {r["i"]: (r["nearest"], r["nearest_m"]) for r in
           S.nearest_join(left, right, ("x", "y"), ("rx", "ry"), "j", **plan).collect()}
    la, lo = np.radians(lat), np.radians(lon)
    h = np.sin((la[:120, None] - la[None, 120:]) / 2) ** 2 + np.cos(la[:120, None]) * np.cos(la[None, 120:]) * np.sin(
        (lo[:120, None] - lo[None, 120:]) / 2) ** 2
    d = 2 * 6378000 * np.arcsin(np.sqrt(h))
    assert out.pop(500) == (None, None) and len(out) == 120
    assert all(out[i][0] == d[i].argmin() and abs(out[i][1] - d[i].min()) < 1e-3 for i in out)


def test_point_in_polygon(spark):
    ring = lambda pts: [{"lon": float(a), "lat": float(b)} for a, b in pts]
    shapes = spark.createDataFrame([
        (1, "big", ring([(0, 0), (10, 0), (10, 10), (0, 10)])), (2, "dent", ring([(20, 0), (30, 0), (25, 5), (30, 10), (20, 10)])),
        (3, "late", ring([(5, 5), (15, 5), (15, 15), (5, 15)]))], "id int, name string, ring array<struct<lon double, lat double>>")
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(
        [(1, 1), (7, 7), (12, 12), (29, 5), (22, 5), (50, 50), (7, 7)])], "i int, x double, y double")
    out = S.point_in_polygon(pts, shapes, ("x", "y"), "id", "ring", "name")
    got = [r["area"] for r in out.orderBy("i").collect()]
    assert got == ["big", "big", "late", "not available", "dent", "not available", "big"]


def test_no_rows_to_search(spark):
    some = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    for q, r in ((some, some.where("false")), (some.where("false"), some)):
        out = NN.knn_join(q, r, 3)
        assert out.columns == ["qid", "rid", "dist", "rank"] and out.collect() == []


@pytest.mark.parametrize("far", [1, 1e9, np.nan])
def test_grid_gives_the_exact_order(far):
    """Sums on the grid only rule rows out; copies, an outlier or a missing number change nothing."""
    rng = np.random.default_rng(3)
    q, r = rng.normal(size=(50, 16)), rng.normal(size=(3000, 16))
    r[100:200], r[5, 3], q[:5] = r[7], far, r[:5]
    with np.errstate(invalid="ignore"):
        found = NN._nearest(np.arange(50), q, np.arange(3000), r, 7, "l1", True).reset_index(drop=True)
    d = np.zeros((50, 3000))
    for j in range(16):
        d += np.abs(q[:, j, None] - r[None, :, j])
    d[np.arange(50), np.arange(50)] = np.inf
    want = np.array([np.lexsort((np.arange(3000), np.nan_to_num(x, nan=np.inf)))[:7] for x in d])
    assert (found["rid"].to_numpy().reshape(50, 7) == want).all()
    assert (found["dist"].to_numpy() == d[found["qid"], found["rid"]]).all()


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_memory_of_a_search_is_bounded(metric):
    rng = np.random.default_rng(4)
    q, r = rng.normal(size=(500, 4)), rng.normal(size=(60_000, 4))
    tracemalloc.start()
    NN._nearest(np.arange(500), q, np.arange(60_000), r, 5, metric, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


def test_resampled_predictions_are_not_broadcast(spark, capsys):
    """The predictions outnumber the test rows by sizes, samples and k, whatever Spark takes their compressed size for."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame(pd.DataFrame({"id": range(80), "v": list(rng.normal(size=(80, 2))), "y": rng.normal(size=80)}),
                               "id long, v array<double>, y double")
    out = M.bootstrap_knn(df.where("id < 50"), df.where("id >= 50"), "id", "v", "y", [1, 3], [5, 9], times=2)
    out.explain()
    assert "SortMergeJoin" in capsys.readouterr().out
    assert sorted((r["size"], r["replicate"], r["k"], r["n"]) for r in out.collect()) == [(s, r, k, 30) for s in (5, 9) for r in (0, 1) for k in (1, 3)]
