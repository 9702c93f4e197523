import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import cleansing as C, joins as J, modify as M
from tidemill.plans import cleansing as P


def test_impute_leaves_no_sentinel(spark):
    df = spark.createDataFrame([("1", "a"), ("NA", "NA"), (None, "b"), ("4", None), ("2", "b"), ("2", "a")], "x string, c string")
    out = C.impute(df, ["x"], ["c"]).collect()
    assert sorted(r["x"] for r in out) == [1, 2, 2, 2.3, 2.3, 4] and sorted(r["c"] for r in out) == ["a"] * 4 + ["b"] * 2


def test_repairs_are_idempotent(spark, sf):
    steps = [P._fix_codes, P._fix_days, P._fix_places]
    once = C.repair(P._dirty_orders(spark, sf), steps)
    again = C.audit(once, C.repair(once, steps), ["o_orderkey"], ["branch_code", "day", "lat", "lon"])
    assert all(r["n_changed"] == 0 for r in again.collect())


def meals(spark):
    prices = spark.createDataFrame([("egg", 2.5), ("ham", 4.0), ("tea", 1.0), ("mint", 1.0)], "item string, price double")
    kind = "id int, items array<struct<item string, qty int>>, total double"
    df = spark.createDataFrame([
        (1, [("egg", 2), ("???", 3)], 17.0), (2, [("egg", 1), ("???", 2)], 4.5), (3, [("egg", 1), ("???", 1)], 99.0),
        (4, [("???", 1), ("!!!", 1)], 3.5), (5, [("egg", 1), ("ham", 1)], 6.5)], kind)
    return df, prices


def test_repair_items_by_price_gap(spark):
    df, prices = meals(spark)
    out = {r["id"]: [tuple(i) for i in r["items"]] for r in C.repair_items(df, ["id"], "items", "total", prices).collect()}
    assert out == {1: [("egg", 2), ("ham", 3)], 2: [("egg", 1), ("mint", 2)], 3: [("egg", 1), ("???", 1)],
                   4: [("???", 1), ("!!!", 1)], 5: [("egg", 1), ("ham", 1)]}


def test_recompute_total(spark):
    df, prices = meals(spark)
    out = {r["id"]: r["total"] and float(r["total"]) for r in C.recompute_total(df, ["id"], "items", prices).collect()}
    assert out == {1: None, 2: None, 3: None, 4: None, 5: 6.5}


def test_prices_of_unused_items_are_left_out(spark):
    data = [("a", 1, 0, 2.5), ("a", 3, 0, 7.5), ("b", 1, 2, 5.25), ("b", 2, 1, 4.5)]
    out = C.infer_unit_prices(spark.createDataFrame(data, "g string, x int, y int, t double"), "g", ["x", "y"], "t")
    assert rows(out, "g", "item") == [("a", "x", 2.5), ("b", "x", 1.25), ("b", "y", 2.0)]


def test_group_fit_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=list("abc"))
    pdf["g"] = np.where(rng.random(300) < .7, "hot", "cold")
    pdf["y"] = 3 * pdf["a"] - 2 * pdf["b"] + .5 * pdf["c"] + 7 + rng.normal(size=300)
    for r in C.group_linear_fit(spark.createDataFrame(pdf), ["g"], ["a", "b", "c"], "y").collect():
        part = pdf[pdf["g"] == r["g"]]
        want = np.linalg.lstsq(np.c_[part[["a", "b", "c"]], np.ones(len(part))], part["y"], rcond=None)[0]
        assert np.allclose([*r["coefs"], r["intercept"]], want)


def test_outliers_are_dropped_by_group(spark):
    data = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", float(v)) for v in [90, 100, 110]]
    out = C.drop_outliers(spark.createDataFrame(data, "g string, r double"), "r", ["g"], t=3)
    assert len(out.collect()) == 8 and out.where("g = 'a'").agg(F.max("r")).first()[0] == 5


def test_later_rules_see_earlier_repairs(spark):
    df = spark.createDataFrame([(None, None), (3, None), (None, 9)], "a int, b int")
    out = C.impute_by_rule(df, {"a": F.lit(1), "b": F.col("a") * 10})
    assert rows(out, "a", "b") == [(1, 9), (1, 10), (3, 30)]


def test_update_ignores_unknown_predicates(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    assert rows(M.update_rows(df, F.col("v") > 1, {"v": F.lit(0)}), "id") == [(1, 0), (2, None)]


def test_snapshot_diff_sees_inserts_and_deletes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(M.snapshot_diff(old, new, "k", ["v"]), "k") == [(1, "v", "a", None), (2, "v", "b", "c"), (3, "v", None, "d")]


def test_trailing_mean_needs_all_periods(spark):
    df = spark.createDataFrame([("a", y, y - 2000) for y in (2000, 2001, 2002, 2003, 2005)], "k string, y int, v int")
    out = {r["y"]: r["trailing_mean"] for r in J.trailing_mean(df, ["k"], "y", "v").collect()}
    assert out == {2000: None, 2001: None, 2002: None, 2003: 1.0, 2005: None}


def test_lookup_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string")
    mapping = spark.createDataFrame([("x", "B"), ("x", "A")], "k string, v string")
    assert rows(J.lookup(df, "k", mapping, "k", "v", "out", F.lit("?")).select("id", "out"), "id") == [(1, "A"), (2, "?")]


def test_names_match_by_the_strongest_form(spark):
    left = spark.createDataFrame([("St Mary's Coll",), ("O'Neil",), ("Hill View",), ("A & B",), ("None",)], "n string")
    right = spark.createDataFrame([("St Mary Coll",), ("ONeil",), ("HillView",), ("A &amp; B",), ("St Mary's College",)], "n string")
    out = {r["n"]: (r["match"], r["rule"]) for r in J.reconcile_names(left, right, "n", {"Coll": "College"}).collect()}
    assert out == {"St Mary's Coll": ("St Mary Coll", 1), "O'Neil": ("ONeil", 2), "Hill View": ("HillView", 3),
                   "A & B": ("A &amp; B", 0), "None": (None, None)}


def test_fits_use_complete_rows_only(spark):
    data = [("a", float(i), float(i)) for i in range(10)] + [("a", 50.0, None), ("a", None, 7.0), (None, 1.0, 5.0), (None, 2.0, 7.0)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    fit = {r["g"]: r for r in C.group_linear_fit(df, ["g"], ["x"], "y").collect()}
    assert np.isclose(fit["a"]["coefs"][0], 1) and np.isclose(fit["a"]["intercept"], 0) and fit["a"]["n"] == 10
    scored = C.predict_linear(df.unionByName(spark.createDataFrame([("new", 1.0, 1.0)], df.schema)), C.group_linear_fit(df, ["g"], ["x"], "y"), ["g"], ["x"])
    got = sorted((str(r["g"]), str(r["x"]), r["pred"] if r["pred"] is None else round(r["pred"], 6)) for r in scored.collect())
    assert len(got) == 15 and ("None", "2.0", 7.0) in got and ("new", "1.0", None) in got and ("a", "None", None) in got


def test_missing_residuals_are_no_outliers(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(20)] + [("g", 999.0), ("g", None), (None, 1.0)], "k string, r double")
    flags = {(r["k"], r["r"]): r["is_outlier"] for r in C.mark_outliers(df, "r", ["k"]).collect()}
    assert flags[("g", 999.0)] == 1 and flags[("g", None)] is None and flags[(None, 1.0)] == 0
    assert C.drop_outliers(df, "r", ["k"]).count() == 22


def test_audit_counts_rows_of_one_version(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (3, None), (None, "d")], "k long, v string")
    assert rows(C.audit(old, new, ["k"], ["v"])) == [("v", 3)]


def test_prefix_wins_over_a_known_code(spark):
    df = spark.createDataFrame([("ORDA1", "TP"), ("ORDB1", "tp"), ("ZZZZ1", "bk"), ("ZZZZ2", "??"), ("ORDC1", None)], "id string, c string")
    assert [c for _, c in rows(C.repair_code(df, "id", "c", P.BRANCH_PREFIX), "id")] == ["NK", "TP", "BK", "BK", None]


def test_dates_that_are_none(spark):
    from tidemill.functions.dates import repair_date
    df = spark.createDataFrame([("31-12-2020",), ("2020-31-12",), ("2020-12-31",), ("2020/12/31",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(repair_date(F.col("d"))).collect()] == ["2020-12-31"] * 3 + ["2020/12/31", "", None]


def test_snapshot_lists_empty_rows_that_come_and_go(spark):
    old = spark.createDataFrame([(1, None), (2, None)], "k long, v string")
    new = spark.createDataFrame([(2, None), (3, None)], "k long, v string")
    assert rows(M.snapshot_diff(old, new, "k", ["v"]), "k") == [(1, "v", None, None), (3, "v", None, None)]


def test_group_median_keeps_all_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 5.0), ("a", None)], "k string, v double")
    got = sorted((str(r["k"]), str(r["v"]), r["above_median"]) for r in J.above_group_median(df, ["k"], "v").collect())
    assert got == [("None", "2.0", 0), ("None", "5.0", 1), ("a", "1.0", 0), ("a", "3.0", 1), ("a", "None", 0)]


def test_bins_below_and_missing(spark):
    from tidemill.operators import aggregates as A
    df = spark.createDataFrame([(-5.0,), (3.0,), (None,), (500.0,)], "v double")
    assert {r["bin"]: r["n"] for r in A.histogram(df, "v", bins=3).collect()} == {-1: 1, 0: 1, 1: 0, 2: 1, None: 1}
    assert {r["band"]: r["n"] for r in A.band_counts(df, "v", [0, 100]).collect()} == {-1: 1, 0: 1, 1: 1, None: 1}
