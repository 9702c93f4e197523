"""Statistics and machine learning over tables."""

from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions import numeric as N, text as X
from ..operators import clustering as K, metrics as M, models as L, neighbors as NN, perceptron as P, regression as RG, scaling as S, sparse as SP, textmine as T
from ..session import cut_lineage, drop_stage
from ..sources.tables import table
from .registry import query
from .textual import _COUNTS_SQL, doc_term_counts

def _split_sql(key):
    """The split's slot, from 0 to 99, of a key in SQL."""
    return f"('0x' || substr(md5('split ' || {key}), 1, 15))::BIGINT % 100"


_SPLIT = _split_sql("vec_id")
_L1 = "list_sum(list_transform(list_zip(a.e, b.e), lambda x: abs(x[1] - x[2])))"
_L2 = "sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"
_VEC = "SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings"


def _split(df, key):
    tagged = M.hash_split(df, key)
    return tagged.where("part = 'train'").drop("part"), tagged.where("part = 'test'").drop("part")


@query("hash_split", f"""
    SELECT o_orderkey, CASE WHEN {_split_sql('o_orderkey')} < 30 THEN 'test' ELSE 'train' END AS part FROM orders""")
def hash_split(spark, sf):
    return M.hash_split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "part")


# ---- neighbours ---------------------------------------------------------------------------------

_KNN_SQL = f"""
    v AS ({_VEC}), ranked AS (SELECT a.vec_id AS q, a.label AS truth, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_L1}, b.vec_id) AS rn
    FROM v a JOIN v b ON {_SPLIT.replace('vec_id', 'a.vec_id')} < 30 AND {_SPLIT.replace('vec_id', 'b.vec_id')} >= 30 QUALIFY rn <= 30)"""


def _neighbours(spark, sf, k):
    train, test = _split(table(spark, sf, "embeddings"), "vec_id")
    found = NN.knn_join(test.select("vec_id", "embedding"), train.select("vec_id", "embedding"), k, "l1")
    return train, test, found


@query("knn_regress", f"WITH {_KNN_SQL} SELECT q AS vec_id, round(avg(label), 6) AS pred FROM ranked WHERE rn <= 5 GROUP BY 1")
def knn_regress(spark, sf):
    train, _, found = _neighbours(spark, sf, 5)
    preds = NN.knn_predictions(found, train, "vec_id", "label", [5])
    return preds.select(F.col("qid").alias("vec_id"), F.round("pred", 6).alias("pred"))


@query("knn_classify", f"""WITH {_KNN_SQL} SELECT q AS vec_id, label AS pred FROM ranked WHERE rn <= 7 GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY q ORDER BY count(*) DESC, label) = 1""")
def knn_classify(spark, sf):
    train, _, found = _neighbours(spark, sf, 7)
    preds = NN.knn_predictions(found, train, "vec_id", "label", [7], vote="mode")
    return preds.select(F.col("qid").alias("vec_id"), "pred")


@query("knn_k_sweep", f"""WITH {_KNN_SQL}, p AS (SELECT q, truth, k, avg(label) AS pred FROM ranked JOIN (SELECT unnest(range(1, 31)) AS k) ON rn <= k GROUP BY 1, 2, 3)
    SELECT k, round(avg(pow(pred - truth, 2)), 6) AS mse, count(*) AS n FROM p GROUP BY 1""")
def knn_k_sweep(spark, sf):
    train, test, found = _neighbours(spark, sf, 30)
    preds = NN.knn_predictions(found, train, "vec_id", "label", list(range(1, 31)))
    both = preds.join(test.select(F.col("vec_id").alias("qid"), "label"), "qid")
    return both.groupBy("k").agg(F.round(F.avg(F.pow(F.col("pred") - F.col("label"), 2)), 6).alias("mse"), F.count("*").alias("n"))


@query("knn_vote_sweep", f"""WITH {_KNN_SQL}, votes AS (SELECT q, any_value(truth) AS truth, k, label, count(*) AS n FROM ranked JOIN (SELECT unnest(range(1, 31)) AS k) ON rn <= k GROUP BY q, k, label
    QUALIFY row_number() OVER (PARTITION BY q, k ORDER BY count(*) DESC, label) = 1)
    SELECT k, round(avg((label <> truth)::INT), 6) AS error, count(*) AS n FROM votes GROUP BY 1""")
def knn_vote_sweep(spark, sf):
    train, test, found = _neighbours(spark, sf, 30)
    preds = NN.knn_predictions(found, train, "vec_id", "label", list(range(1, 31)), vote="mode")
    both = preds.join(test.select(F.col("vec_id").alias("qid"), "label"), "qid")
    wrong = F.when(F.col("pred") == F.col("label"), 0.0).otherwise(1.0)
    return both.groupBy("k").agg(F.round(F.avg(wrong), 6).alias("error"), F.count("*").alias("n"))


def _cv_sql(excluded, extra=""):
    return f"""WITH v AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM ({_VEC})),
    r AS (SELECT a.vec_id AS q, a.label AS truth, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_L1}, b.vec_id) AS rn
          FROM v a JOIN v b ON {excluded} QUALIFY rn <= 15),
    p AS (SELECT q, truth, k, avg(label) AS pred FROM r JOIN (SELECT unnest(range(1, 16)) AS k) ON rn <= k GROUP BY 1, 2, 3)
    SELECT k, round(avg(pow(pred - truth, 2)), 6) AS mse, count(*) AS n FROM p GROUP BY 1"""


@query("loo_cv_knn", _cv_sql("a.vec_id <> b.vec_id"))
def loo_cv_knn(spark, sf):
    return NN.knn_cv(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", list(range(1, 16))) \
        .withColumn("mse", F.round("mse", 6))


@query("fold_cv_knn", _cv_sql("least(a.i // (a.n // 5), 4) <> least(b.i // (b.n // 5), 4)"))
def fold_cv_knn(spark, sf):
    return NN.knn_cv(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", list(range(1, 16)), folds=5) \
        .withColumn("mse", F.round("mse", 6))


# ---- resampling and metrics -------------------------------------------------------------------------

@query("bootstrap_mean", """
    WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, o_totalprice, count(*) OVER () AS n FROM orders),
    d AS (SELECT d // 2000 AS replicate, ('0x' || substr(md5('boot 1 ' || (d // 2000) || ' ' || (d % 2000)), 1, 15))::BIGINT AS s
          FROM (SELECT unnest(range(0, 40000)) AS d))
    SELECT replicate, round(avg(o_totalprice), 6) AS mean, count(DISTINCT i) AS n_distinct FROM d JOIN r ON i = s % n GROUP BY 1""")
def bootstrap_mean(spark, sf):
    out = M.bootstrap(table(spark, sf, "orders"), "o_orderkey", "o_totalprice", size=2000, times=20)
    # a mean of 2000 amounts in cents has at most six decimals, so rounding meets no half-way case
    return out.withColumn("mean", F.round("mean", 6))


@query("bootstrap_knn_error", f"""
    WITH v AS ({_VEC}), tr AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM v WHERE {_SPLIT} >= 30), te AS (SELECT * FROM v WHERE {_SPLIT} < 30),
    d AS (SELECT size, replicate, d, ('0x' || substr(md5('boot 1 ' || size || ' ' || replicate || ' ' || d), 1, 15))::BIGINT AS s
          FROM (SELECT unnest([20, 60]) AS size), (SELECT unnest(range(0, 10)) AS replicate), (SELECT unnest(range(0, 60)) AS d) WHERE d < size),
    near AS (SELECT a.vec_id AS q, a.label AS truth, b.vec_id AS r, b.label, b.i, {_L1} AS dist, n FROM te a, tr b),
    ranked AS (SELECT size, replicate, q, truth, label, row_number() OVER (PARTITION BY size, replicate, q ORDER BY dist, r) AS rn FROM d JOIN near ON near.i = d.s % near.n QUALIFY rn <= 15),
    p AS (SELECT size, replicate, k, q, truth, avg(label) AS pred FROM ranked JOIN (SELECT unnest(range(1, 16)) AS k) ON rn <= k GROUP BY ALL)
    SELECT size::BIGINT AS size, replicate, k, round(avg(pow(pred - truth, 2)), 6) AS mse, count(*) AS n FROM p GROUP BY ALL""")
def bootstrap_knn_error(spark, sf):
    train, test = _split(table(spark, sf, "embeddings"), "vec_id")
    out = M.bootstrap_knn(train, test, "vec_id", "embedding", "label", range(1, 16), [20, 60], times=10)
    return out.withColumn("mse", F.round("mse", 6))


_RULE = "CASE WHEN least(n_chars / 4000.0, 1) >= 0.35 THEN 1 ELSE 0 END"


@query("confusion_metrics", f"""
    WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND p = 1) AS tp, count(*) FILTER (WHERE quality <> 1 AND p = 1) AS fp,
                      count(*) FILTER (WHERE quality = 1 AND p = 0) AS fn, count(*) FILTER (WHERE quality <> 1 AND p = 0) AS tn
               FROM (SELECT quality, {_RULE} AS p FROM documents JOIN labels USING (doc_id)))
    SELECT *, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
           round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def confusion_metrics(spark, sf):
    scored = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn("p", F.when(
        F.least(F.col("n_chars") / 4000, F.lit(1.0)) >= 0.35, 1).otherwise(0))
    return M.confusion(scored, "quality", "p").withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query("threshold_sweep", """
    WITH s AS (SELECT quality, round(least(n_chars / 4000.0, 1), 4)::DOUBLE AS score FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT i, count(*) FILTER (WHERE quality = 1 AND score * 50 >= i - 1e-9) AS tp, count(*) FILTER (WHERE quality = 0 AND score * 50 >= i - 1e-9) AS fp,
                 count(*) FILTER (WHERE quality = 1 AND score * 50 < i - 1e-9) AS fn, count(*) FILTER (WHERE quality = 0 AND score * 50 < i - 1e-9) AS tn
          FROM s, (SELECT unnest(range(0, 51)) AS i) GROUP BY 1)
    SELECT round(i / 50.0, 2)::DOUBLE AS threshold, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def threshold_sweep(spark, sf):
    scored = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id") \
        .withColumn("score", F.round(F.least(F.col("n_chars") / 4000, F.lit(1.0)), 4))
    out = M.threshold_sweep(scored, "quality", "score")
    return out.withColumns({"threshold": F.round("threshold", 2), **{c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")}})


@query("regression_metrics", """
    SELECT round(avg(pow(y - p, 2)), 2) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
           round(1 - sum(pow(y - p, 2)) / (sum(y * y) - sum(y) * avg(y)), 6) AS r2
    FROM (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)""")
def regression_metrics(spark, sf):
    scored = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return M.regression_metrics(scored, "y", "p").select(
        F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query("two_stage_predict", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN greatest(o_totalprice - 200000, 0) ELSE 0.0 END AS pred FROM orders""")
def two_stage_predict(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", N.two_stage(
        F.col("o_orderstatus") != "F", F.col("o_totalprice") - 200000).alias("pred"))


@query("majority_vote", """
    SELECT event_id, CASE WHEN (value > 30)::INT + (user_id % 2)::INT + (hour(ts) < 12)::INT >= 2 THEN 1 ELSE 0 END AS vote FROM events""")
def majority_vote(spark, sf):
    votes = table(spark, sf, "events").select("event_id", (F.col("value") > 30).alias("a"), (F.col("user_id") % 2).alias("b"),
                                              (F.hour("ts") < 12).alias("c"))
    return M.majority_vote(votes, ["a", "b", "c"]).select("event_id", "vote")


@query("importance_score", """
    WITH m AS (SELECT doc_id, n_chars, len(string_split(text, ' ')) - 1 AS spaces, len(string_split(text, ',')) - 1 AS commas,
                      len(regexp_extract_all(text, '[0-9]')) AS digits FROM documents)
    SELECT doc_id, round(n_chars / max(n_chars) OVER () / 3 + spaces / max(spaces) OVER () / 3 + commas / max(commas) OVER () / 3
                         - coalesce(digits / nullif(max(digits) OVER (), 0), 0) / 2, 6) AS score FROM m""")
def importance_score(spark, sf):
    text = F.col("text")
    metrics = table(spark, sf, "documents").select(
        "doc_id", "n_chars", X.substring_count(text, " ").alias("spaces"), X.substring_count(text, ",").alias("commas"),
        F.regexp_count(text, F.lit("[0-9]")).alias("digits"))
    scored = M.weighted_score(metrics, {"n_chars": 1 / 3, "spaces": 1 / 3, "commas": 1 / 3, "digits": -1 / 2})
    return scored.select("doc_id", F.round("score", 6).alias("score"))


# ---- scalers ----------------------------------------------------------------------------------------

@query("scalers", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS l_quantity,
           round((l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice,
           CASE WHEN l_discount = 0 THEN 0.0 ELSE round(ln(l_discount), 6) END AS l_discount, round(sqrt(l_tax), 6) AS l_tax FROM lineitem""")
def scalers(spark, sf):
    cols = {"l_quantity": "standard", "l_extendedprice": "minmax", "l_discount": "log", "l_tax": "root"}
    out = S.scale(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *cols), cols)
    return out.withColumns({c: F.round(c, 6) for c in cols})


@query("yeo_johnson", """
    WITH g AS (SELECT unnest(range(-20, 21)) / 10.0::DOUBLE AS lam), x AS (SELECT event_id, value - 20 AS v FROM events),
    t AS (SELECT lam, event_id, v, CASE WHEN v >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + v) ELSE (pow(v + 1, lam) - 1) / lam END
              ELSE CASE WHEN lam = 2 THEN -ln(1 - v) ELSE -(pow(1 - v, 2 - lam) - 1) / (2 - lam) END END AS y FROM x, g),
    best AS (SELECT lam, avg(y) AS m, stddev_pop(y) AS sd FROM t GROUP BY 1
             ORDER BY -count(*) / 2 * ln(var_pop(y)) + (lam - 1) * sum(sign(v) * ln(1 + abs(v))) DESC LIMIT 1)
    SELECT event_id, round((y - m) / sd, 5) AS value FROM t JOIN best USING (lam)""")
def yeo_johnson(spark, sf):
    shifted = table(spark, sf, "events").select("event_id", (F.col("value") - 20).alias("value"))
    return S.scale(shifted, {"value": "yeojohnson"}, ddof=0).withColumn("value", F.round("value", 5))


# ---- linear and Gaussian models -----------------------------------------------------------------------

_RIDGE_SQL = f"""
    WITH x AS (SELECT l_quantity AS a, l_discount * 100 AS b, l_extendedprice / 1000 AS y, {_split_sql('l_orderkey')} < 30 AS test FROM lineitem),
    s AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, avg(a) AS ma, avg(b) AS mb, avg(y) AS my
          FROM x WHERE NOT test),
    w AS (SELECT lam, ((bb + lam) * ay - ab * by_) / ((aa + lam) * (bb + lam) - ab * ab) AS wa,
                 ((aa + lam) * by_ - ab * ay) / ((aa + lam) * (bb + lam) - ab * ab) AS wb, ma, mb, my
          FROM s, (SELECT unnest(range(0, 26)) * 0.4::DOUBLE AS lam)),
    sweep AS (SELECT round(lam, 1) AS lambda, round(avg(pow(y - (my + wa * (a - ma) + wb * (b - mb)), 2)) FILTER (WHERE NOT test), 5) AS train_mse,
              round(avg(pow(y - (my + wa * (a - ma) + wb * (b - mb)), 2)) FILTER (WHERE test), 5) AS mse FROM x, w GROUP BY 1)"""


def _ridge(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"),
                                                (F.col("l_extendedprice") / 1000).alias("y"))
    train, test = _split(lines, "l_orderkey")
    out = L.ridge_sweep(train, test, ["a", "b"], "y", [i * 0.4 for i in range(26)])
    return out.select(F.round("lambda", 1).alias("lambda"), F.round("train_mse", 5).alias("train_mse"), F.round("mse", 5).alias("mse"))


@query("ridge_sweep", f"{_RIDGE_SQL} SELECT \"lambda\", train_mse, mse FROM sweep".replace("AS lambda", 'AS "lambda"'))
def ridge_sweep(spark, sf):
    return _ridge(spark, sf)


@query("grid_best", f"{_RIDGE_SQL} SELECT \"lambda\", train_mse, mse FROM sweep ORDER BY mse, 1 LIMIT 1".replace("AS lambda", 'AS "lambda"'))
def grid_best(spark, sf):
    return M.grid_best(_ridge(spark, sf), "mse", "lambda")


_NET_SQL = f"""
    WITH RECURSIVE x AS (SELECT l_quantity AS a, l_discount AS b, l_tax AS c, l_extendedprice / 1000 AS y, {_split_sql('l_orderkey')} < 30 AS test FROM lineitem),
    s AS (SELECT stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(c) AS sc, corr(a, b) AS rab, corr(a, c) AS rac, corr(b, c) AS rbc, covar_pop(a, y) / stddev_pop(a) AS ca,
                 covar_pop(b, y) / stddev_pop(b) AS cb, covar_pop(c, y) / stddev_pop(c) AS cc, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my FROM x WHERE NOT test),
    d AS (SELECT lam, alpha, lam * alpha AS l1, 1 + lam * (1 - alpha) AS l2, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc, 0 AS i
          FROM (SELECT unnest([0.0, 0.05, 0.5, 2.0])::DOUBLE AS lam), (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS alpha)
          UNION ALL
          SELECT lam, alpha, l1, l2, na, nb, nc, i + 1 FROM (
              SELECT d.*, ca - rab * wb - rac * wc AS pa, sign(pa) * greatest(abs(pa) - l1, 0) / l2 AS na, cb - rab * na - rbc * wc AS pb,
                     sign(pb) * greatest(abs(pb) - l1, 0) / l2 AS nb, cc - rac * na - rbc * nb AS pc, sign(pc) * greatest(abs(pc) - l1, 0) / l2 AS nc FROM d, s WHERE i < 50)),
    e AS (SELECT lam, alpha, wa, wb, wc, test, y - (my + wa * (a - ma) / sa + wb * (b - mb) / sb + wc * (c - mc) / sc) AS r FROM d, s, x WHERE i = 50)
    SELECT lam AS regularization, alpha, round(avg(r * r) FILTER (WHERE NOT test), 5) AS train_mse, round(avg(r * r) FILTER (WHERE test), 5) AS test_mse,
           any_value((wa <> 0)::INT + (wb <> 0)::INT + (wc <> 0)::INT)::BIGINT AS nonzero FROM e GROUP BY 1, 2"""


@query("elastic_net_grid", _NET_SQL)
def elastic_net_grid(spark, sf):
    lines = M.hash_split(table(spark, sf, "lineitem").withColumn("price", F.col("l_extendedprice") / 1000), "l_orderkey")
    grid = RG.elastic_net_path(lines, "part", ["l_quantity", "l_discount", "l_tax"], "price", [0.0, 0.05, 0.5, 2.0], [0.0, 0.5, 1.0])
    out = spark.createDataFrame(grid, "regularization double, alpha double, train_mse double, test_mse double, nonzero long")
    return out.withColumns({c: F.round(c, 5) for c in ("train_mse", "test_mse")})


@query("log_target", f"""
    WITH x AS (SELECT l_quantity AS a, l_extendedprice AS y, {_split_sql('l_orderkey')} < 30 AS test FROM lineitem),
    g AS (SELECT unnest([1.0, 100.0, 10000.0])::DOUBLE AS bias),
    f AS (SELECT bias, regr_slope(ln(y + bias), a) AS w, regr_intercept(ln(y + bias), a) AS c FROM x, g WHERE NOT test GROUP BY 1)
    SELECT bias, round(sqrt(avg(pow(exp(c + w * a) - bias - y, 2))), 3) AS rmse, round(avg(abs(exp(c + w * a) - bias - y)), 3) AS mae
    FROM x, f WHERE test GROUP BY 1""")
def log_target(spark, sf):
    train, test = _split(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice"), "l_orderkey")
    out = L.log_target_sweep(train, test, ["l_quantity"], "l_extendedprice", [1.0, 100.0, 10000.0])
    return out.withColumns({"rmse": F.round("rmse", 3), "mae": F.round("mae", 3)})


_DOC_FEATURES = f"""
    x AS (SELECT doc_id, quality, ln(n_chars + 1) AS a, 100.0::DOUBLE * (len(string_split(text, ' ')) - 1) / (n_chars + 1) AS b,
                 {_split_sql('doc_id')} < 30 AS test FROM documents JOIN labels USING (doc_id))"""


def _gauss_sql(train, by):
    """Scores of the shared-covariance classifier with two features, per model (``by``)."""
    return f"""
    cls AS (SELECT {by}, quality, count(*)::DOUBLE AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS vab FROM {train} GROUP BY ALL),
    pool AS (SELECT {by}, sum(n) AS total, sum(n * va) / sum(n) AS va, sum(n * vb) / sum(n) AS vb, sum(n * vab) / sum(n) AS vab FROM cls GROUP BY ALL),
    model AS (SELECT cls.{by}, quality, (vb_ * ma - vab_ * mb) / det AS wa, (va_ * mb - vab_ * ma) / det AS wb, ma, mb, ln(n / total) AS prior
              FROM cls JOIN (SELECT {by}, total, va AS va_, vb AS vb_, vab AS vab_, va * vb - vab * vab AS det FROM pool) p USING ({by})),
    scored AS (SELECT model.{by}, x.doc_id, x.quality AS truth, model.quality AS pred, wa * a + wb * b - 0.5 * (wa * ma + wb * mb) + prior AS score
               FROM x, model WHERE x.test QUALIFY row_number() OVER (PARTITION BY model.{by}, doc_id ORDER BY score DESC, model.quality) = 1)"""


def _labelled_docs(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select("doc_id", "quality", F.log(F.col("n_chars") + 1).alias("a"),
                       (100.0 * X.substring_count(F.col("text"), " ") / (F.col("n_chars") + 1)).alias("b"))


@query("gaussian_classifier", f"""
    WITH {_DOC_FEATURES}, tr AS (SELECT 1 AS m, * FROM x WHERE NOT test), {_gauss_sql('tr', 'm')}
    SELECT doc_id, truth, pred FROM scored""")
def gaussian_classifier(spark, sf):
    train, test = _split(_labelled_docs(spark, sf), "doc_id")
    model = L.gaussian_fit(train, ["a", "b"], "quality")
    return L.gaussian_predict(test, model).select("doc_id", F.col("quality").alias("truth"), "pred")


_SIZES = [50, 100, 150, 200, 250, 1000000]


def _newton_sql(steps):
    """Logistic regression on two features, every Newton step written out; slopes are penalised by 1."""
    ctes = [f"n0 AS (SELECT unnest({_SIZES}) AS size, 0.0::DOUBLE AS w, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb)"]
    for t in range(steps):
        ctes.append(f"""q{t} AS (SELECT size, any_value(w) AS w, any_value(wa) AS wa, any_value(wb) AS wb, sum(quality - p) AS g, sum((quality - p) * a) - any_value(wa) AS ga,
            sum((quality - p) * b) - any_value(wb) AS gb, sum(p * (1 - p)) AS h, sum(p * (1 - p) * a) AS ha, sum(p * (1 - p) * b) AS hb, sum(p * (1 - p) * a * a) + 1 AS haa,
            sum(p * (1 - p) * a * b) AS hab, sum(p * (1 - p) * b * b) + 1 AS hbb FROM (SELECT tr.*, w, wa, wb, 1 / (1 + exp(-(w + wa * a + wb * b))) AS p FROM tr JOIN n{t} USING (size)) GROUP BY 1)""")
        ctes.append(f"""n{t + 1} AS (SELECT size, w + (g * (haa * hbb - hab * hab) - ha * (ga * hbb - hab * gb) + hb * (ga * hab - haa * gb)) / det AS w,
            wa + (h * (ga * hbb - hab * gb) - g * (ha * hbb - hab * hb) + hb * (ha * gb - ga * hb)) / det AS wa,
            wb + (h * (haa * gb - ga * hab) - ha * (ha * gb - ga * hb) + g * (ha * hab - haa * hb)) / det AS wb
            FROM (SELECT *, h * (haa * hbb - hab * hab) - ha * (ha * hbb - hab * hb) + hb * (ha * hab - haa * hb) AS det FROM q{t}))""")
    return ", ".join(ctes)


@query("learning_curve", f"""
    WITH {_DOC_FEATURES}, pos AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS i FROM x WHERE NOT test),
    tr AS (SELECT size, pos.* FROM pos JOIN (SELECT unnest({_SIZES}) AS size) ON i <= size), {_gauss_sql('tr', 'size')}, {_newton_sql(6)},
    gtr AS (SELECT tr.size, tr.quality AS truth, model.quality AS pred, wa * a + wb * b - 0.5 * (wa * ma + wb * mb) + prior AS score
            FROM tr JOIN model USING (size) QUALIFY row_number() OVER (PARTITION BY tr.size, doc_id ORDER BY score DESC, model.quality) = 1),
    a1 AS (SELECT size, avg((truth <> pred)::INT) AS e FROM gtr GROUP BY 1), a2 AS (SELECT size, avg((truth <> pred)::INT) AS e FROM scored GROUP BY 1),
    a3 AS (SELECT size, avg(((w + wa * a + wb * b > 0) <> (quality = 1))::INT) AS e FROM tr JOIN n6 USING (size) GROUP BY 1),
    a4 AS (SELECT size, avg(((w + wa * a + wb * b > 0) <> (quality = 1))::INT) AS e FROM x, n6 WHERE x.test GROUP BY 1)
    SELECT CAST(size AS BIGINT) AS size, round(a1.e, 6) AS gaussian_train, round(a2.e, 6) AS gaussian_test, round(a3.e, 6) AS logistic_train, round(a4.e, 6) AS logistic_test
    FROM a1 JOIN a2 USING (size) JOIN a3 USING (size) JOIN a4 USING (size)""")
def learning_curve(spark, sf):
    train, test = _split(_labelled_docs(spark, sf), "doc_id")
    out = L.learning_curves(train, test, "doc_id", ["a", "b"], "quality", _SIZES, newton=6, ridge=1.0)
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "size"})


# ---- clustering -------------------------------------------------------------------------------------

_ASSIGN_SQL = f"""
    WITH v AS ({_VEC}), c AS (SELECT vec_id AS cid, e FROM v ORDER BY vec_id LIMIT 8),
    near AS (SELECT a.vec_id, a.label, a.e, row_number() OVER (ORDER BY 1) AS x, b.cid FROM v a, c b
             QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY {_L2}, b.cid) = 1),
    k AS (SELECT vec_id, label, e, (SELECT count(*) FROM c WHERE c.cid < near.cid) AS cluster FROM near)"""


@query("kmeans_one_step", f"""{_ASSIGN_SQL}
    SELECT cluster, pos, round(avg(x), 6) AS centre FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS pos FROM k) GROUP BY 1, 2""")
def kmeans_one_step(spark, sf):
    vectors = table(spark, sf, "embeddings")
    start = K.first_vectors(vectors, "vec_id", "embedding", 8)
    centroids, _ = K.update_centroids(vectors, "embedding", start)
    rows = [(int(c), int(p), float(v)) for c, row in enumerate(centroids) for p, v in enumerate(row)]
    return spark.createDataFrame(rows, "cluster bigint, pos bigint, centre double").withColumn("centre", F.round("centre", 6))


def _kmeans_sql(rounds):
    """L1 assignment and mean update, written out per round from the first ten vectors."""
    ctes = [f"WITH v AS ({_VEC})", "c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, e FROM v ORDER BY vec_id LIMIT 10)"]
    for r in range(rounds + 1):
        ctes.append(f"""k{r} AS (SELECT a.vec_id, a.e, b.cluster, {_L1} AS dist FROM v a, c{r} b
            QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY dist, b.cluster) = 1)""")
        ctes.append(f"""c{r + 1} AS (SELECT cluster, list(m ORDER BY pos) AS e FROM (SELECT cluster, pos, avg(x) AS m FROM (
            SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM k{r}) GROUP BY 1, 2) GROUP BY 1)""")
    return ", ".join(ctes[:-1]) + f" SELECT vec_id, cluster, round(dist, 6) AS dist FROM k{rounds}"


@query("kmeans_clusters", _kmeans_sql(3))
def kmeans_clusters(spark, sf):
    vectors = table(spark, sf, "embeddings")
    centroids, _ = K.kmeans(vectors, "vec_id", "embedding", 10, "l1", max_iter=3)
    return K.assign(vectors, "vec_id", "embedding", centroids, "l1").select("vec_id", "cluster", F.round("dist", 6).alias("dist"))


@query("visual_word_histogram", f"""{_ASSIGN_SQL}
    SELECT label, cluster, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM k GROUP BY 1, 2""")
def visual_word_histogram(spark, sf):
    vectors = table(spark, sf, "embeddings")
    start = K.first_vectors(vectors, "vec_id", "embedding", 8)
    return K.codeword_histogram(vectors, "label", "vec_id", "embedding", start).withColumn("share", F.round("share", 6))


_XY_L2 = "sqrt(list_sum(list_transform(list_zip(a.xy, b.xy), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"


def _representatives_sql(k, turns, rounds):
    """Two axes by power iteration, k-means on them with every round written out, and the row nearest to each centroid."""
    step = "list_transform(u, lambda x: x / sqrt(list_dot_product(u, u)))"

    def power(name, matrix):
        return f"""{name} AS (SELECT 0 AS r, list_transform(range(1, 65), lambda i: 1.0::DOUBLE / i) AS v
            UNION ALL SELECT r + 1, {step} FROM (SELECT r, list_transform(c, lambda row_: list_dot_product(row_, v)) AS u FROM {name}, {matrix} WHERE r < {turns}))"""
    ctes = [f"v AS ({_VEC})", "x AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v)",
            "cov AS (SELECT a.i, b.i AS j, covar_pop(a.x, b.x) AS c FROM x a JOIN x b USING (vec_id) GROUP BY ALL)",
            "m1 AS (SELECT list(c ORDER BY i) AS c FROM (SELECT i, list(c ORDER BY j) AS c FROM cov GROUP BY 1))", power("p1", "m1"),
            f"a1 AS (SELECT v, list_dot_product(list_transform(c, lambda row_: list_dot_product(row_, v)), v) AS lam FROM p1, m1 WHERE r = {turns})",
            "m2 AS (SELECT list_transform(c, lambda row_, i: list_transform(row_, lambda x, j: x - lam * v[i] * v[j])) AS c FROM m1, a1)", power("p2", "m2"),
            f"f AS (SELECT vec_id, [list_dot_product(e, a1.v), list_dot_product(e, p2.v)] AS xy FROM v, a1, p2 WHERE p2.r = {turns})",
            f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, xy FROM f ORDER BY vec_id LIMIT {k})"]
    for r in range(rounds + 1):
        ctes.append(f"k{r} AS MATERIALIZED (SELECT a.vec_id, a.xy, b.cluster, {_XY_L2} AS dist FROM f a, c{r} b QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY dist, b.cluster) = 1)")
        ctes.append(f"c{r + 1} AS (SELECT cluster, [avg(xy[1]), avg(xy[2])] AS xy FROM k{r} GROUP BY 1)")
    return f"""WITH RECURSIVE {', '.join(ctes[:-1])} SELECT cluster, vec_id, round(dist, 6) AS dist, count(*) OVER (PARTITION BY cluster) AS n FROM k{rounds}
        QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY dist, vec_id) = 1"""


@query("cluster_representatives", _representatives_sql(4, 200, 20))
def cluster_representatives(spark, sf):
    out = K.representatives(table(spark, sf, "embeddings"), "vec_id", "embedding", k=4, max_iter=20)
    return out.select("cluster", "vec_id", F.round("dist", 6).alias("dist"), "n")


_EVENT_TERMS = "SELECT user_id AS doc, CAST(floor(value / 5) AS BIGINT) AS term, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2"


def _em_ctes(counts, epochs, k):
    """Soft EM written out per epoch, on (doc, term, n) rows; documents of ``docs`` without terms get the prior."""
    ctes = [f"n AS ({counts})", f"ks AS (SELECT unnest(range(0, {k})) AS c)", "bare AS (SELECT doc FROM docs WHERE doc NOT IN (SELECT doc FROM n))",
            "w0 AS (SELECT term, c, ((term + 1) * (c + 3) * 7919 % 1000 + 1) / 1000.0::DOUBLE AS mu FROM (SELECT DISTINCT term FROM n), ks)",
            f"p0 AS (SELECT c, 1.0::DOUBLE / {k} AS prior FROM ks)"]
    for r in range(epochs):
        ctes.append(f"m{r} AS (SELECT term, c, ln((mu + 1e-10) / sum(mu + 1e-10) OVER (PARTITION BY c)) AS lm FROM w{r})")
        ctes.append(f"""j{r} AS (SELECT doc, c, sum(n * lm) + ln(any_value(prior) + 1e-10) AS j FROM n JOIN m{r} USING (term) JOIN p{r} USING (c) GROUP BY 1, 2
            UNION ALL SELECT doc, c, ln(prior + 1e-10) FROM bare, p{r})""")
        ctes.append(f"t{r} AS (SELECT doc, c, exp(j - max(j) OVER (PARTITION BY doc)) AS x FROM j{r})")
        ctes.append(f"g{r} AS (SELECT doc, c, x / sum(x) OVER (PARTITION BY doc) AS gamma FROM t{r})")
        ctes.append(f"p{r + 1} AS (SELECT c, avg(gamma) AS prior FROM g{r} GROUP BY 1)")
        ctes.append(f"w{r + 1} AS (SELECT term, c, sum(n * gamma) AS mu FROM n JOIN g{r} USING (doc) GROUP BY 1, 2)")
    return ", ".join(ctes)


def _em_start(k):
    return [((F.col("term") + 1) * (c + 3) * 7919 % 1000 + 1) / 1000.0 for c in range(k)]


@query("em_mixture", f"""WITH docs AS (SELECT user_id AS doc FROM events), {_em_ctes(_EVENT_TERMS, 3, 3)}
    SELECT doc, c AS cluster, round(gamma, 5) AS share FROM g2""")
def em_mixture(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.col("user_id").alias("doc"), F.floor(F.col("value") / 5).cast("bigint").alias("term")) \
        .agg(F.count("*").alias("n"))
    posterior, _, _ = K.em_multinomial(counts, "doc", "term", "n", k=3, epochs=3, start=_em_start(3))
    out = posterior.select("doc", F.posexplode("gamma").alias("cluster", "share"))
    return out.select("doc", F.col("cluster").cast("bigint").alias("cluster"), F.round("share", 5).alias("share"))


@query("em_documents", f"""WITH docs AS (SELECT doc_id AS doc FROM documents),
    {_em_ctes(f"SELECT doc_id AS doc, term_index AS term, n::DOUBLE AS n FROM ({_COUNTS_SQL})", 5, 4)}
    SELECT doc AS doc_id, c AS cluster, round(gamma, 5) AS share FROM g4 QUALIFY row_number() OVER (PARTITION BY doc ORDER BY gamma DESC, c) = 1""")
def em_documents(spark, sf):
    posterior, _, _ = K.em_multinomial(doc_term_counts(spark, sf), "doc_id", "term_index", "n", k=4, epochs=5, start=_em_start(4),
                                       docs=table(spark, sf, "documents"))
    best = F.array_position("gamma", F.array_max("gamma")) - 1
    return posterior.select(F.col("doc").alias("doc_id"), best.alias("cluster"), F.round(F.array_max("gamma"), 5).alias("share"))


# ---- Spark ML ---------------------------------------------------------------------------------------

@query("feature_vectors", """
    WITH i AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx FROM orders GROUP BY 1),
         s AS (SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS idx FROM orders GROUP BY 1)
    SELECT o_orderkey, CAST(s.idx AS DOUBLE) AS status_index, CAST(i.idx AS DOUBLE) AS priority_index,
           concat_ws(',', CAST(floor(o_totalprice) AS BIGINT), array_to_string(list_transform(range(0, 3), lambda x: (x = s.idx)::INT), ','),
                     array_to_string(list_transform(range(0, 5), lambda x: (x = i.idx)::INT), ',')) AS features
    FROM orders JOIN i USING (o_orderpriority) JOIN s USING (o_orderstatus)""")
def feature_vectors(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").cast("double").alias("price"),
                                               F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    ready = L.feature_pipeline(["status", "priority"], ["price"]).fit(orders).transform(orders)
    flat = F.transform(vector_to_array("features"), lambda v: v.cast("bigint").cast("string"))
    return ready.select("o_orderkey", "status_index", "priority_index", F.array_join(flat, ",").alias("features"))


def _doc_vectors(spark, sf):
    text = F.col("text")
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"), F.log(F.col("n_chars") + 1).alias("size"),
        *[(X.substring_count(text, c) / (F.col("n_chars") + 1)).alias(n) for n, c in (("spaces", " "), ("commas", ","), ("stops", "."))],
        (F.regexp_count(text, F.lit("[0-9]")) / (F.col("n_chars") + 1)).alias("digits"))
    return L.with_vector(docs, ["size", "spaces", "commas", "stops", "digits"])


@query("compare_classifiers")
def compare_classifiers(spark, sf):
    train, test = _split(_doc_vectors(spark, sf), "doc_id")
    return L.compare_classifiers(train, test, L.default_classifiers())


def _embedding_vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _perceptron_sql(epochs):
    """Batch updates of all class vectors, every epoch written out."""
    ctes = [f"v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label, {_SPLIT} < 30 AS test FROM embeddings)", "tr AS (SELECT * FROM v WHERE NOT test)",
            "w0 AS (SELECT label AS cls, list_transform(range(0, 64), lambda x: 0.0::DOUBLE) AS w, 0.0::DOUBLE AS b FROM (SELECT DISTINCT label FROM tr))"]
    for t in range(epochs):
        ctes.append(f"z{t} AS MATERIALIZED (SELECT vec_id, label, e, cls, list_dot_product(e, w) + b AS z FROM tr, w{t})")
        ctes.append(f"miss{t} AS (SELECT count(*) AS n FROM (SELECT label, cls FROM z{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, cls) = 1) WHERE label <> cls)")
        ctes.append(f"mask{t} AS (SELECT cls, e, CASE WHEN label = cls THEN 1.0 ELSE -1.0 END - CASE WHEN z >= 0 THEN 1.0 ELSE -1.0 END AS m FROM z{t})")
        ctes.append(f"g{t} AS (SELECT cls, list(s ORDER BY i) AS g FROM (SELECT cls, i, sum(m * x) AS s FROM (SELECT cls, m, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM mask{t}) GROUP BY 1, 2) GROUP BY 1)")
        ctes.append(f"o{t} AS (SELECT cls, sum(m) AS s FROM mask{t} GROUP BY 1)")
        ctes.append(f"""w{t + 1} AS (SELECT cls, list_transform(list_zip(w, g), lambda p: p[1] + {0.9 ** t!r} * p[2] / rows_) AS w, b + {0.9 ** t!r} * s / n AS b
            FROM w{t} JOIN g{t} USING (cls) JOIN o{t} USING (cls), miss{t}, (SELECT count(*) AS rows_ FROM tr))""")
    return (f"WITH {', '.join(ctes)} SELECT vec_id, label AS truth, cls AS pred FROM v, w{epochs} WHERE test "
            "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_dot_product(e, w) + b DESC, cls) = 1")


@query("batch_perceptron", _perceptron_sql(6))
def batch_perceptron(spark, sf):
    train, test = _split(table(spark, sf, "embeddings"), "vec_id")
    model = P.train_perceptron(train, "embedding", "label", epochs=6, rate=1.0, decay=0.9)
    return test.select("vec_id", F.col("label").alias("truth"), model.predict(F.col("embedding")).alias("pred"))


@query("ovr_classifier")
def ovr_classifier(spark, sf):
    train, test = _split(_embedding_vectors(spark, sf), "vec_id")
    return L.compare_classifiers(train, test, {"one_vs_rest": L.ovr_classifier(max_iter=5)})


@query("mlp_classifier")
def mlp_classifier(spark, sf):
    train, test = _split(_embedding_vectors(spark, sf), "vec_id")
    return L.compare_classifiers(train, test, L.mlp_grid(64, 10, [8, 16], [0.03, 0.1], max_iter=20))


@query("self_taught")
def self_taught(spark, sf):
    train, rest = _split(_embedding_vectors(spark, sf), "vec_id")
    labelled = M.hash_split(train, "vec_id", 50).where("part = 'test'").drop("part")
    taught = L.self_taught(labelled.unionByName(rest), train, "features", 8)
    few, test = (taught.join(side.select("vec_id"), "vec_id", "left_semi") for side in (labelled, rest))
    plain = LogisticRegression(featuresCol="features", maxIter=20)
    return L.compare_classifiers(few, test, {"raw": plain, "self_taught": plain.copy({plain.featuresCol: "taught"})})


def _charges(spark, sf):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf, "lineitem").withColumn("charge", charge)


_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


def _expanded(rows, cols):
    """Determinant of the covariances of ``rows`` with ``cols``, expanded along the first row."""
    if not rows:
        return "(1)"
    return "(" + " ".join(f"{'-' if i % 2 else '+'} c_{min(rows[0], c)}_{max(rows[0], c)} * {_expanded(rows[1:], cols[:i] + cols[i + 1:])}"
                          for i, c in enumerate(cols)) + ")"


def _det(names):
    return _expanded(names, names)


def _aic_sql():
    """AIC of every subset by determinants of covariances, then the removals one after the other."""
    k = len(_LINE_FEATURES)
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    cols = [*_LINE_FEATURES, "y"]
    covs = ", ".join(f"covar_pop({cols[i]}, {cols[j]}) AS c_{i}_{j}" for i, j in pairs)
    sets = [[i for i in range(k) if mask >> i & 1] for mask in range(1, 1 << k)]
    rows = " UNION ALL ".join(
        f"SELECT {sum(1 << i for i in s)} AS mask, {len(s)} AS size, '{','.join(_LINE_FEATURES[i] for i in s)}' AS features, "
        f"n * (ln(2 * pi() * {_det([*s, k])} / {_det(s)}) + 1) + {2 * (len(s) + 2)} AS aic FROM m" for s in sets)
    steps = [f"p0 AS (SELECT 0 AS step, * FROM a WHERE size = {k})"]
    for t in range(1, k):
        steps.append(f"p{t} AS (SELECT {t} AS step, a.* FROM a JOIN p{t - 1} p ON a.size = p.size - 1 AND a.mask & p.mask = a.mask AND a.aic < p.aic ORDER BY a.aic LIMIT 1)")
    return (f"WITH m AS (SELECT count(*) AS n, {covs} FROM (SELECT *, {_CHARGE} AS y FROM lineitem)), a AS ({rows}), {', '.join(steps)} "
            + " UNION ALL ".join(f"SELECT step::INT AS step, features, round(aic, 2) AS aic FROM p{t}" for t in range(k)))


@query("backward_aic", _aic_sql())
def backward_aic(spark, sf):
    path = RG.backward_aic(_charges(spark, sf), _LINE_FEATURES, "charge")
    return spark.createDataFrame([(s, f, round(a, 2)) for s, f, a in path], "step int, features string, aic double")


def _coef_sql():
    """Normal equations by cofactors; p from the Student density summed over a fine grid."""
    k = len(_LINE_FEATURES)
    cols = [*_LINE_FEATURES, "y"]
    covs = ", ".join(f"covar_pop({cols[i]}, {cols[j]}) AS c_{i}_{j}" for i in range(k + 1) for j in range(i, k + 1))
    every = list(range(k))

    def without(i):
        return [e for e in every if e != i]
    rows = " UNION ALL ".join(
        f"SELECT '{_LINE_FEATURES[i]}' AS feature, n, ({' '.join(('+' if (i + j) % 2 == 0 else '-') + f' c_{j}_{k} * ' + _expanded(without(j), without(i)) for j in every)}) / {_det(every)} AS coef, "
        f"sqrt({_det([*every, k])} / {_det(every)} * {_det(without(i))} / {_det(every)} / (n - {k + 1})) AS se FROM m" for i in every)
    return f"""WITH m AS (SELECT count(*) AS n, {covs} FROM (SELECT *, {_CHARGE} AS y FROM lineitem)), b AS ({rows}),
        t AS (SELECT *, abs(coef / se) AS t FROM b), grid AS (SELECT (unnest(range(0, 40000)) + 0.5) / 1000 AS u),
        w AS (SELECT feature, sum(pow(1 + pow(t + u, 2) / (n - {k + 1}), -(n - {k}) / 2.0)) / 1000 AS tail, 2 * sum(pow(1 + u * u / (n - {k + 1}), -(n - {k}) / 2.0)) / 1000 AS whole
              FROM t, grid GROUP BY 1)
        SELECT feature, round(coef, 4) AS coefficient, round(2 * tail / whole, 6) AS p_value, CASE WHEN coef > 0 THEN 'positive' ELSE 'negative' END AS sign
        FROM t JOIN w USING (feature) WHERE 2 * tail / whole < 0.01"""


@query("significant_coefs", _coef_sql())
def significant_coefs(spark, sf):
    found = RG.significant_coefs(_charges(spark, sf), _LINE_FEATURES, "charge")
    rows = [(f, round(c, 4), round(p, 6), s) for f, c, p, s in found]
    return spark.createDataFrame(rows, "feature string, coefficient double, p_value double, sign string")


def _labelled_tfidf(spark, sf, min_df, numbered=False):
    """Weights (doc_id, part, term, weight) of the labelled training and test documents; vocabulary and idf come from training documents alone.

    ``numbered``: terms are given as numbers, which take less room than words.
    """
    marked = M.hash_split(table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"), "doc_id")
    tokens = marked.select("doc_id", "part", F.explode(X.regex_tokens(F.lower("text"), X.TFIDF_PATTERN)).alias("term"))
    counts = cut_lineage(T.term_counts(tokens, ["doc_id", "part"], "term"))
    train = counts.where("part = 'train'")
    n_docs = T.document_count(M.hash_split(table(spark, sf, "labels").select("doc_id"), "doc_id").where("part = 'train'"))
    idf = cut_lineage(T.idf_weights(train, "term", n_docs, min_df))
    known = cut_lineage(T.vocab_index(idf, "term")) if numbered else idf
    weights = cut_lineage(T.tfidf_by(counts, ["doc_id", "part"], "term", known, "term_index" if numbered else None))
    drop_stage(counts)
    labels = marked.select("doc_id", "part", "quality")
    return weights, labels, idf


_KNN_TEXT_SQL = f"""
    WITH d AS (SELECT doc_id, text, quality, {_split_sql('doc_id')} < 30 AS test FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT doc_id, test, term, count(*) AS c FROM (SELECT doc_id, test, unnest(regexp_extract_all(lower(text), '(\\w\\w+)', 1)) AS term FROM d) GROUP BY ALL),
    n AS (SELECT count(*)::DOUBLE AS n FROM d WHERE NOT test),
    idf AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM c WHERE NOT test GROUP BY 1), n WHERE df >= 2 AND df < 0.95 * n),
    w AS (SELECT doc_id, test, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM (SELECT doc_id, test, term, (ln(c) + 1) * idf AS w FROM c JOIN idf USING (term))),
    s AS (SELECT a.doc_id AS q, b.doc_id AS r, round(sum(a.w * b.w), 9) AS score FROM w a JOIN w b USING (term) WHERE a.test AND NOT b.test GROUP BY ALL),
    top AS (SELECT q, r, row_number() OVER (PARTITION BY q ORDER BY score DESC, r) AS rn FROM s QUALIFY rn <= 25)"""


@query("knn_text_neighbours", _KNN_TEXT_SQL + " SELECT q AS qid, r AS rid, rn::INT AS rank FROM top")
def knn_text_neighbours(spark, sf):
    weights = _labelled_tfidf(spark, sf, 2, numbered=True)[0]
    side = lambda part: weights.where(F.col("part") == part).drop("part")
    return SP.cosine_topk(side("test"), side("train"), 25).select("qid", "rid", "rank")


@query("knn_text_grid", _KNN_TEXT_SQL + """,
    votes AS (SELECT k, q, quality, count(*) AS n FROM top JOIN (SELECT unnest([1, 3, 5, 9, 15, 25]) AS k) ON rn <= k JOIN d ON d.doc_id = r GROUP BY k, q, quality
              QUALIFY row_number() OVER (PARTITION BY k, q ORDER BY count(*) DESC, quality) = 1)
    SELECT g.k::BIGINT AS k, round(avg((coalesce(votes.quality, 1) = d.quality)::INT), 6) AS accuracy, count(*) AS n
    FROM d CROSS JOIN (SELECT unnest([1, 3, 5, 9, 15, 25]) AS k) g LEFT JOIN votes ON votes.k = g.k AND votes.q = d.doc_id WHERE d.test GROUP BY 1""")
def knn_text_grid(spark, sf):
    weights, labels, _ = _labelled_tfidf(spark, sf, 2, numbered=True)
    side = lambda part: weights.where(F.col("part") == part).drop("part")
    found = SP.cosine_topk(side("test"), side("train"), 25)
    truth = labels.where("part = 'test'").select("doc_id", "quality")
    out = SP.vote_accuracy(found, truth, labels.where("part = 'train'").select("doc_id", "quality"), [1, 3, 5, 9, 15, 25], F.lit(1))
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("text_classifier")
def text_classifier(spark, sf):
    """Linear SVM, forest and elastic-net logistic regression on TF-IDF, each over a small grid; best first."""
    weights, labels, idf = _labelled_tfidf(spark, sf, .05)
    vocab = T.vocab_index(idf.select("term"), "term")
    ready = L.sparse_features(weights.drop("part").join(F.broadcast(vocab), "term"), "doc_id", "term_index", "weight", vocab.count())
    ready = cut_lineage(ready.join(labels.select("doc_id", "part", F.col("quality").cast("double").alias("label")), "doc_id"))
    train, test = (ready.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    grid = {f"svm reg={r}": LinearSVC(maxIter=10, regParam=r) for r in (0.001, 0.1)}
    grid |= {f"forest trees={t}": RandomForestClassifier(numTrees=t, seed=1) for t in (5, 15)}
    grid |= {f"logistic reg={r} l1={a}": LogisticRegression(maxIter=20, regParam=r, elasticNetParam=a) for r in (0.001, 0.01) for a in (0.0, 0.5)}
    return L.compare_classifiers(train, test, grid)
