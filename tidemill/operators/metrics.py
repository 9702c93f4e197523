"""Model metrics, sweeps, resampling and votes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import draw
from ..session import cut_lineage
from .neighbors import knn_join
from .ordering import best_row, global_index


def confusion(df: DataFrame, label: str, pred: str, positive: int = 1) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1 of the positive class, in one row."""
    y, p = F.col(label) == positive, F.col(pred) == positive
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return with_rates(c)


def with_rates(c: DataFrame) -> DataFrame:
    """Add the rates to confusion counts; a rate with a zero denominator is 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.withColumns({"accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp),
                          "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """MSE, RMSE, MAE and R2 in one aggregation."""
    err = F.col(y) - F.col(p)
    a = df.agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(y).alias("_var"))
    return a.select("mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide("mse", "_var")).alias("r2"))


def threshold_sweep(df: DataFrame, label: str, score: str, steps: int = 50, positive: int = 1) -> DataFrame:
    """Confusion counts and rates for the thresholds 0, 1/steps, ..., 1 (predict positive when score >= threshold).

    A score is counted once, under the highest threshold it reaches; the counts per
    threshold are sums over those ``steps + 1`` bins, never a copy of the rows per threshold.
    """
    reached = F.least(F.floor(F.round(F.col(score) * steps, 9)), F.lit(steps)).cast("bigint")
    bins = df.groupBy(reached.alias("bin")).agg(F.count_if(F.col(label) == positive).alias("pos"),
                                                F.count_if(F.col(label) != positive).alias("neg"))
    below = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(steps).cast("bigint")))
    wide = bins.withColumn("t", below)                      # at most (steps + 1) squared rows
    at = F.col("bin") >= F.col("t")
    counts = wide.groupBy("t").agg(F.sum(F.when(at, F.col("pos")).otherwise(0)).alias("tp"),
                                   F.sum(F.when(at, F.col("neg")).otherwise(0)).alias("fp"),
                                   F.sum(F.when(at, 0).otherwise(F.col("pos"))).alias("fn"),
                                   F.sum(F.when(at, 0).otherwise(F.col("neg"))).alias("tn"))
    return with_rates(counts.select((F.col("t") / steps).alias("threshold"), "tp", "fp", "fn", "tn"))


def grid_best(results: DataFrame, metric: str, tie: str, mode: str = "min") -> DataFrame:
    """Best cell of a grid of results."""
    return best_row(results, metric, tie, mode)


def majority_vote(df: DataFrame, cols: Sequence[str], name: str = "vote") -> DataFrame:
    """Most frequent of several 0/1 predictions on a row; a tie gives 0."""
    total = sum((F.col(c).cast("int") for c in cols[1:]), F.col(cols[0]).cast("int"))
    return df.withColumn(name, F.when(total * 2 > len(cols), 1).otherwise(0))


def weighted_score(df: DataFrame, weights: Mapping[str, float], name: str = "score") -> DataFrame:
    """Sum of weighted metrics, each divided by its maximum over the table."""
    tops = df.agg(*[F.max(F.col(m).cast("double")).alias(m) for m in weights]).select(F.struct("*")).scalar()
    terms = [F.coalesce(F.try_divide(F.col(m).cast("double"), tops[m]), F.lit(0.0)) * w for m, w in weights.items()]
    return df.withColumn(name, sum(terms[1:], terms[0]))


def hash_split(df: DataFrame, key: str, test_pct: int = 30, name: str = "part") -> DataFrame:
    """Repeatable split by a hash of the key, of any type: tag ``test`` or ``train``."""
    slot = draw(F.lit("split"), F.col(key)) % 100
    return df.withColumn(name, F.when(slot < test_pct, "test").otherwise("train"))


def bootstrap(df: DataFrame, key: str, value: str, size: int, times: int, seed: int = 1) -> DataFrame:
    """Mean of ``times`` resamples of ``size`` rows with replacement, as (replicate, mean, n_distinct).

    Draw i of replicate r picks row ``draw("boot", seed, r, i) mod rows`` in key order, so draws are independent for
    any number of rows. They are generated by the cluster, reduced to one count per
    picked row, and joined with the numbered rows.
    """
    rows = global_index(df.select(key, value), [key], "_row")
    n = rows.count()
    r, i = F.floor(F.col("id") / size), F.col("id") % size
    state = draw(F.lit("boot"), F.lit(seed), r, i)
    draws = (df.sparkSession.range(size * times).select(r.cast("bigint").alias("replicate"), (state % n).alias("_row"))
             .groupBy("replicate", "_row").agg(F.count("*").alias("_times")))
    picked = draws.join(rows, "_row")
    return picked.groupBy("replicate").agg((F.sum(F.col(value) * F.col("_times")) / size).alias("mean"),
                                           F.count("*").alias("n_distinct"))


def bootstrap_knn(train: DataFrame, test: DataFrame, key: str, vec: str, y: str, ks: Sequence[int], sizes: Sequence[int],
                  times: int, seed: int = 1, metric: str = "l1", depth: int | None = None) -> DataFrame:
    """Test error of k-NN regression over k, sample size and resample, as (size, replicate, k, mse, n).

    Sample r of a size draws so many training rows with replacement: draw i picks row ``draw("boot", seed, size, r, i) mod rows`` in key
    order. One search ranks the training rows of every test row; a sample's neighbours are those rows with its multiplicities, so no k, size or
    replicate needs a search of its own. The ranking is ``depth`` rows deep; test rows for which some sample has fewer than max(ks) draws that
    near are searched again four times deeper, until every sample has enough. A prediction is the mean of the k nearest draws.
    """
    most = max(ks)
    if most > min(sizes):
        raise ValueError("a sample must hold as many rows as the largest k")
    placed = global_index(train.select(key, vec, y), [key], "_row")
    n = placed.count()
    spark = train.sparkSession
    plan = spark.createDataFrame([(int(s), r) for s in sizes for r in range(times)], "size long, replicate long")
    drawn = plan.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)))
    picks = drawn.withColumn("_row", draw(F.lit("boot"), F.lit(seed), F.col("size"), F.col("replicate"), F.col("_i")) % n)
    weights = cut_lineage(picks.groupBy("size", "replicate", "_row").agg(F.count("*").alias("_m"))
                          .join(placed.select("_row", F.col(key).alias("rid"), F.col(y).alias("_y")), "_row").drop("_row"))
    used = cut_lineage(placed.join(weights.select(F.col("rid").alias(key)).distinct(), key, "left_semi").select(key, vec))
    total = used.count()
    depth = min(total, depth or 2 * most * -(-n // min(sizes)))
    pending, errors = cut_lineage(test.select(key, vec)), []
    while True:
        near = knn_join(pending, used, depth, metric).select("qid", "rid", "rank")
        ordered = Window.partitionBy("qid", "size", "replicate").orderBy("rank")
        ranked = near.join(weights, "rid").withColumn("_to", F.sum("_m").over(ordered))
        ranked = cut_lineage(ranked.where(F.col("_to") - F.col("_m") < most).select("qid", "size", "replicate", "_y", "_m", "_to"))
        reach = ranked.groupBy("qid", "size", "replicate").agg(F.max("_to").alias("_to"))
        enough = reach.where(F.col("_to") >= most).groupBy("qid").agg(F.count("*").alias("_n")).where(F.col("_n") == len(sizes) * times)
        errors.append(ranked.join(enough, "qid", "left_semi"))
        if depth == total:
            break
        pending = cut_lineage(pending.join(enough.select(F.col("qid").alias(key)), key, "left_anti"))
        if pending.isEmpty():
            break
        depth = min(total, 4 * depth)
    found = errors[0]
    for more in errors[1:]:
        found = found.unionByName(more)
    # dealt out by test row once, so that neither the sums nor the truth need another exchange; Spark takes the compressed size of ``found`` for its
    # real one and would send all predictions through the driver
    at = found.repartition("qid").withColumn("k", F.explode(F.array(*[F.lit(int(k)).cast("long") for k in ks])))
    at = at.withColumn("_c", F.least("_to", "k") - F.least(F.col("_to") - F.col("_m"), F.col("k"))).where(F.col("_c") > 0)
    preds = at.groupBy("qid", "size", "replicate", "k").agg((F.sum(F.col("_y") * F.col("_c")) / F.first("k")).alias("_p"))
    judged = preds.hint("shuffle_merge").join(test.select(F.col(key).alias("qid"), F.col(y).alias("_t")), "qid")
    return judged.groupBy("size", "replicate", "k").agg(F.avg(F.pow(F.col("_p") - F.col("_t"), 2)).alias("mse"), F.count("*").alias("n"))
