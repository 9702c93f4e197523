"""K-means, codeword histograms, cluster representatives and a mixture of multinomials."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import bucketed_stage, cut_lineage, drop_bucketed, drop_stage
from .neighbors import _matrix, distances
from .ordering import first_per_key


def first_vectors(df: DataFrame, id_col: str, vec: str, k: int) -> np.ndarray:
    """The vectors of the first k rows by id, as starting centroids."""
    return _matrix(df.select(id_col, vec).orderBy(id_col).limit(k).toPandas()[vec])


def assign(df: DataFrame, id_col: str, vec: str, centroids: np.ndarray, metric: str = "l2",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Nearest centroid (0-based, first on ties) and its distance for every row; centroids are k short vectors."""
    cols = [id_col, *keep]
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in cols)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                d = distances(_matrix(pdf[vec]), centroids, metric)
                cluster = d.argmin(axis=1)
                yield pdf[cols].assign(cluster=cluster, dist=d[np.arange(len(d)), cluster])

    return df.select(*cols, vec).mapInPandas(nearest, f"{kinds}, cluster bigint, dist double")


def update_centroids(df: DataFrame, vec: str, centroids: np.ndarray, metric: str = "l2") -> tuple[np.ndarray, float]:
    """One k-means step: (new centroids, cost). A task sends one partial sum per cluster; empty clusters stay."""
    k, dim = centroids.shape

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, cost = np.zeros((k, dim)), np.zeros(k), np.zeros(k)
        for pdf in batches:
            if not len(pdf):
                continue
            x = _matrix(pdf[vec])
            d = distances(x, centroids, metric)
            cluster = d.argmin(axis=1)
            np.add.at(total, cluster, x)
            n += np.bincount(cluster, minlength=k)
            cost += np.bincount(cluster, weights=d[np.arange(len(d)), cluster], minlength=k)
        used = np.flatnonzero(n)
        if len(used):       # a task without rows has no sums
            yield pd.DataFrame({"cluster": used, "n": n[used], "cost": cost[used], "total": list(total[used])})

    sums = df.select(vec).mapInPandas(partial, "cluster bigint, n double, cost double, total array<double>")
    merged = sums.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(dim)]).toPandas()
    new = centroids.copy()
    if len(merged):
        new[merged["cluster"].to_numpy()] = merged[[f"t{i}" for i in range(dim)]].to_numpy() / merged[["n"]].to_numpy()
    return new, float(merged["cost"].sum())


def kmeans(df: DataFrame, id_col: str, vec: str, k: int, metric: str = "l2", max_iter: int = 20,
           shift: float = 0.0) -> tuple[np.ndarray, list[float]]:
    """Centroids from the first k rows, until the total shift is at most ``shift``; also the cost per round.

    Only k centroids travel between driver and tasks, so rounds build up no lineage.
    """
    centroids, costs = first_vectors(df, id_col, vec, k), []
    for _ in range(max_iter):
        new, cost = update_centroids(df, vec, centroids, metric)
        costs.append(cost)
        moved = np.abs(new - centroids).sum() if metric == "l1" else np.sqrt(((new - centroids) ** 2).sum(axis=1)).sum()
        centroids = new
        if moved <= shift:
            break
    return centroids, costs


def codeword_histogram(df: DataFrame, owner: str, id_col: str, vec: str, centroids: np.ndarray,
                       metric: str = "l2") -> DataFrame:
    """Share of each codeword per owner, as (owner, cluster, share); absent codewords are left out."""
    counts = assign(df, id_col, vec, centroids, metric, (owner,)).groupBy(owner, "cluster").agg(F.count("*").alias("n"))
    totals = counts.groupBy(owner).agg(F.sum("n").alias("total"))
    return counts.join(totals, owner).select(owner, "cluster", (F.col("n") / F.col("total")).alias("share"))


def _products(dims: int):
    """mapInPandas: rows, sums and sums of products of the components of a task's vectors, as (cell, value)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims + 1, dims + 1))
        for pdf in batches:
            if len(pdf):
                x = np.c_[np.ones(len(pdf)), _matrix(pdf.iloc[:, 0])]
                total += x.T @ x
        yield pd.DataFrame({"cell": np.arange(total.size), "value": total.ravel()})
    return run


def principal_axes(df: DataFrame, vec: str, dims: int, rounds: int = 200) -> np.ndarray:
    """The first principal axes of vectors of one length, a row each, by power iteration on their covariance.

    One aggregation gives the covariance, as wide as the vectors. Every axis starts at (1, 1/2, 1/3, ...) and takes a fixed number of rounds; it is then
    taken out of the covariance. Without rows, all axes are zero.
    """
    rows = df.filter(F.col(vec).isNotNull()).select(F.col(vec).cast("array<double>"))
    wide = rows.agg(F.coalesce(F.max(F.size(vec)), F.lit(0))).first()[0]
    total = np.zeros((wide + 1) ** 2)
    for cell, value in rows.mapInPandas(_products(wide), "cell int, value double").groupBy("cell").agg(F.sum("value")).collect():
        total[cell] = value
    total = total.reshape(wide + 1, wide + 1)
    axes = np.zeros((dims, wide))
    if not total[0, 0]:
        return axes
    mean = total[0, 1:] / total[0, 0]
    cov = total[1:, 1:] / total[0, 0] - np.outer(mean, mean)
    for d in range(min(dims, wide)):
        axis = 1.0 / np.arange(1, wide + 1)
        for _ in range(rounds):
            turned = cov @ axis
            length = np.linalg.norm(turned)
            if not length:
                break
            axis = turned / length
        axes[d] = axis
        cov = cov - (axis @ cov @ axis) * np.outer(axis, axis)
    return axes


def project(df: DataFrame, id_col: str, vec: str, dims: int = 2, name: str = "xy", rounds: int = 200) -> DataFrame:
    """Coordinates along the principal axes as an array column."""
    axes = principal_axes(df, vec, dims, rounds)

    @F.pandas_udf("array<double>")
    def along(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(vectors) @ axes.T)) if len(vectors) else pd.Series([], dtype=object)
    return df.filter(F.col(vec).isNotNull()).select(id_col, along(F.col(vec).cast("array<double>")).alias(name))


def representatives(df: DataFrame, id_col: str, vec: str, k: int = 4, dims: int = 2, max_iter: int = 50) -> DataFrame:
    """The row closest to each centroid after a projection to ``dims`` components."""
    flat = cut_lineage(project(df, id_col, vec, dims))
    centroids, _ = kmeans(flat, id_col, "xy", k, "l2", max_iter)
    placed = assign(flat, id_col, "xy", centroids)
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("n"))
    return first_per_key(placed, ["cluster"], ["dist", id_col]).join(sizes, "cluster")


def em_multinomial(counts: DataFrame, doc: str, term: str, n: str, k: int = 4, epochs: int = 10, mode: str = "soft",
                   eps: float = 1e-10, tolerance: float = 0.0, start: list[Column] | None = None,
                   docs: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[float]]:
    """Mixture of k multinomials over long counts: (posteriors, term weights, log-likelihood per epoch).

    Everything stays in long form. The counts are stored by document once. The E-step joins them with one k-vector of
    log weights per term and adds up per document, in place unless the vocabulary is too large to be sent; the M-step
    brings each document's shares to its counts and is one partial aggregation per term. The start weights per cluster are expressions over
    ``term``, by default drawn from its hash. ``docs`` may list all documents: those without any term get the prior.
    """
    counts = counts.select(F.col(doc).alias("doc"), F.col(term).alias("term"), F.col(n).cast("double").alias("n"))
    counts = bucketed_stage(counts.repartition("doc"), "doc")
    start = start or [(F.pmod(F.xxhash64("term", F.lit(c)), F.lit(1000)) + 1) / 1000.0 for c in range(k)]
    weights = counts.select("term").distinct().select("term", F.array(*start).alias("mu"))
    prior, likelihoods = [1.0 / k] * k, []
    posterior = without = None
    stages: list[DataFrame] = []
    if docs is not None:
        without = cut_lineage(docs.select(F.col(doc).alias("doc")).distinct().join(counts.hint("shuffle_merge"), "doc", "left_anti")).select(
            "doc", *[F.lit(0.0).alias(f"g{c}") for c in range(k)])

    def normalised(w: DataFrame) -> DataFrame:
        """Log weights; the table they come from is the newest of ``stages``."""
        w = cut_lineage(w)
        stages.append(w)
        sums = w.agg(*[F.sum(F.col("mu")[c] + eps).alias(f"s{c}") for c in range(k)]).first()
        return w.select("term", F.array(*[F.log((F.col("mu")[c] + eps) / sums[c]) for c in range(k)]).alias("log_mu"))

    log_mu = normalised(weights)
    for _ in range(epochs):
        scores = (counts.join(log_mu, "term").groupBy("doc")
                  .agg(*[F.sum(F.col("n") * F.col("log_mu")[c]).alias(f"g{c}") for c in range(k)]))
        scores = scores if without is None else scores.unionByName(without)
        joint = [F.col(f"g{c}") + float(np.log(prior[c] + eps)) for c in range(k)]
        top = F.greatest(*joint) if k > 1 else joint[0]
        total = sum((F.exp(j - top) for j in joint[1:]), F.exp(joint[0] - top))
        shares = [F.exp(j - top) / total for j in joint]
        if mode == "hard":
            best = F.least(*[F.when(j == top, c) for c, j in enumerate(joint)]) if k > 1 else F.lit(0)
            shares = [F.when(best == c, 1.0).otherwise(0.0) for c in range(k)]
        before, posterior = posterior, cut_lineage(scores.select("doc", F.array(*shares).alias("gamma"), (top + F.log(total)).alias("ll")))
        facts = posterior.agg(F.sum("ll").alias("ll"), F.count("*").alias("n"),
                              *[F.sum(F.col("gamma")[c]).alias(f"p{c}") for c in range(k)]).first()
        likelihoods.append(facts["ll"])
        prior = [facts[f"p{c}"] / facts["n"] for c in range(k)]
        log_mu = normalised(counts.join(posterior, "doc").groupBy("term").agg(
            F.array(*[F.sum(F.col("n") * F.col("gamma")[c]) for c in range(k)]).alias("mu")))
        drop_stage(before)
        drop_stage(stages.pop(0))
        if len(likelihoods) > 1 and abs(likelihoods[-1] - likelihoods[-2]) < tolerance:
            break
    drop_bucketed(counts)
    return posterior, log_mu, likelihoods
