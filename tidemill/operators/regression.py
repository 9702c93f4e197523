"""Linear and logistic regression from aggregated moments.

A family of models costs one aggregation, or one per Newton step, however many sizes, penalties or subsets of features
it has: the driver sees sums of products alone, and everything else happens on matrices as wide as the features.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .ordering import global_index


# ---- moments and the sweep operator -------------------------------------------------------------

@dataclass(frozen=True)
class Moments:
    """Rows, means and population covariances of the features and, last, the target."""
    n: int
    mean: np.ndarray
    cov: np.ndarray

    def error(self, w: np.ndarray, intercept: float) -> float:
        """Mean squared error of ``intercept + w . x`` over the rows behind these moments."""
        bias = self.mean[-1] - intercept - w @ self.mean[:-1]
        return float(self.cov[-1, -1] - 2 * w @ self.cov[:-1, -1] + w @ self.cov[:-1, :-1] @ w + bias * bias)


def moments(df: DataFrame, features: Sequence[str], y: str, part: Column | str | None = None) -> dict:
    """``Moments`` for every value of ``part`` from one aggregation over the rows that have all columns; ``None`` without ``part``.

    ``part`` must have few values: each gives one row on the driver.
    """
    cols = [*features, y]
    tag = F.lit(None).cast("string") if part is None else F.col(part) if isinstance(part, str) else part
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = df.dropna(subset=cols).groupBy(tag.alias("part")).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(cols[i], cols[j]).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in rows:
        cov = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"s{i}_{j}"]
        out[r["part"]] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(cols))]), cov)
    return out


def sweep(a: np.ndarray, k: int) -> np.ndarray:
    """Move variable ``k`` of a symmetric matrix from the responses to the predictors, or back (``unsweep``)."""
    d = a[k, k]
    out = a - np.outer(a[:, k], a[k]) / d
    out[k], out[:, k] = a[k] / d, a[:, k] / d
    out[k, k] = -1 / d
    return out


def unsweep(a: np.ndarray, k: int) -> np.ndarray:
    """Undo ``sweep``: take a predictor out of the fit without another pass or another solution."""
    d = a[k, k]
    out = a - np.outer(a[:, k], a[k]) / d
    out[k], out[:, k] = -a[k] / d, -a[:, k] / d
    out[k, k] = -1 / d
    return out


def _swept(df: DataFrame, features: Sequence[str], y: str) -> tuple[int, np.ndarray]:
    """Rows, and the matrix of centred products with all features as predictors; features it can't tell apart are an error."""
    found = moments(df, features, y).get(None)
    if found is None:
        raise ValueError("there is no row with all columns")
    a = found.cov * found.n
    scale = np.diag(a).copy()
    for k in range(len(features)):
        if a[k, k] <= 1e-12 * scale[k]:
            raise ValueError(f"feature {features[k]} is a combination of those before it")
        a = sweep(a, k)
    return found.n, a


# ---- selection and significance --------------------------------------------------------------------

def backward_aic(df: DataFrame, features: Sequence[str], y: str) -> list[tuple[int, str, float]]:
    """Backward selection: drop the feature whose removal lowers AIC most, until none does; ties drop the first by name.

    Returns the kept sets as (step, comma-joined features, aic). One aggregation; removing a feature raises the residual
    sum by its squared coefficient over its diagonal entry, and is then one step back of the sweep operator.
    """
    n, a = _swept(df, features, y)

    def aic(rss, predictors):
        return n * (math.log(2 * math.pi * rss / n) + 1) + 2 * (predictors + 2)
    kept = list(range(len(features)))
    path = [(0, ",".join(features), aic(a[-1, -1], len(kept)))]
    while len(kept) > 1:
        trials = sorted((aic(a[-1, -1] - a[k, -1] ** 2 / a[k, k], len(kept) - 1), features[k], k) for k in kept)
        if trials[0][0] >= path[-1][2]:
            break
        a = unsweep(a, trials[0][2])
        kept.remove(trials[0][2])
        path.append((len(path), ",".join(features[k] for k in kept), trials[0][0]))
    return path


def two_sided_p(t: float, dof: int) -> float:
    """Chance that a Student variable lies as far out as ``t``; its density integrated over the angle atan(t / sqrt(dof))."""
    nodes, weights = np.polynomial.legendre.leggauss(200)
    low = math.atan(abs(t) / math.sqrt(dof))
    high = min(math.pi / 2, low + 40 / math.sqrt(dof))
    angles = low + (nodes + 1) / 2 * (high - low)
    log_scale = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(math.pi)
    return min(1.0, float(2 * (weights @ np.exp(log_scale + (dof - 1) * np.log(np.cos(angles)))) * (high - low) / 2))


def significant_coefs(df: DataFrame, features: Sequence[str], y: str, level: float = 0.01) -> list[tuple[str, float, float, str]]:
    """Coefficients with a p-value below ``level`` as (feature, coefficient, p, sign), from the same matrix as ``backward_aic``."""
    n, a = _swept(df, features, y)
    dof, out = n - len(features) - 1, []
    for k, name in enumerate(features):
        coef = a[k, -1]
        p = two_sided_p(coef / math.sqrt(-a[k, k] * a[-1, -1] / dof), dof)
        if p < level:
            out.append((name, float(coef), p, "positive" if coef > 0 else "negative"))
    return out


# ---- penalised fits -----------------------------------------------------------------------------------

def _descend(r: np.ndarray, c: np.ndarray, w: np.ndarray, l1: float, l2: float, rounds: int, tol: float) -> np.ndarray:
    """Coordinate descent from ``w`` on standardised features with correlations ``r`` and covariances ``c`` with the target."""
    w = w.copy()
    for _ in range(rounds):
        largest = 0.0
        for j in range(len(w)):
            pull = c[j] - r[j] @ w + w[j]
            new = math.copysign(max(abs(pull) - l1, 0.0), pull) / (1 + l2)
            largest, w[j] = max(largest, abs(new - w[j])), new
        if largest <= tol:
            break
    return w


def elastic_net_path(df: DataFrame, part: str, features: Sequence[str], y: str, lambdas: Sequence[float], alphas: Sequence[float],
                     rounds: int = 10_000, tol: float = 1e-13) -> list[tuple[float, float, float, float, int]]:
    """Elastic-net regression over a grid, as (lambda, alpha, train_mse, test_mse, nonzero).

    Half the mean squared error plus ``lambda * (alpha * |w|_1 + (1 - alpha) / 2 * |w|^2)`` over standardised features, intercept
    free. ``part`` says ``train`` or ``test``. One aggregation gives the moments of both parts; the fits descend along
    falling lambdas, each from the one before, and the errors follow from the moments.
    """
    parts = moments(df, features, y, part)
    train, test, k = parts["train"], parts["test"], len(features)
    sd = np.sqrt(np.diag(train.cov)[:k])
    sd[sd == 0] = 1.0
    r, c, out = train.cov[:k, :k] / np.outer(sd, sd), train.cov[:k, k] / sd, []
    for alpha in alphas:
        w = np.zeros(k)
        for lam in sorted(lambdas, reverse=True):
            w = _descend(r, c, w, lam * alpha, lam * (1 - alpha), rounds, tol)
            slope = w / sd
            intercept = train.mean[k] - slope @ train.mean[:k]
            out.append((float(lam), float(alpha), train.error(slope, intercept), test.error(slope, intercept), int(np.count_nonzero(w))))
    return sorted(out)


# ---- logistic regression for many training sizes at once --------------------------------------------------

def _linear(features: Sequence[str], weights: Column) -> Column:
    out = weights[0]
    for i, f in enumerate(features):
        out = out + F.col(f) * weights[i + 1]
    return out


def _literal(weights: np.ndarray) -> Column:
    """Rows of weights as an array of arrays."""
    return F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in weights])


def with_size_step(train: DataFrame, key: str, columns: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """The first ``max(sizes)`` rows by key with ``_step``: the smallest of the sorted sizes whose first rows include it."""
    placed = global_index(train.select(key, *columns), [key], "_pos", start=1).where(F.col("_pos") <= sizes[-1])
    step = F.lit(len(sizes) - 1)
    for i in reversed(range(len(sizes) - 1)):
        step = F.when(F.col("_pos") <= sizes[i], i).otherwise(step)
    return placed.withColumn("_step", step).drop("_pos")


def logistic_by_size(placed: DataFrame, features: Sequence[str], y: str, models: int, positive, newton: int = 6, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of logistic regressions, the i-th trained on the rows with ``_step <= i``.

    Each Newton step is one aggregation for all models: a row adds its gradient and curvature to every model
    that has it, summed before the shuffle to one row per model. ``ridge`` is the penalty on half the squared slopes, which keeps small
    samples that a line separates finite. The number of steps is fixed.
    """
    k = len(features)
    ones = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    rows = placed.dropna(subset=[*features, y]).withColumn("_model", F.explode(F.sequence(F.col("_step"), F.lit(models - 1))))
    weights, penalty = np.zeros((models, k + 1)), np.diag([0.0] + [ridge] * k)
    target = F.when(F.col(y) == positive, 1.0).otherwise(0.0)
    for _ in range(newton):
        p = 1 / (1 + F.exp(-_linear(features, F.get(_literal(weights), F.col("_model")))))
        scored = rows.withColumn("_p", p)
        aggs = [F.sum((target - F.col("_p")) * x).alias(f"g{i}") for i, x in enumerate(ones)]
        aggs += [F.sum(F.col("_p") * (1 - F.col("_p")) * ones[i] * ones[j]).alias(f"h{i}_{j}") for i, j in pairs]
        for r in scored.groupBy("_model").agg(*aggs).collect():         # one row per size
            m, h = r["_model"], penalty.copy()
            for i, j in pairs:
                h[i, j] += r[f"h{i}_{j}"]
                h[j, i] = h[i, j]
            gradient = np.array([r[f"g{i}"] for i in range(k + 1)]) - penalty @ weights[m]
            weights[m] += np.linalg.lstsq(h, gradient, rcond=None)[0]
    return weights
