"""Models over tables: closed forms from aggregated moments, and Spark ML estimators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .regression import logistic_by_size, moments, with_size_step


# ---- features ------------------------------------------------------------------------------------

def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str], out: str = "features") -> Pipeline:
    """Index, one-hot encode and assemble all columns as a single Spark ML pipeline."""
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical],
                          handleInvalid="keep", stringOrderType="frequencyDesc")
    onehot = OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_onehot" for c in categorical])
    assemble = VectorAssembler(inputCols=[*numeric, *[f"{c}_onehot" for c in categorical]], outputCol=out)
    return Pipeline(stages=[index, onehot, assemble])


def with_vector(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.array(*[F.col(f).cast("double") for f in features])))


def sparse_features(weights: DataFrame, doc: str, index: str, weight: str, size: int, out: str = "features") -> DataFrame:
    """Long (doc, index, weight) rows to one sparse vector per document, bounded by the vocabulary size."""
    make = F.udf(lambda pairs: SparseVector(size, [(int(p[0]), float(p[1])) for p in pairs]), VectorUDT())
    return weights.groupBy(doc).agg(make(F.array_sort(F.collect_list(F.struct(index, weight)))).alias(out))


# ---- closed forms --------------------------------------------------------------------------------

def linear(features: Sequence[str], coefs: Sequence[float], intercept: float) -> Column:
    out = F.lit(float(intercept))
    for f, c in zip(features, coefs):
        out = out + F.col(f) * float(c)
    return out


def ridge_sweep(train: DataFrame, test: DataFrame, features: Sequence[str], y: str, lambdas: Sequence[float]) -> DataFrame:
    """Errors of ridge regression for every lambda: (lambda, train_mse, mse, coef array); ``mse`` is that on the test rows.

    The penalty is ``lambda * |w|^2`` next to the mean squared error, intercept free.
    One pass over the training rows serves all lambdas and their training errors, one over the test rows scores them.
    """
    seen = moments(train, features, y)[None]
    k, fits = len(features), []
    for lam in lambdas:
        w = np.linalg.solve(seen.cov[:k, :k] + lam * np.eye(k), seen.cov[:k, k])
        fits.append((float(lam), w, float(seen.mean[k] - w @ seen.mean[:k])))
    errors = test.agg(*[F.avg(F.pow(F.col(y) - linear(features, w, b), 2)).alias(f"e{i}") for i, (_, w, b) in enumerate(fits)])
    rows = F.array(*[F.struct(F.lit(lam).alias("lambda"), F.lit(seen.error(w, b)).alias("train_mse"), F.col(f"e{i}").alias("mse"),
                              F.array(*[F.lit(float(c)) for c in w]).alias("coefs")) for i, (lam, w, b) in enumerate(fits)])
    return errors.select(F.explode(rows).alias("e")).select("e.*")


def log_target_sweep(train: DataFrame, test: DataFrame, features: Sequence[str], y: str, biases: Sequence[float]) -> DataFrame:
    """Fit ``log(y + bias)`` linearly for every bias and score ``exp(prediction) - bias``: (bias, rmse, mae).

    Rows with a missing feature or target are left out of the fit and of the errors.
    """
    k = len(features)
    train = train.dropna(subset=[*features, y])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    logs = [F.log(F.col(y) + float(b)) for b in biases]
    row = train.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
                    *[F.covar_pop(features[i], features[j]).alias(f"s{i}_{j}") for i, j in pairs],
                    *[F.avg(t).alias(f"t{b}") for b, t in enumerate(logs)],
                    *[F.covar_pop(F.col(f), t).alias(f"c{b}_{i}") for b, t in enumerate(logs) for i, f in enumerate(features)]).first()
    cov = np.zeros((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"s{i}_{j}"]
    mean, aggs = np.array([row[f"m{i}"] for i in range(k)]), []
    for b, bias in enumerate(biases):
        w = np.linalg.solve(cov, np.array([row[f"c{b}_{i}"] for i in range(k)]))
        err = F.exp(linear(features, w, row[f"t{b}"] - w @ mean)) - float(bias) - F.col(y)
        aggs.append(F.struct(F.lit(float(bias)).alias("bias"), F.sqrt(F.avg(err * err)).alias("rmse"),
                             F.avg(F.abs(err)).alias("mae")))
    return test.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("e")).select("e.*")


@dataclass(frozen=True)
class GaussianModel:
    """Class means with a shared covariance, as linear scores ``w . x + b`` per class."""
    features: tuple[str, ...]
    classes: tuple
    weights: np.ndarray
    offsets: np.ndarray

    def predict(self) -> Column:
        """Class of the highest score, the first one on ties."""
        scores = [linear(self.features, w, b) for w, b in zip(self.weights, self.offsets)]
        top = F.greatest(*scores) if len(scores) > 1 else scores[0]
        out = F.lit(self.classes[-1])
        for s, c in reversed(list(zip(scores[:-1], self.classes[:-1]))):
            out = F.when(s == top, F.lit(c)).otherwise(out)
        return out


def _gaussian(features, classes, n, sums, squares) -> GaussianModel:
    """From per-class counts, sums and sums of products."""
    n, total = np.asarray(n, dtype=float), float(np.sum(n))
    means = sums / n[:, None]
    pooled = (squares - n[:, None, None] * means[:, :, None] * means[:, None, :]).sum(axis=0) / total
    inverse = np.linalg.pinv(pooled)
    weights = means @ inverse
    offsets = -0.5 * np.einsum("ci,ci->c", weights, means) + np.log(n / total)
    return GaussianModel(tuple(features), tuple(classes), weights, offsets)


def _class_sums(df: DataFrame, keys: Sequence[Column], features: Sequence[str]):
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.count("*").alias("n"), *[F.sum(f).alias(f"s{i}") for i, f in enumerate(features)],
            *[F.sum(F.col(features[i]) * F.col(features[j])).alias(f"q{i}_{j}") for i, j in pairs]]
    rows = df.dropna(subset=list(features)).groupBy(*keys).agg(*aggs).collect()      # one row per class is the size of the model

    def unpack(r):
        q = np.zeros((k, k))
        for i, j in pairs:
            q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        return r["n"], np.array([r[f"s{i}"] for i in range(k)]), q
    return rows, unpack


def gaussian_fit(df: DataFrame, features: Sequence[str], y: str) -> GaussianModel:
    """Shared-covariance Gaussian classifier from one aggregation per class."""
    rows, unpack = _class_sums(df, [F.col(y).alias("y")], features)
    rows = sorted(rows, key=lambda r: r["y"])
    parts = [unpack(r) for r in rows]
    return _gaussian(features, [r["y"] for r in rows], [p[0] for p in parts], np.array([p[1] for p in parts]),
                     np.array([p[2] for p in parts]))


def gaussian_predict(df: DataFrame, model: GaussianModel, name: str = "pred") -> DataFrame:
    return df.withColumn(name, model.predict())


def gaussian_by_step(placed: DataFrame, features: Sequence[str], y: str, steps: int) -> list[GaussianModel]:
    """The classifiers of the rows with ``_step`` at most 0, 1, ...: running totals of one aggregation per step and class."""
    rows, unpack = _class_sums(placed, [F.col("_step").alias("step"), F.col(y).alias("y")], features)
    k, classes = len(features), sorted({r["y"] for r in rows})
    n, s, q = np.zeros(len(classes)), np.zeros((len(classes), k)), np.zeros((len(classes), k, k))
    by_step = {}
    for r in rows:
        by_step.setdefault(r["step"], []).append((classes.index(r["y"]), unpack(r)))
    models = []
    for i in range(steps):
        for c, (cn, cs, cq) in by_step.get(i, []):
            n[c] += cn
            s[c] += cs
            q[c] += cq
        seen = np.flatnonzero(n)
        models.append(_gaussian(features, [classes[c] for c in seen], n[seen], s[seen], q[seen]))
    return models


def learning_curve(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], y: str,
                   sizes: Sequence[int]) -> DataFrame:
    """Test error of the Gaussian classifier trained on the first ``size`` rows (by key), for all sizes.

    Rows are put into the interval between two sizes and summed once; the models are
    running totals of these sums. All of them score the test rows in one pass.
    """
    sizes = sorted(sizes)
    models = gaussian_by_step(with_size_step(train, key, [y, *features], sizes), features, y, len(sizes))
    wide = test.agg(*[F.avg(F.when(m.predict() == F.col(y), 0.0).otherwise(1.0)).alias(f"e{i}") for i, m in enumerate(models)])
    out = F.array(*[F.struct(F.lit(size).cast("bigint").alias("size"), F.col(f"e{i}").alias("error")) for i, size in enumerate(sizes)])
    return wide.select(F.explode(out).alias("e")).select("e.*")


def learning_curves(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], y: str, sizes: Sequence[int],
                    newton: int = 6, ridge: float = 1.0) -> DataFrame:
    """Error rates of the shared-covariance Gaussian classifier and of logistic regression, trained on the first ``size`` rows by key.

    Returns (size, gaussian_train, gaussian_test, logistic_train, logistic_test); training errors are those on the first ``size``
    rows. Two classes, the larger one positive; a size with rows of one class predicts it. Rows with a missing value are left out.
    """
    sizes = sorted(sizes)
    placed = cut_lineage(with_size_step(train.dropna(subset=[*features, y]), key, [y, *features], sizes))
    gaussian = gaussian_by_step(placed, features, y, len(sizes))
    classes = sorted({c for m in gaussian for c in m.classes})
    if len(classes) > 2:
        raise ValueError("logistic regression needs two classes")
    low, high = classes[0], classes[-1]
    weights = logistic_by_size(placed, features, y, len(sizes), high, newton, ridge)
    wrong_gauss = [F.when(m.predict() == F.col(y), 0.0).otherwise(1.0) for m in gaussian]
    wrong_logit = [F.when(F.when(linear(features, w[1:], w[0]) > 0, F.lit(high)).otherwise(F.lit(low)) == F.col(y), 0.0)
                   .otherwise(1.0) for w in weights]
    seen = [F.col("_step") <= i for i in range(len(sizes))]
    on_train = placed.agg(*[F.avg(F.when(s, e)).alias(f"{n}{i}") for n, errors in (("g", wrong_gauss), ("l", wrong_logit))
                            for i, (s, e) in enumerate(zip(seen, errors))]).first()
    on_test = test.dropna(subset=[*features, y]).agg(*[F.avg(e).alias(f"{n}{i}") for n, errors in (("g", wrong_gauss), ("l", wrong_logit))
                                                       for i, e in enumerate(errors)]).first()
    rows = [(int(size), on_train[f"g{i}"], on_test[f"g{i}"], on_train[f"l{i}"], on_test[f"l{i}"]) for i, size in enumerate(sizes)]
    return train.sparkSession.createDataFrame(rows, "size long, gaussian_train double, gaussian_test double, logistic_train double, logistic_test double")


# ---- Spark ML ------------------------------------------------------------------------------------

def default_classifiers(features: str = "features", label: str = "label", seed: int = 1) -> dict[str, Estimator]:
    args = {"featuresCol": features, "labelCol": label}
    return {"decision_tree": DecisionTreeClassifier(**args, seed=seed),
            "random_forest": RandomForestClassifier(**args, seed=seed),
            "logistic": LogisticRegression(**args), "gradient_boosted": GBTClassifier(**args, seed=seed, maxIter=10)}


def accuracy(scored: DataFrame, label: str = "label") -> float:
    return scored.agg(F.avg(F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0))).first()[0]


def compare_classifiers(train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], label: str = "label") -> DataFrame:
    """Accuracy of each classifier on the test rows, as (model, accuracy), best first."""
    train, test = cut_lineage(train), cut_lineage(test)
    rows = [(name, float(accuracy(e.fit(train).transform(test), label))) for name, e in estimators.items()]
    return train.sparkSession.createDataFrame(rows, "model string, accuracy double").orderBy(F.desc("accuracy"), "model")


def ovr_classifier(features: str = "features", label: str = "label", max_iter: int = 20) -> OneVsRest:
    """One linear classifier per class, the highest margin wins."""
    return OneVsRest(classifier=LinearSVC(maxIter=max_iter), featuresCol=features, labelCol=label)


def mlp_grid(inputs: int, classes: int, hidden: Sequence[int], steps: Sequence[float], max_iter: int = 50,
             seed: int = 1) -> dict[str, Estimator]:
    """Three-layer networks over hidden sizes and learning rates."""
    return {f"hidden={h} step={s}": MultilayerPerceptronClassifier(
        layers=[inputs, h, classes], maxIter=max_iter, stepSize=s, solver="gd", seed=seed) for h in hidden for s in steps}


def self_taught(labelled: DataFrame, unlabelled: DataFrame, features: str, dims: int, out: str = "taught") -> DataFrame:
    """Labelled rows with components appended that were learnt on labelled and unlabelled rows together."""
    model = PCA(k=dims, inputCol=features, outputCol="_learnt").fit(
        labelled.select(features).unionByName(unlabelled.select(features)))
    joined = VectorAssembler(inputCols=[features, "_learnt"], outputCol=out)
    return joined.transform(model.transform(labelled)).drop("_learnt")
