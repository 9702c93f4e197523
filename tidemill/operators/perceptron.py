"""A linear classifier of several classes, trained by whole-table updates: one aggregate per epoch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, spread


@dataclass(frozen=True)
class Perceptron:
    """One weight vector and offset per class, and the error rate before each epoch."""
    classes: tuple
    weights: np.ndarray     # classes x dimensions
    offsets: np.ndarray
    errors: tuple[float, ...]

    def margins(self, vec: Column) -> Column:
        """The linear form of every class as an array."""
        forms = []
        for w, b in zip(self.weights, self.offsets):
            products = F.zip_with(vec.cast("array<double>"), F.lit([float(v) for v in w]), lambda x, y: x * y)
            forms.append(F.aggregate(products, F.lit(0.0), lambda s, x: s + x) + float(b))
        return F.array(*forms)

    def predict(self, vec: Column) -> Column:
        """Class of the largest margin, the first one on ties."""
        margins = self.margins(vec)
        return F.get(F.array(*[F.lit(c) for c in self.classes]), (F.array_position(margins, F.array_max(margins)) - 1).cast("int"))


def _epoch_sums(weights: np.ndarray, offsets: np.ndarray):
    """mapInArrow: what the rows of a task add to each class's update, as (cell, value) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, wrong = np.zeros((len(weights), weights.shape[1] + 1)), 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            own = batch.column(1).to_numpy(zero_copy_only=False)
            z = x @ weights.T + offsets
            target = np.where(np.arange(len(weights)) == own[:, None], 1.0, -1.0)
            mask = target - np.where(z >= 0, 1.0, -1.0)
            step[:, :-1] += mask.T @ x
            step[:, -1] += mask.sum(axis=0)
            wrong += int((z.argmax(axis=1) != own).sum())
        values = np.append(step.ravel(), wrong)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["cell", "value"])
    return run


def train_perceptron(df: DataFrame, vec: str, y: str, epochs: int, rate: float = 1.0, decay: float = 1.0) -> Perceptron:
    """Train on all rows at once for a fixed number of epochs, or until no row is misclassified.

    Every class has a vector that should be positive on its own rows and negative on others. An epoch moves it by ``rate`` times the mean over
    all rows of (target - sign) * x, and its offset by ``rate`` times the sum of (target - sign) per misclassified row; the rate then shrinks
    by ``decay``. All start at zero. Rows with a missing vector, component or label are left out. Tasks reduce their rows to one number per class and
    dimension, so the shuffle does not grow with the rows.
    """
    rows = df.filter(F.col(vec).isNotNull() & F.col(y).isNotNull() & ~F.exists(vec, lambda x: x.isNull()))
    labels = sorted(r[0] for r in rows.select(y).distinct().collect())      # one row per class
    if not labels:
        raise ValueError("there is no row with a vector and a label")
    number = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col(y)) - 1
    held = cut_lineage(rows.select(F.col(vec).cast("array<double>").alias("x"), number.cast("int").alias("own")))
    n, dims, most = held.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if dims != most:
        raise ValueError("vectors differ in length")
    w, b, errors = np.zeros((len(labels), dims)), np.zeros(len(labels)), []
    for _ in range(epochs):
        summed = spread(held, "own").mapInArrow(_epoch_sums(w, b), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        values = np.zeros(w.size + len(b) + 1)
        for cell, value in summed.collect():
            values[cell] = value
        wrong, step = values[-1], values[:-1].reshape(len(labels), dims + 1)
        errors.append(float(wrong / n))
        if not wrong:
            break
        w = w + rate * step[:, :-1] / n
        b = b + rate * step[:, -1] / wrong
        rate *= decay
    return Perceptron(tuple(labels), w, b, tuple(errors))
