"""Quality scores by a generalised additive model with pairwise interactions.

Every text becomes a few measures (lengths, shares of kinds of characters, repetition). The model is a sum of lookup
tables: one over the bins of each measure, and one over the coarser bins of each of the pairs that explain most of
what the single tables leave. Tables are learned in turn, round after round, by small boosted trees on one
measure or pair at a time: cuts are found on histograms of gradients, and a tree is added to its table right away.
A score is the logistic function of the tables' entries for the text's bins.

The tables are fitted on a bounded sample, the ``SAMPLE`` different measured texts per label with the smallest hashes,
weighted so that labels count as often as they occur. Scoring covers every row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import uniform

MEASURES = ["words", "word_bytes", "longest_word", "different_words", "commonest_word", "upper", "digits", "symbols",
            "stops", "commas", "non_ascii", "lines", "repeated_lines", "spaces"]
SAMPLE = 10_000         # different measured texts per label the tables are fitted on
BINS, PAIR_BINS, SEARCH_BINS = 64, 16, 8
PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 6, 80, 40, 0.1
LEAST_WEIGHT, SHRINK = 5.0, 1.0     # rows a leaf needs, and what is added to its curvature

_SPACE, _LETTER, _UPPER, _DIGIT, _STOP, _COMMA, _HIGH, _SYMBOL = range(8)
_KIND = np.full(256, _SYMBOL, dtype=np.uint8)
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = _LETTER, _UPPER, _DIGIT, _HIGH
_KIND[[ord(c) for c in ".!?"]] = _STOP
_KIND[[ord(c) for c in ",;:'\"()-"]] = _COMMA
_CHUNK = 1 << 20


def measure(text: str | None) -> list[float]:
    """The measures of a whole text; all 0 for null and for texts without a word."""
    data = (text or "").encode("utf-8")
    words = data.split()
    if not words:
        return [0.0] * len(MEASURES)
    kinds = np.zeros(8, dtype=np.int64)
    for at in range(0, len(data), _CHUNK):
        kinds += np.bincount(_KIND[np.frombuffer(data, np.uint8, min(_CHUNK, len(data) - at), at)], minlength=8)
    n, ink, times = len(words), len(data) - kinds[_SPACE], Counter(words)
    lines = [line for line in data.split(b"\n") if line]
    letters = kinds[_LETTER] + kinds[_UPPER] + kinds[_HIGH]
    return [np.log1p(n), ink / n, np.log1p(max(map(len, times))), len(times) / n, max(times.values()) / n,
            kinds[_UPPER] / max(letters, 1), kinds[_DIGIT] / ink, kinds[_SYMBOL] / ink, kinds[_STOP] / n, kinds[_COMMA] / n,
            kinds[_HIGH] / ink, len(lines) / n, 1 - len(set(lines)) / len(lines), kinds[_SPACE] / n]


def measures(text: Column) -> Column:
    """The measures of a text column as an array of doubles."""
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[float(v) for v in measure(t)] for t in batch], dtype=object)
    return run(text)


# ---- the model -------------------------------------------------------------------------------------

@dataclass
class AdditiveModel:
    """Edges and a table per measure, edges and a table per pair, and the starting score."""
    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of measures."""
        total = np.full(len(x), self.start)
        for f, (edges, entries) in enumerate(zip(self.edges, self.tables)):
            total += entries[np.searchsorted(edges, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], side="right") for f in {f for p in self.pairs for f in p}}
        for (a, b), entries in zip(self.pairs, self.pair_tables):
            total += entries[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner borders of about equally filled bins; equal values share one."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _gain(g, h):
    return g * g / (h + SHRINK)


def _leaf(g, h):
    return -g / (h + SHRINK)


def _cut(g: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[float, int]:
    """The best gain of one cut of a histogram, and how many bins lie before it (0: none helps)."""
    if len(g) < 2:
        return 0.0, 0
    lg, lh, lw = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(w)[:-1]
    gain = _gain(lg, lh) + _gain(g.sum() - lg, h.sum() - lh) - _gain(g.sum(), h.sum())
    gain[(lw < LEAST_WEIGHT) | (w.sum() - lw < LEAST_WEIGHT)] = 0
    best = int(gain.argmax())
    return (float(gain[best]), best + 1) if gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree of two levels on one histogram."""
    bounds = {0, len(g)}
    at = _cut(g, h, w)[1]
    if at:
        left, right = _cut(g[:at], h[:at], w[:at])[1], _cut(g[at:], h[at:], w[at:])[1]
        bounds |= {at, left, at + right}
    bounds, out = sorted(bounds), np.zeros(len(g))
    for lo, hi in zip(bounds, bounds[1:]):
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, w: np.ndarray):
    """Best gain of one cut along each axis of a two-way histogram, and the leaf values per cell."""
    cg, ch, cw = (np.cumsum(np.cumsum(np.pad(t, ((1, 0), (1, 0))), axis=0), axis=1) for t in (g, h, w))

    def parts(c):
        low, high = c[1:-1, 1:-1], c[-1, -1]
        top, side = c[1:-1, -1:], c[-1:, 1:-1]
        return low, top - low, side - low, high - top - side + low
    pg, ph, pw = parts(cg), parts(ch), parts(cw)
    if not pg[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(a, b) for a, b in zip(pg, ph)) - _gain(cg[-1, -1], ch[-1, -1])
    gain = np.where(np.minimum.reduce(pw) < LEAST_WEIGHT, 0, gain)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    if gain[i, j] <= 1e-9:
        return 0.0, out
    places = [(slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
              (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))]
    for place, a, b in zip(places, pg, ph):
        out[place] = _leaf(a[i, j], b[i, j])
    return float(gain[i, j]), out


def fit_tables(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of one table per measure, then of the pairs that explain most of the rest."""
    share = (weight @ y + 0.5) / (weight.sum() + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    total = np.full(len(y), model.start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return weight * (p - y), weight * p * (1 - p)
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    filled = [np.bincount(b, weight, len(e) + 1) for b, e in zip(bins, model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(filled[f])), np.bincount(b, h, len(filled[f])), filled[f])
            model.tables[f] += step
            total += step[b]

    def grid(a, b, size, values):
        return np.bincount(a * size[1] + b, values, size[0] * size[1]).reshape(size)
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    rough = [_edges(x[:, f], SEARCH_BINS) for f in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(rough)]
    g, h = slopes()
    ranked = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            size = (len(rough[a]) + 1, len(rough[b]) + 1)
            ranked.append((-_quadrants(*(grid(cells[a], cells[b], size, v) for v in (g, h, weight)))[0], a, b))
    model.pairs = [(a, b) for gain, a, b in sorted(ranked)[:PAIRS] if gain < 0]
    cells = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    sizes = [(len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1) for a, b in model.pairs]
    model.pair_tables = [np.zeros(s) for s in sizes]
    for _ in range(PAIR_ROUNDS):
        for i, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _quadrants(*(grid(cells[a], cells[b], sizes[i], v) for v in (g, h, weight)))[1]
            model.pair_tables[i] += step
            total += step[cells[a], cells[b]]
    return model


def fit(measured: DataFrame, label_col: str = "label", measures_col: str = "measures", sample: int = SAMPLE) -> AdditiveModel:
    """The model of measured rows labelled 0 or 1; rows without a label are left out.

    Equal measures with one label count as one different text that weighs as many rows as it has. With no labelled
    row the model gives 0.5 to every text, with one label only it gives nearly that label.
    """
    rows = measured.filter(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("int").alias("y"), F.col(measures_col).alias("x"))
    different = rows.groupBy("y", "x").agg(F.count("*").alias("n")).withColumn("order", uniform("x", "y"))
    totals = {r["y"]: r for r in different.groupBy("y").agg(F.count("*").alias("texts"), F.sum("n").alias("rows")).collect()}
    if not totals:
        return AdditiveModel(0.0)
    # about twice as many as needed are ranked; fewer than needed have a chance below exp(-25)
    rate = {y: (2 * sample + 100) / r["texts"] for y, r in totals.items()}
    near = F.col("order") < F.element_at(F.create_map(*[F.lit(v) for item in rate.items() for v in item]), F.col("y"))
    place = F.row_number().over(Window.partitionBy("y").orderBy("order", "x"))
    drawn = different.filter(near).withColumn("place", place).filter(F.col("place") <= sample).orderBy("y", "place").toPandas()
    y = drawn["y"].to_numpy().astype(float)
    weight = drawn["n"].to_numpy().astype(float)
    for label, r in totals.items():     # the sample of a label stands for all its rows
        weight[y == label] *= r["rows"] / weight[y == label].sum()
    weight *= len(y) / weight.sum()
    return fit_tables(np.array(drawn["x"].tolist()), y, weight)


def predict(measured: Column, model: AdditiveModel, spark) -> Column:
    """The probability of label 1 for a column of measures."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.score(np.array(batch.tolist()).reshape(len(batch), len(MEASURES))))
    return run(measured)
