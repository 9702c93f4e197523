"""Exact k-nearest-neighbour joins.

No pair of rows is ever materialised: tasks compare blocks of vectors and emit at most
k matches per query. Three plans give the same result, chosen by checked sizes:

* the searched side is small: every task holds it and answers its own queries;
* the query side is small: every task holds the queries and keeps a local top k, merged afterwards;
* both are large: the searched rows are split into cells around pivots, a query visits only the
  cells that the triangle inequality cannot rule out, and large cells are split into slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage, spread

SMALL_SIDE_NUMBERS = 4_000_000   # vector components one task may hold of a shared side
BLOCK_ROWS = 20_000              # rows of one cell slice
TILE_NUMBERS = 1_000_000         # components or distances a task works on at a time
TILE_ROWS, TILE_COLUMNS = 8, 4096    # distances that are summed in the processor's cache
LOW_DIM = 8                      # up to here most cells can be ruled out
LOW_DIM_ROWS = 20_000


def _sums(a: np.ndarray, b: np.ndarray, metric: str, out: np.ndarray) -> None:
    """Sums of the absolute or squared differences of all pairs into ``out``; ``a`` and ``b`` have a row per component.

    The components are added in order, so that a sum does not depend on the tile.
    """
    if a.shape[1] > b.shape[1]:
        a, b, out = b, a, out.T
    rows = max(TILE_ROWS, TILE_ROWS * TILE_COLUMNS // max(1, b.shape[1]))
    total, part = (np.empty((min(rows, a.shape[1]), min(TILE_COLUMNS, b.shape[1])), dtype=out.dtype) for _ in range(2))
    for i in range(0, a.shape[1], rows):
        for j in range(0, b.shape[1], TILE_COLUMNS):
            tile = out[i:i + rows, j:j + TILE_COLUMNS]
            sums, x = total[:tile.shape[0], :tile.shape[1]], part[:tile.shape[0], :tile.shape[1]]
            sums[:] = 0
            for u, v in zip(a[:, i:i + rows], b[:, j:j + TILE_COLUMNS], strict=True):
                np.subtract(u[:, None], v, out=x)
                if metric == "l1":
                    np.abs(x, out=x)
                else:
                    np.multiply(x, x, out=x)
                np.add(sums, x, out=sums)
            tile[:] = sums


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between two blocks, tiled so that memory stays bounded."""
    out = np.empty((len(a), len(b)))
    _sums(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T), metric, out)
    return out if metric == "l1" else np.sqrt(out, out=out)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors])


class _Block:
    """Rows to search, in id order and a row per component.

    For the L1 metric there is a second copy on a grid of 16-bit numbers. A component on the grid is off by half a step, so sums over
    the grid, which take a fraction of the time, tell which rows can't be among the nearest. The others are compared exactly.
    """

    def __init__(self, rid: np.ndarray, rmat: np.ndarray, metric: str):
        by_id = np.argsort(rid, kind="stable")
        self.rid, self.metric, self.grid = rid[by_id], metric, None
        self.columns = np.ascontiguousarray(rmat[by_id].T) if len(rid) else np.empty((0, 0))
        dim = len(self.columns)
        steps = 32767 // max(1, dim) - 1
        if metric == "l1" and dim and steps > 1 and np.isfinite(self.columns).all():
            self.low, self.high = float(self.columns.min()), float(self.columns.max())
            self.step = (self.high - self.low) / steps
            if 0 < self.step < np.inf and self.low + self.step > self.low and self.high - self.step < self.high:
                self.grid = self._on_grid(self.columns)

    def _on_grid(self, columns: np.ndarray) -> np.ndarray:
        # beyond the rows' range a query is equally much farther from all of them
        return np.stack([np.rint((np.clip(c, self.low, self.high) - self.low) / self.step).astype(np.int16) for c in columns])

    def nearest(self, qid: np.ndarray, qmat: np.ndarray, k: int, exclude_self: bool) -> Iterator[pd.DataFrame]:
        """The k nearest rows of every query, ties by id; queries are taken in bounded slabs."""
        slab = max(1, 2 * TILE_NUMBERS // max(1, len(self.rid)))
        for i in range(0, len(qid) if len(self.rid) else 0, slab):
            ids = qid[i:i + slab]
            rows, cols, val = self._candidates(np.ascontiguousarray(qmat[i:i + slab].T), ids, k, exclude_self)
            order = np.lexsort((cols, val, rows))
            rows, cols, val = rows[order], cols[order], val[order]
            start = np.searchsorted(rows, np.arange(len(ids)))
            keep = (np.arange(len(rows)) - start[rows] < k) & np.isfinite(val)
            yield pd.DataFrame({"qid": ids[rows[keep]], "rid": self.rid[cols[keep]], "dist": val[keep]})

    def _candidates(self, queries: np.ndarray, ids: np.ndarray, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and distances of all pairs that may be among the nearest."""
        own = ids[:, None] == self.rid[None, :] if exclude_self else None
        m = min(k, len(self.rid))
        if self.grid is not None and m < len(self.rid) and np.isfinite(queries).all():
            near = np.empty((len(ids), len(self.rid)), dtype=np.int16)
            _sums(self._on_grid(queries), self.grid, "l1", near)
            if own is not None:
                near[own] = 32767
            # each sum is off by at most a step a component, and one more for rounding
            limit = np.minimum(np.partition(near, m - 1, axis=1)[:, m - 1:m].astype(np.int32) + 2 * len(queries) + 2, 32767).astype(np.int16)
            rows, cols = np.nonzero(near <= limit)
            if len(rows) <= near.size // 8 + m * len(ids):
                val = np.zeros(len(rows))
                for q, r in zip(queries, self.columns, strict=True):
                    val += np.abs(q[rows] - r[cols])
                if own is not None:
                    val[own[rows, cols]] = np.inf
                return rows, cols, val
        d = np.empty((len(ids), len(self.rid)))
        _sums(queries, self.columns, self.metric, d)
        if self.metric != "l1":
            np.sqrt(d, out=d)
        if own is not None:
            d[own] = np.inf
        # every row at or below the k-th distance stays until ties are broken by id
        rows, cols = np.nonzero(d <= np.partition(d, m - 1, axis=1)[:, m - 1:m] if m < len(self.rid) else np.isfinite(d))
        return rows, cols, d[rows, cols]


def _nearest(qid, qmat, rid, rmat, k: int, metric: str, exclude_self: bool) -> pd.DataFrame:
    parts = list(_Block(rid, rmat, metric).nearest(qid, qmat, k, exclude_self))
    return pd.concat(parts) if parts else pd.DataFrame({"qid": qid[:0], "rid": rid[:0], "dist": np.empty(0)})


def knn_join(queries: DataFrame, rows: DataFrame, k: int, metric: str = "l2", exclude_self: bool = False,
             small_side: int = SMALL_SIDE_NUMBERS, block: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """The ``k`` nearest of ``rows`` for each of ``queries``, both given as (id, vector) columns.

    Returns (qid, rid, dist, rank); ties are broken by the smaller id. ``exclude_self``
    skips rows with the query's own id, for leave-one-out. No queries or no rows give no result rows.
    """
    queries = queries.toDF("qid", "qvec").withColumn("qvec", F.col("qvec").cast("array<double>"))
    rows = rows.toDF("rid", "rvec").withColumn("rvec", F.col("rvec").cast("array<double>"))
    out = (f"qid {queries.schema['qid'].dataType.simpleString()}, "
           f"rid {rows.schema['rid'].dataType.simpleString()}, dist double")
    first = rows.select(F.size("rvec")).first()
    if first is None:
        return queries.sparkSession.createDataFrame([], f"{out}, rank int")
    limit = max(1, small_side // max(1, first[0]))
    if first[0] <= LOW_DIM:
        limit = min(limit, LOW_DIM_ROWS)     # beyond this, ruling out cells beats comparing everything
    if rows.limit(limit + 1).count() <= limit:
        found = _search_small_rows(queries, rows, k, metric, exclude_self, out)
    elif queries.limit(limit // max(1, k) + 1).count() <= limit // max(1, k):
        found = _search_small_queries(queries, rows, k, metric, exclude_self, out)
    else:
        found = _search_cells(queries, rows, k, metric, exclude_self, out, block, pivots)
    window = Window.partitionBy("qid").orderBy("dist", "rid")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _search_small_rows(queries, rows, k, metric, exclude_self, out):
    held = rows.toPandas()
    shared = queries.sparkSession.sparkContext.broadcast((held["rid"].to_numpy(), _matrix(held["rvec"])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = None
        for pdf in batches:
            block = block or _Block(*shared.value, metric)
            if len(pdf):
                yield from block.nearest(pdf["qid"].to_numpy(), _matrix(pdf["qvec"]), k, exclude_self)

    return spread(queries, "qid").mapInPandas(search, out)


def _search_small_queries(queries, rows, k, metric, exclude_self, out):
    held = queries.toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((held["qid"].to_numpy(), _matrix(held["qvec"])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qid, qmat = shared.value
        best = None
        for pdf in batches:
            if not len(pdf) or not len(qid):
                continue
            found = _nearest(qid, qmat, pdf["rid"].to_numpy(), _matrix(pdf["rvec"]), k, metric, exclude_self)
            best = found if best is None else pd.concat([best, found])
            best = best.sort_values(["qid", "dist", "rid"]).groupby("qid", sort=False).head(k)
        if best is not None:
            yield best

    return rows.mapInPandas(search, out)


def _pivots(rows: DataFrame, block: int, count: int | None) -> np.ndarray:
    """Cell centres, drawn by id hash.

    In few dimensions bounds rule out most cells, so many small ones pay (about the square
    root of the rows). In many dimensions a query visits most cells, so there are only as many as blocks.
    """
    if count is None:
        n, dim = rows.agg(F.count("*"), F.max(F.size("rvec"))).first()
        count = int(min(4096, max(8, n ** 0.5 if dim <= LOW_DIM else n / block)))
    return _matrix(rows.orderBy(F.xxhash64("rid"), "rid").limit(count).toPandas()["rvec"])


def _slabs(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that a slab times ``width`` numbers stays bounded."""
    step = max(1, TILE_NUMBERS // max(1, width))
    for pdf in batches:
        for i in range(0, len(pdf), step):
            yield pdf.iloc[i:i + step].reset_index(drop=True)


def _search_cells(queries, rows, k, metric, exclude_self, out, block, pivots):
    qtype, rtype = (f.dataType.simpleString() for f in (queries.schema["qid"], rows.schema["rid"]))
    need = k + 1 if exclude_self else k
    centres = _pivots(rows, block, pivots)

    def to_cells(batches):
        for pdf in _slabs(batches, len(centres)):
            d = distances(_matrix(pdf["rvec"]), centres, metric)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell, reach=d[np.arange(len(d)), cell])

    placed = cut_lineage(rows.mapInPandas(to_cells, f"rid {rtype}, rvec array<double>, cell bigint, reach double"))
    sizes = {r["cell"]: (r["n"], r["r"]) for r in
             placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("r")).collect()}
    inner = Window.partitionBy("cell").orderBy("reach")
    nearest = {}
    for r in (placed.select("cell", "reach").withColumn("rn", F.row_number().over(inner))
              .where(F.col("rn") <= need).collect()):          # at most pivots * (k + 1) numbers
        nearest.setdefault(r["cell"], []).append(r["reach"])
    cells = np.array(sorted(sizes))
    radius = np.array([sizes[c][1] for c in cells])
    close = np.full((len(cells), need), np.inf)
    for i, c in enumerate(cells):
        close[i, :len(nearest[c])] = sorted(nearest[c])
    kept = centres[cells]

    def route(batches):
        for pdf in _slabs(batches, len(cells) * need):
            d = distances(_matrix(pdf["qvec"]), kept, metric)
            # the need-th smallest upper bound over all cells is a bound on the k-th distance
            upper = (d[:, :, None] + close[None, :, :]).reshape(len(d), -1)
            bound = np.partition(upper, need - 1, axis=1)[:, need - 1:need] if upper.shape[1] >= need \
                else np.full((len(d), 1), np.inf)
            slack = 1e-9 * (1 + d)
            qi, ci = np.nonzero(d - radius[None, :] - slack <= bound)
            yield pd.DataFrame({"qid": pdf["qid"].to_numpy()[qi], "qvec": pdf["qvec"].to_numpy()[qi], "cell": cells[ci]})

    routed = cut_lineage(queries.mapInPandas(route, f"qid {qtype}, qvec array<double>, cell bigint"))
    visits = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    slices = {int(c): -(-sizes[c][0] // block) for c in sizes}
    query_slices = {int(c): -(-visits.get(c, 1) // block) for c in sizes}
    lookup = lambda m: F.create_map(*[F.lit(x).cast("bigint") for kv in m.items() for x in kv])[F.col("cell")]
    spread = lambda m: F.explode(F.sequence(F.lit(0).cast("bigint"), lookup(m) - 1))
    own = lambda key, m: F.pmod(F.xxhash64(key), lookup(m))
    right = placed.select("cell", "rid", "rvec", own("rid", slices).alias("s"), spread(query_slices).alias("t"))
    left = routed.select("cell", "qid", "qvec", own("qid", query_slices).alias("t"), spread(slices).alias("s"))

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"qid": q["qid"][:0], "rid": r["rid"][:0], "dist": np.empty(0)})
        return _nearest(q["qid"].to_numpy(), _matrix(q["qvec"]), r["rid"].to_numpy(), _matrix(r["rvec"]),
                        k, metric, exclude_self)

    keys = ["cell", "s", "t"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, out)


def knn_predictions(neighbours: DataFrame, rows: DataFrame, row_id: str, y: str, ks: list[int],
                    vote: str = "mean") -> DataFrame:
    """Predictions of all ``ks`` from neighbours ranked once, as rows (qid, k, pred).

    The mean is a running average over the ranks; a vote takes the most frequent
    label among the first k, the smallest on ties. Each query has at most max(ks) rows.
    """
    labelled = neighbours.join(rows.select(F.col(row_id).alias("rid"), F.col(y).alias("y")), "rid")
    if vote == "mean":
        running = F.avg("y").over(Window.partitionBy("qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
        return (labelled.withColumn("pred", running).where(F.col("rank").isin(*ks))
                .select("qid", F.col("rank").cast("bigint").alias("k"), "pred"))
    spread = labelled.withColumn("k", F.explode(F.filter(
        F.array(*[F.lit(k).cast("bigint") for k in ks]), lambda v: v >= F.col("rank"))))
    votes = spread.groupBy("qid", "k", "y").agg(F.count("*").alias("n"))
    best = votes.groupBy("qid", "k").agg(F.min(F.struct((-F.col("n")).alias("neg"), "y")).alias("b"))
    return best.select("qid", "k", F.col("b.y").alias("pred"))


def knn_cv(df: DataFrame, id_col: str, vec: str, y: str, ks: list[int], folds: int | None = None,
           metric: str = "l1") -> DataFrame:
    """Squared error per k by leave-one-out (``folds=None``) or contiguous folds.

    Rows left over by an uneven division belong to the last fold.
    """
    from .ordering import global_index
    points = df.select(id_col, vec)
    if folds is None:
        found = knn_join(points, points, max(ks), metric, exclude_self=True)
    else:
        n = df.count()
        placed = global_index(df.select(id_col, vec), [id_col], "_i").withColumn(
            "_fold", F.least(F.floor(F.col("_i") / max(1, n // folds)), F.lit(folds - 1)))
        found = None
        for f in range(folds):
            part = knn_join(placed.where(F.col("_fold") == f).select(id_col, vec),
                            placed.where(F.col("_fold") != f).select(id_col, vec), max(ks), metric)
            found = part if found is None else found.unionByName(part)
    preds = knn_predictions(found, df, id_col, y, ks)
    truth = df.select(F.col(id_col).alias("qid"), F.col(y).alias("truth"))
    err = F.pow(F.col("pred") - F.col("truth"), 2)
    return preds.join(truth, "qid").groupBy("k").agg(F.avg(err).alias("mse"), F.count("*").alias("n"))
