"""Exact top-k inner products over norm-sorted blocks, pruned by Cauchy-Schwarz bounds.

Vectors are scaled to integers, so scores are exact. They are sorted by descending length and packed into
blocks. An orthogonal rotation, from the singular vectors of the whole table, moves most of the length into
the first components. A block of queries meets a block of candidates:

1. Every query starts with the k-th best score within the longest vectors as its threshold.
2. A pair of blocks is left out when the product of their greatest lengths is below all thresholds; inside a
   block, candidates are visited by descending length until that bound ends the visit.
3. The partial sum over the first rotated components plus the product of the remaining lengths bounds the score;
   only pairs that reach the threshold are multiplied out in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 8192
QUERIES_AT_ONCE = 256
BLOCKS_PER_GROUP = 16       # candidate blocks one task holds
HEAD_SHARE = 0.7            # of the squared length, in the components summed first
SLACK = 1e-9                # relative error allowed to the rotated sums


def _integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``rid, id, v, norm`` of the vectors that take part; ``rid`` tells rows with the same id apart."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .filter(F.coalesce(finite, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), scaled.alias("v")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), dtype=np.int32)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _gram(dims: int):
    """mapInPandas: the sums of products of every two components, one row each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = _matrix(batch["v"].tolist(), dims).astype(float)
            total += m.T @ m
        i, j = np.divmod(np.arange(dims * dims), dims)
        yield pd.DataFrame({"i": i, "j": j, "x": total.ravel()})
    return run


def _rotation(rows: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """The orthogonal matrix of the right singular vectors, and how many components come first."""
    sums = rows.select("v").mapInPandas(_gram(dims), "i int, j int, x double").groupBy("i", "j").agg(F.sum("x"))
    gram = np.zeros((dims, dims))
    for i, j, x in sums.collect():      # dims * dims numbers
        gram[i, j] = x
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    share = np.cumsum(values[::-1]) / max(values.sum(), 1e-300)
    return vectors[:, ::-1].copy(), min(dims, int(np.searchsorted(share, HEAD_SHARE)) + 1)


def _packer(dims: int, size: int):
    """mapInPandas over rows sorted by descending length: blocks of ids and integer components."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"block": [part * 1_000_000 + seq], "longest": [float(rows["norm"].max())],
                                 "ids": [rows["id"].to_numpy(np.int64).tobytes()],
                                 "rids": [rows["rid"].to_numpy(np.int64).tobytes()],
                                 "data": [_matrix(rows["v"].tolist(), dims).tobytes()]})
        for batch in batches:
            held.append(batch)
            while sum(map(len, held)) >= size:
                rows = pd.concat(held, ignore_index=True)
                yield block(rows[:size])
                seq, held = seq + 1, [rows[size:]]
        rows = pd.concat(held, ignore_index=True) if held else ()
        if len(rows):
            yield block(rows)
    return run


def _packed(rows: DataFrame, dims: int, size: int) -> DataFrame:
    order = [F.col("norm").desc(), F.col("id"), F.col("rid")]
    ordered = rows.select("rid", "id", "norm", "v").repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInPandas(_packer(dims, size), "block long, longest double, ids binary, rids binary, data binary")


class Block:
    """A block of vectors with what the bounds need."""

    def __init__(self, ids: bytes, rids: bytes, data: bytes, rotation: np.ndarray, head: int):
        self.ids, self.rids = np.frombuffer(ids, dtype=np.int64), np.frombuffer(rids, dtype=np.int64)
        self.data = np.frombuffer(data, dtype=np.int32).astype(np.int64).reshape(len(self.ids), -1)
        turned = self.data.astype(float) @ rotation
        self.norms = np.sqrt((turned ** 2).sum(axis=1))
        self.first = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the best ``k`` pairs of each query: by score, then by smaller id."""
    order = np.lexsort((ids, -scores, query))
    sorted_query = query[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_query[1:] != sorted_query[:-1]]))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _search(queries: Block, least: np.ndarray, candidates: Block, k: int) -> tuple[np.ndarray, ...]:
    """Query places, candidate ids and scores of all pairs that reach ``least``, at most the best k a query."""
    found = [], [], []
    for at in range(0, len(queries.ids), QUERIES_AT_ONCE):
        part = slice(at, at + QUERIES_AT_ONCE)
        bound = least[part] - SLACK * (1 + np.abs(least[part]))
        longest = queries.norms[part].max()
        # lengths descend: the first candidate that no query of this part can need ends the visit
        visit = np.searchsorted(-candidates.norms, -bound.min() / longest, side="right") if longest > 0 and bound.min() > 0 \
            else len(candidates.ids)
        if not visit:
            continue
        reach = queries.first[part] @ candidates.first[:visit].T
        reach += queries.rest[part][:, None] * candidates.rest[None, :visit]
        slack = SLACK * queries.norms[part][:, None] * candidates.norms[None, :visit] + SLACK
        q, c = np.nonzero(reach + slack >= bound[:, None])
        own = queries.rids[q + at] != candidates.rids[c]
        q, c = q[own] + at, c[own]
        scores = np.concatenate([np.einsum("ij,ij->i", queries.data[q[i:i + 65536]], candidates.data[c[i:i + 65536]])
                                 for i in range(0, len(q), 65536)] or [np.empty(0, np.int64)])
        good = scores >= least[q]
        q, ids, scores = q[good], candidates.ids[c[good]], scores[good]
        if len(q):
            best = _best(q, ids, scores, k)
            for out, x in zip(found, (q, ids, scores), strict=True):
                out.append(x[best])
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in found)


def _least(queries: Block, part: slice, candidates: Block, k: int) -> np.ndarray:
    """A score that each query's k-th best candidate reaches at least; minus infinity with fewer than k."""
    scores = queries.data[part].astype(float) @ candidates.data.T.astype(float)
    scores -= SLACK * queries.norms[part][:, None] * candidates.norms[None, :] + SLACK
    scores[queries.rids[part][:, None] == candidates.rids[None, :]] = -np.inf
    if len(candidates.ids) < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, -k, axis=1)[:, -k]


def _thresholds(ids: bytes, rids: bytes, data: bytes, rotation: np.ndarray, head: int, k: int):
    """mapInPandas over query blocks: adds each query's k-th score within the longest vectors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longest = Block(ids, rids, data, rotation, head)
        for batch in batches:
            out = []
            for block in zip(batch["ids"], batch["rids"], batch["data"], strict=True):
                queries = Block(*block, rotation, head)
                least = np.concatenate([_least(queries, slice(at, at + QUERIES_AT_ONCE), longest, k)
                                        for at in range(0, len(queries.ids), QUERIES_AT_ONCE)])
                out.append((least.tobytes(), float(least.min())))
            yield batch.assign(least=[x for x, _ in out], lowest=[y for _, y in out])
    return run


def _met(rotation: np.ndarray, head: int, k: int):
    """cogroup: a group of candidate blocks with one query block."""
    def run(candidates: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(query) and len(candidates):
            queries = Block(query["ids"].iloc[0], query["rids"].iloc[0], query["data"].iloc[0], rotation, head)
            least = np.frombuffer(query["least"].iloc[0])
            for block in zip(candidates["ids"], candidates["rids"], candidates["data"], strict=True):
                q, found, scores = _search(queries, least, Block(*block, rotation, head), k)
                rows.append(pd.DataFrame({"query_row": queries.rids[q], "query_id": queries.ids[q], "vec_id": found, "score": scores}))
        return pd.concat(rows) if rows else pd.DataFrame({c: [] for c in ("query_row", "query_id", "vec_id", "score")}, dtype="int64")
    return run


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` best other vectors, ties to the smaller id.

    Components become ``floor(scale * x)``. Null vectors, vectors with a null, NaN or infinite component and null ids
    take no part. Rows with a repeated id are rows of their own: each is a candidate of all others, and each that is a query
    is answered. Shorter vectors are filled up with zeros. With fewer than ``k`` others all are returned; an empty table gives an
    empty result. Scaled vectors of length 2 ** 31 or more are an error, as scores might not fit in 64 bits.
    """
    rows = cut_lineage(_integers(vectors, id_col, vector_col, scale))
    n, dims, longest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.max("norm")).first()
    if longest is not None and longest >= 2.0 ** 31:
        raise ValueError(f"a scaled vector has the length {longest:g}; scores could exceed 64 bits from 2 ** 31 on")
    dims = max(dims, 1)
    rotation, head = _rotation(rows, dims) if n else (np.eye(dims), 1)
    blocks = cut_lineage(_packed(rows, dims, CANDIDATE_BLOCK))
    longest = blocks.orderBy(F.col("longest").desc(), "block").select("ids", "rids", "data").limit(1).collect()
    top = tuple(map(bytes, longest[0])) if longest else (b"", b"", b"")
    asked = rows.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    queries = cut_lineage(_packed(asked, dims, QUERY_BLOCK).mapInPandas(
        _thresholds(*top, rotation, head, k),
        "block long, longest double, ids binary, rids binary, data binary, least binary, lowest double"))
    # one entry per query block, to leave out whole pairs of blocks before they are shuffled
    known = queries.select("block", "longest", "lowest").collect()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-blocks.count() // BLOCKS_PER_GROUP), -(-2 * cores // max(1, len(known))))
    entries = F.array(*[F.struct(F.lit(b).cast("long").alias("query"), F.lit(x).alias("longest"),
                                 F.lit(low).cast("double").alias("lowest")) for b, x, low in known]) \
        if known else F.array().cast("array<struct<query:bigint,longest:double,lowest:double>>")
    needed = F.filter(entries, lambda e: F.col("longest") * e["longest"] * (1 + 1e-9) + 1e-9 >= e["lowest"])
    offered = blocks.select(F.explode(F.transform(needed, lambda e: e["query"])).alias("query"),
                            F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), "ids", "rids", "data")
    placed = queries.select(F.col("block").alias("query"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
                            "ids", "rids", "data", "least")
    pairs = offered.groupBy("query", "group").cogroup(placed.groupBy("query", "group")).applyInPandas(
        _met(rotation, head, k), "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
