"""Near duplicates by SimHash, linked through vantage-point trees.

Fingerprints that differ in at most ``max_bits`` bits agree on at least one of ``max_bits + 1`` blocks of bits, so
there is a forest of one tree per block whose first level is the Hamming distance 0 on that block: no pair
crosses it. Its second level are rings of distances to the tree's vantage point, ``max_bits + 1`` wide: by the
triangle inequality partners lie in the same ring or in the next one, so a fingerprint is stored in its own
ring and asks in the next when it is near enough to the boundary. Block and ring make the shard that is
shuffled. Inside, a vantage-point tree over all 64 bits finds the exact pairs: a branch is left out where the
triangle bound puts it beyond ``max_bits``.

Only distinct fingerprints travel, and a shard passes on links that join two of its components, never all
pairs, so large groups of copies or near copies cost no more rows than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, drop_stage
from .common import join_classes, packed

BITS = 64
SEED = 42
LEAF = 48               # points a tree compares directly
BLOCK_PAIRS = 1 << 20   # comparisons held at once
HASHES = 1 << 14        # shingle hashes counted at once


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bit by bit the majority of the XXH64 hashes of all word shingles; 0 without words."""
    words = (text or "").encode().lower().split()       # on bytes both touch ASCII only
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    xxh, votes = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, HASHES):
        hashes = np.array([xxh(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + HASHES], ends[at:at + HASHES], strict=True)], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
        for part in range(0, len(bits), 255):      # sums of 255 bits fit into bytes
            votes += bits[part:part + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(votes * 2 > n).view(">u8")[0])


def _fingerprints(shingle: int):
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))
    return prints


class Links:
    """Components of the points 0..n-1, built from arrays of linked pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            low = np.arange(len(self.label))
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while (low[low] != low).any():
                low = low[low]
            self.label = low[self.label]


def _compare(points: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, links: Links) -> None:
    """Link all pairs of ``a`` and ``b`` (places in ``points``) within the radius."""
    rows = max(1, BLOCK_PAIRS // max(1, len(b)))
    for at in range(0, len(a), rows):
        part = a[at:at + rows]
        x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[b][None, :]) <= radius)
        links.add(part[x], b[y])


def vantage_links(points: np.ndarray, places: np.ndarray, radius: int, links: Links) -> None:
    """Link all points within the radius of each other through a vantage-point tree, built as it is searched.

    Branches within one ball (self) and pairs of branches (cross) are kept on a stack. A pair of branches
    keeps just the points that the triangle bound leaves near the boundary between the two.
    """
    todo = [(places, None)]
    while todo:
        a, b = todo.pop()
        other = a if b is None else b
        if not len(a) or not len(other):
            continue
        if min(len(a), len(other)) <= LEAF:
            _compare(points, a, other, radius, links)
            continue
        vantage = points[a[0]]
        d = np.bitwise_count(points[a] ^ vantage).astype(np.int64)
        e = d if b is None else np.bitwise_count(points[other] ^ vantage).astype(np.int64)
        border = int(np.median(e))
        inner, outer = e <= border, e > border
        if b is None:
            if not outer.any():
                border -= 1
                inner, outer = e <= border, e > border
            if not inner.any():
                _compare(points, a, a, radius, links)
                continue
            todo += [(a[inner], None), (a[outer], None),
                     (a[inner & (d > border - radius)], a[outer & (d <= border + radius)])]
            continue
        near, far = d <= border + radius, d > border - radius
        if near.sum() * inner.sum() + far.sum() * outer.sum() > 0.8 * len(a) * len(other):
            _compare(points, a, other, radius, links)
        else:
            todo += [(a[near], other[inner]), (a[far], other[outer])]


def _shard_links(radius: int):
    """mapInPandas over (shard, fp) sorted by shard: links between fingerprints, one per joined component."""
    def links_of(shard: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        points, links = fp.view(np.uint64), Links(len(fp))
        starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        sizes = np.diff(np.append(starts, len(shard)))
        small = np.repeat(sizes <= LEAF, sizes)
        found = []
        for step in range(1, LEAF):         # neighbours at this distance, in all small shards at once
            a = np.flatnonzero(small[:-step] & (shard[:-step] == shard[step:]))
            if not len(a):
                break
            a = a[np.bitwise_count(points[a] ^ points[a + step]) <= radius]
            if len(a):
                found.append((a, a + step))
        if found:
            links.add(*map(np.concatenate, zip(*found, strict=True)))
        for start, size in zip(starts, sizes, strict=True):
            if size > LEAF:
                vantage_links(points, np.arange(start, start + size), radius, links)
        joined = np.flatnonzero((links.label != np.arange(len(fp))) & (fp != fp[links.label]))
        return pd.DataFrame({"a": fp[joined], "b": fp[links.label[joined]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards, prints = [], []     # from the first row of the shard that may go on
        for batch in batches:
            shards.append(batch["shard"].to_numpy())
            prints.append(batch["fp"].to_numpy())
            if shards[0][0] != shards[-1][-1]:
                shard, fp = np.concatenate(shards), np.concatenate(prints)
                cut = int(np.searchsorted(shard, shard[-1]))
                yield links_of(shard[:cut], fp[:cut])
                shards, prints = [shard[cut:]], [fp[cut:]]
        if shards:
            yield links_of(np.concatenate(shards), np.concatenate(prints))
    return run


def _shards(fp: Column, radius: int) -> Column:
    """All shards of a fingerprint, as longs: for each block its own ring and, near the boundary, the next."""
    blocks, width, out = radius + 1, radius + 1, []
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        value = F.call_function("shiftrightunsigned", fp, F.lit(low)).bitwiseAND((1 << (high - low)) - 1)
        vantage = xxhash.xxh64_intdigest(str(i), SEED) - (1 << 63)
        distance = F.bit_count(fp.bitwiseXOR(F.lit(vantage)))
        ring = F.floor(distance / width)
        shard = value * (blocks * 128) + ring * blocks + i
        out += [shard, F.when(distance % width > width - 1 - radius, shard + blocks)]
    return F.filter(F.array(*out), lambda s: s.isNotNull())


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all within ``radius`` bits."""
    spread = prints.select("fp", F.explode(_shards(F.col("fp"), radius)).alias("shard"))
    return spread.repartition("shard").sortWithinPartitions("shard").mapInPandas(_shard_links(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the smallest node that is connected.

    Alternating star contractions: every node hands its larger neighbours, then its smaller ones, to the
    smallest. Each round is written to the shared folder; the one before it is not needed any more.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    known = stage = None
    while True:
        before, pairs = stage, cut_lineage(pairs)
        stage = pairs
        drop_stage(before)
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == known or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        known = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pairs = (small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``id, h, fp, best`` per row: ``best`` is the smallest ``(id is null, id, h)`` of the component."""
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                                   _fingerprints(shingle)(F.col(text_col)).alias("fp")))
    this = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    prints = cut_lineage(rows.groupBy("fp").agg(F.min(this).alias("first"), F.count("*").alias("n")))
    roots = components(links(prints, max_bits)).withColumnRenamed("node", "fp")
    rooted = cut_lineage(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"), F.count("*").alias("prints"))
    total = rooted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rooted = join_classes(rooted, best, "root", "prints", total[0]).select("fp", "n", "best")
    return join_classes(rows, cut_lineage(rooted), "fp", "n", total[1])


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, fingerprint`` (16 hex digits) and ``component_id``, its smallest id.

    Fingerprints at most ``max_bits`` apart are linked, components follow all links. Null, empty and blank texts
    have the fingerprint 0, which is linked like any other. A null id is never a component's id unless all
    of its ids are null. An empty table gives an empty result; repeated rows keep a row each.
    """
    rows = _grouped(docs, shingle, max_bits, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("best.id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: the smallest id of every component.

    Rows that repeat both id and text are one document and stay or go together.
    """
    rows = _grouped(docs, shingle, max_bits, id_col, text_col)
    kept = rows.filter(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("h") == F.col("best.h"))).select("id", "h").distinct()
    whole = docs.select(packed(docs), F.col(id_col).alias("i"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("x"))
    same = F.col("i").eqNullSafe(F.col("id")) & (F.col("x") == F.col("h"))
    return whole.join(kept, same, "left_semi").select("row.*")
