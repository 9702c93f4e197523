"""Shortest paths and travel times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import bucketed_stage, cut_lineage, drop_stage


BROADCAST_NODES = 20_000


def undirected(edges: DataFrame, u: str, v: str, weight: str) -> DataFrame:
    """Both directions of every edge as (u, v, w), the lightest of parallel edges.

    The two directions of a pair are grouped as one and written out afterwards, so edges are shuffled once.
    """
    one, other = F.col(u), F.col(v)
    lesser, greater = F.least(one, other), F.when(one.isNotNull() & other.isNotNull(), F.greatest(one, other))
    pairs = edges.select(lesser.alias("a"), greater.alias("b"), F.col(weight).alias("w")).groupBy("a", "b").agg(F.min("w").alias("w"))
    forth, back = F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    ways = F.when(F.col("a").eqNullSafe(F.col("b")), F.array(forth)).otherwise(F.array(forth, back))
    return pairs.select(F.explode(ways).alias("e"), "w").select("e.u", "e.v", "w")


def _least(stages: list[DataFrame]) -> DataFrame:
    """The smallest d of each (source, node) in some stages."""
    log = reduce(DataFrame.unionByName, stages)
    return log if len(stages) == 1 else log.groupBy("source", "node").agg(F.min("d").alias("d"))


class _Distances:
    """Best distances so far as a log of improvements in the shared folder: a round writes the rows it improves and nothing else.

    A row is (source, node, d); the smallest d of a (source, node) counts. ``settled`` are the stages before the last
    look at heavy edges, ``recent`` those since. When the improvements outgrow the rows they improve, both but the last
    round are merged to one row each, so reading the log stays proportional to the state.
    """

    def __init__(self, start: DataFrame):
        self.settled, self.recent, self.rows, self.fresh = [], [cut_lineage(start)], 0, 0
        self.kind = self.recent[0].schema["d"].dataType

    def merged(self, stages: list[DataFrame]) -> list[DataFrame]:
        if len(stages) < 2:
            return stages
        one = cut_lineage(_least(stages))
        for stage in stages:
            drop_stage(stage)
        return [one]

    def relax(self, nodes: DataFrame, n_nodes: int, edges: DataFrame) -> tuple[DataFrame, int]:
        """Follow edges from nodes, ``n_nodes`` rows, and add what improves; these rows and their number.

        The edges stay in their buckets: few nodes are broadcast, more are dealt out to them.
        """
        unknown = F.lit(None).cast(self.kind)
        side = F.broadcast(nodes) if n_nodes <= BROADCAST_NODES else nodes.hint("shuffle_hash")
        found = side.join(edges, F.col("node") == F.col("u")).select("source", F.col("v").alias("node"), (F.col("d") + F.col("w")).cast(self.kind).alias("d"))
        both = found.withColumn("_before", unknown)
        for stage in self.settled + self.recent:
            both = both.unionByName(stage.select("source", "node", unknown.alias("d"), F.col("d").alias("_before")))
        least = both.groupBy("source", "node").agg(F.min("d").alias("d"), F.min("_before").alias("_before"))
        better = least.where(F.col("d").isNotNull() & (F.col("_before").isNull() | (F.col("d") < F.col("_before"))))
        stage = cut_lineage(better.drop("_before"))
        n = stage.count()
        self.fresh += n
        if self.fresh > 2 * max(self.rows, n):
            self.settled, self.recent = self.merged(self.settled), self.merged(self.recent)
            self.rows, self.fresh = sum(old.count() for old in self.settled + self.recent), 0
        self.recent.append(stage)
        return stage, n

    def settle(self) -> tuple[DataFrame, int]:
        """The rows improved since the last call, with their number."""
        self.recent = self.merged(self.recent)
        since = self.recent[0]
        self.settled, self.recent = self.settled + self.recent, []
        return since, since.count()


def shortest_paths(edges: DataFrame, sources: DataFrame, max_rounds: int = 1000, delta: float | None = None) -> DataFrame:
    """Shortest weighted distance from every source to every reachable node, as (source, node, distance).

    ``edges`` is (u, v, w) with positive weights, ``sources`` one column of a few nodes. All sources at once, light
    edges first, as in delta-stepping: edges lighter than ``delta`` (a quarter of the mean weight by default) are followed from the
    nodes improved in the round before until nothing improves; then the heavier edges of all nodes improved since
    the last time are followed once, and so on until these improve nothing either. So the many heavy edges are seen
    with distances that are nearly final, and again only from nodes that were improved. A round writes only the rows it
    improves. Edges are written once, dealt out by ``u``, and not shuffled in a round. Running out of rounds is an
    error, not a partial answer.
    """
    weight = edges.schema["w"].dataType
    edges = bucketed_stage(edges.select("u", "v", "w").repartition("u"), "u")
    mean, least = edges.agg(F.avg("w"), F.min("w")).first()
    if least is not None and least <= 0:
        raise ValueError("weights must be positive")
    width = 1.0 if least is None else float(delta or max(float(least), float(mean) / 4))
    light, heavy = edges.where(F.col("w") < width), edges.where(F.col("w") >= width)
    any_light = least is not None and float(least) < width
    start = sources.toDF("source").distinct()
    known = _Distances(start.select("source", F.col("source").alias("node"), F.lit(0).cast(weight).alias("d")))
    moved, n_moved = known.recent[0], known.recent[0].count()
    for _ in range(max_rounds):
        if any_light and n_moved:
            moved, n_moved = known.relax(moved, n_moved, light)
            continue
        moved, n_moved = known.relax(*known.settle(), heavy)
        if not n_moved:
            return known.merged(known.settled + known.recent)[0].select("source", "node", F.col("d").alias("distance"))
    raise RuntimeError(f"paths still improve after {max_rounds} rounds")


def with_distance(df: DataFrame, paths: DataFrame, source: str, node: str, name: str = "distance") -> DataFrame:
    """Attach the distance between two node columns from ``shortest_paths`` rows; NULL where there is no path or node."""
    side = paths.select(F.col("source").alias("_s"), F.col("node").alias("_n"), F.col("distance").alias(name))
    return df.join(side, (F.col(source) == F.col("_s")) & (F.col(node) == F.col("_n")), "left").drop("_s", "_n")


def travel_time(stop_times: DataFrame, trip: Sequence[str], stop: str, order: Sequence[str], departure: str, arrival: str,
                hubs: Sequence, start: int = 7 * 3600, end: int = 9 * 3600 + 1800) -> DataFrame:
    """Mean minutes from each stop to the first hub arrival of the same trip, as (stop, minutes, n_trips).

    Times are seconds of day. A trip counts for a stop if its first departure there lies in
    ``[start, end]`` and the hub comes later; stops without such a trip are left out.
    """
    first = lambda value: F.min(F.struct(*order, F.col(value).alias("_t")))["_t"]
    at_hub = stop_times.where(F.col(stop).isin(*hubs)).groupBy(*trip).agg(first(arrival).alias("_arrive"))
    leaves = stop_times.groupBy(*trip, stop).agg(first(departure).alias("_leave")) \
        .where(F.col("_leave").between(start, end))
    rides = leaves.join(at_hub, list(trip)).where(F.col("_arrive") >= F.col("_leave"))
    return rides.groupBy(stop).agg(F.avg((F.col("_arrive") - F.col("_leave")) / 60).alias("minutes"),
                                   F.count("*").alias("n_trips"))
