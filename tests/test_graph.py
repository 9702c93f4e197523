from tests.conftest import rows
from tidemill.operators import graph as G


def test_shortest_paths_relax_every_edge(spark):
    import random
    random.seed(4)
    raw = [(random.randrange(40), random.randrange(40), random.randrange(1, 20)) for _ in range(120)] + [(0, i, 50) for i in range(1, 40)]
    edges = G.undirected(spark.createDataFrame(raw, "a long, b long, w long"), "a", "b", "w")
    out = rows(G.shortest_paths(edges, spark.createDataFrame([(0,), (7,)], "s long")))
    dist = {(s, n): d for s, n, d in out}
    assert dist[0, 0] == 0 and dist[0, 7] == dist[7, 0]
    for u, v, w in edges.collect():
        for s in (0, 7):
            assert dist[s, v] <= dist[s, u] + w


def test_unreachable_nodes_are_absent(spark):
    edges = G.undirected(spark.createDataFrame([(1, 2, 5), (3, 4, 1)], "a long, b long, w long"), "a", "b", "w")
    assert rows(G.shortest_paths(edges, spark.createDataFrame([(1,)], "s long")), "node") == [(1, 1, 0), (1, 2, 5)]


def test_travel_time(spark):
    data = [("t1", "A", 7 * 3600, 1), ("t1", "A", 7 * 3600 + 60, 2), ("t1", "HUB", 8 * 3600, 3), ("t1", "B", 8 * 3600 + 5, 4),
            ("t2", "A", 9 * 3600 + 1800, 1), ("t2", "HUB", 10 * 3600, 2), ("t3", "A", 9 * 3600 + 1801, 1), ("t3", "HUB", 10 * 3600, 2)]
    df = spark.createDataFrame(data, "trip string, stop string, sec int, seq int")
    out = G.travel_time(df, ["trip"], "stop", ["seq"], "sec", "sec", ["HUB"])
    assert rows(out, "stop") == [("A", 45.0, 2), ("HUB", 0.0, 1)]


def test_loops_keep_few_stages(spark):
    import os
    from tidemill.session import shared_dir

    def stages():
        return {f for f in os.listdir(shared_dir(spark)) if f.startswith("stage")}
    before = stages()
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(12)], "u long, v long, w double")
    far = G.shortest_paths(edges, spark.createDataFrame([(0,)], "s long"))
    assert {r["node"]: r["distance"] for r in far.collect()} == {i: float(i) for i in range(13)}
    assert len(stages() - before) == 2


def grid(spark, side):
    """A grid of roads with light and heavy weights, and its distances by Dijkstra's algorithm."""
    import heapq
    import random
    rng = random.Random(side)
    raw = []
    for x in range(side):
        for y in range(side):
            raw += [((x * side + y), (x + dx) * side + y + dy, rng.choice([1, 1, 2, 9, 40])) for dx, dy in ((1, 0), (0, 1)) if x + dx < side and y + dy < side]
    near = {}
    for u, v, w in raw:
        near.setdefault(u, []).append((v, w))
        near.setdefault(v, []).append((u, w))
    want = {}
    for s in (0, side * side - 1):
        todo = [(0, s)]
        while todo:
            d, u = heapq.heappop(todo)
            if (s, u) not in want:
                want[s, u] = d
                for v, w in near[u]:
                    heapq.heappush(todo, (d + w, v))
    return G.undirected(spark.createDataFrame(raw, "a long, b long, w long"), "a", "b", "w"), spark.createDataFrame([(0,), (side * side - 1,)], "s long"), want


def test_buckets_of_any_width_give_the_same(spark):
    edges, sources, want = grid(spark, 5)
    for delta in (None, 1000.0):
        got = {(r.source, r.node): r.distance for r in G.shortest_paths(edges, sources, delta=delta).collect()}
        assert got == want


def test_rounds_write_only_what_they_improve(spark, monkeypatch):
    edges, sources, want = grid(spark, 5)
    written, cut = [], G.cut_lineage

    def watched(df):
        stage = cut(df)
        if stage.columns == ["source", "node", "d"]:
            written.append(stage.count())
        return stage
    monkeypatch.setattr(G, "cut_lineage", watched)
    paths = G.shortest_paths(edges, sources)
    assert paths.count() == len(want)
    # a round that rewrote the state would write all pairs each time
    assert len(written) > 6 and sum(written) < 6 * len(want)


def plans_of_rounds(monkeypatch):
    """The plans of the rounds that shortest_paths runs from now on."""
    plans, cut = [], G.cut_lineage

    def watched(df):
        if df.columns == ["source", "node", "d"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(G, "cut_lineage", watched)
    return plans


def test_edges_are_not_shuffled_in_a_round(spark, monkeypatch):
    edges, sources, want = grid(spark, 4)
    plans = plans_of_rounds(monkeypatch)
    monkeypatch.setattr(G, "BROADCAST_NODES", 0, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {(r.source, r.node): r.distance for r in G.shortest_paths(edges, sources).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
    assert any("hashpartitioning(node#" in p for p in plans) and not any("hashpartitioning(u#" in p for p in plans)


def test_heavy_edges_wait_until_light_ones_are_done(spark, monkeypatch):
    # a chain of light edges with heavy short cuts that never help: buckets of distance would follow them from each bucket
    raw = [(i, i + 1, 1) for i in range(6)] + [(i, i + 2, 60) for i in range(5)]
    edges = G.undirected(spark.createDataFrame(raw, "a long, b long, w long"), "a", "b", "w")
    plans = plans_of_rounds(monkeypatch)
    paths = G.shortest_paths(edges, spark.createDataFrame([(0,)], "s long"), delta=2.0)
    assert {r["node"]: r["distance"] for r in paths.collect()} == {i: i for i in range(7)}
    rounds = [p for p in plans if "Join" in p]
    assert len(rounds) == 8     # six along the chain, one that improves nothing, one over the heavy edges


def test_undirected_edges_are_grouped_once(spark, sf):
    from tidemill.plans import spatial as P
    raw = [(1, 2, 5), (2, 1, 3), (1, 2, 4), (3, 3, 1), (None, 4, 2), (4, None, 7), (None, None, 6), (5, 6, None)]
    edges = G.undirected(spark.createDataFrame(raw, "a long, b long, w long"), "a", "b", "w")
    assert sorted(rows(edges), key=str) == sorted([(1, 2, 3), (2, 1, 3), (3, 3, 1), (None, 4, 2), (4, None, 2), (None, None, 6),
                                                   (5, 6, None), (6, 5, None)], key=str)
    assert P.road_edges(spark, sf)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_weights_of_zero_are_refused_and_no_edges_leave_the_sources(spark):
    import pytest
    with pytest.raises(ValueError, match="positive"):
        G.shortest_paths(spark.createDataFrame([(1, 2, 0)], "u long, v long, w long"), spark.createDataFrame([(1,)], "s long"))
    none = spark.createDataFrame([], "u long, v long, w double")
    assert rows(G.shortest_paths(none, spark.createDataFrame([(1,)], "s long"))) == [(1, 1, 0.0)]


def test_distances_are_attached(spark):
    paths = spark.createDataFrame([(1, 1, 0), (1, 2, 5)], "source long, node long, distance long")
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 9), ("c", None, 2)], "k string, s long, n long")
    assert rows(G.with_distance(df, paths, "s", "n"), "k") == [("a", 1, 2, 5), ("b", 1, 9, None), ("c", None, 2, None)]


def test_roads_are_looked_up_per_place_and_not_per_order(spark, sf, monkeypatch):
    from tidemill.plans import spatial as P
    asked, attach = [], G.with_distance

    def watched(df, *args):
        asked.append(df.count())
        return attach(df, *args)
    monkeypatch.setattr(G, "with_distance", watched)
    written, cut = [], P.cut_lineage

    def kept(df):
        written.append(df.columns)
        return cut(df)
    monkeypatch.setattr(P, "cut_lineage", kept)
    out = P.impute_by_rule(spark, sf)
    assert out.count() == P.table(spark, sf, "orders").count()
    assert 0 < asked[0] <= 3 * P.table(spark, sf, "supplier").count()
    assert written[-1] == ["o_orderkey", "code", "km", "loyal", "fee"]
