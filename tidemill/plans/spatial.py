"""Spatial joins, shortest paths, travel times and the integrated table."""

from pyspark.sql import functions as F

from ..functions.dates import seconds_of_day
from ..operators import cleansing as C, graph as G, joins as J, ordering as O, spatial as S
from ..session import cut_lineage
from ..sources.tables import table
from .cleansing import BRANCH_PREFIX
from .joins import ABBREVIATIONS
from .registry import query


def _spread(key, a, b):
    """Fixed scattering of integer keys over [0, 1)."""
    return F.pmod(F.col(key) * a, F.lit(b)) / F.lit(float(b))


def customer_points(spark, sf):
    return table(spark, sf, "customer").select(
        "*", (_spread("c_custkey", 7919, 10007) + 144).alias("lon"), (_spread("c_custkey", 104729, 10009) - 38).alias("lat"))


def supplier_points(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", (_spread("s_suppkey", 6151, 9973) + 144).alias("s_lon"), (_spread("s_suppkey", 3571, 9967) - 38).alias("s_lat"))


_POINTS_SQL = """
    c AS (SELECT *, (c_custkey * 7919 % 10007) / 10007.0::DOUBLE + 144 AS lon, (c_custkey * 104729 % 10009) / 10009.0::DOUBLE - 38 AS lat FROM customer),
    s AS (SELECT s_suppkey, (s_suppkey * 6151 % 9973) / 9973.0::DOUBLE + 144 AS s_lon, (s_suppkey * 3571 % 9967) / 9967.0::DOUBLE - 38 AS s_lat FROM supplier)"""
_NEAREST_SQL = f"""{_POINTS_SQL},
    near AS (SELECT c_custkey, s_suppkey AS nearest, 2 * 6378000 * asin(sqrt(pow(sin(radians(s_lat - lat) / 2), 2)
                 + cos(radians(lat)) * cos(radians(s_lat)) * pow(sin(radians(s_lon - lon) / 2), 2))) AS m
             FROM c, s QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY m, s_suppkey) = 1)"""


@query("nearest_join", f"WITH {_NEAREST_SQL} SELECT c_custkey, nearest, round(m, 2) AS nearest_m FROM near")
def nearest_join(spark, sf):
    out = S.nearest_join(customer_points(spark, sf).select("c_custkey", "lon", "lat"), supplier_points(spark, sf),
                         ("lon", "lat"), ("s_lon", "s_lat"), "s_suppkey")
    return out.select("c_custkey", "nearest", F.round("nearest_m", 2).alias("nearest_m"))


def nation_polygons(spark, sf):
    """A five-cornered area per nation on a 5 x 5 grid; neighbours overlap a little."""
    x0 = F.lit(144.0) + (F.col("n_nationkey") % 5) * 0.2
    y0 = F.lit(-38.0) + F.floor(F.col("n_nationkey") / 5) * 0.2
    corners = [(0.0, 0.0), (0.21, 0.01), (0.19, 0.15), (0.1, 0.23), (0.02, 0.14)]
    ring = F.array(*[F.struct((x0 + dx).alias("lon"), (y0 + dy).alias("lat")) for dx, dy in corners])
    return table(spark, sf, "nation").select("n_nationkey", "n_name", ring.alias("ring"))


_AREA_SQL = """
    corner AS (SELECT unnest([0, 1, 2, 3, 4]) AS i, unnest([0.0, 0.21, 0.19, 0.1, 0.02])::DOUBLE AS dx, unnest([0.0, 0.01, 0.15, 0.23, 0.14])::DOUBLE AS dy),
    pt AS (SELECT n_nationkey, n_name, i, 144.0::DOUBLE + (n_nationkey % 5) * 0.2::DOUBLE + dx AS x, -38.0::DOUBLE + (n_nationkey // 5) * 0.2::DOUBLE + dy AS y
           FROM nation, corner),
    edge AS (SELECT a.n_nationkey, a.n_name, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM pt a JOIN pt b
             ON a.n_nationkey = b.n_nationkey AND b.i = (a.i + 1) % 5),
    hit AS (SELECT c_custkey, n_nationkey, n_name FROM c, edge
            WHERE (y1 > lat) <> (y2 > lat) AND lon < x1 + (x2 - x1) * (lat - y1) / (y2 - y1)
            GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1),
    area AS (SELECT c_custkey, arg_min(n_name, n_nationkey) AS area FROM hit GROUP BY 1)"""


@query("point_in_polygon", f"""WITH {_POINTS_SQL}, {_AREA_SQL}
    SELECT c.c_custkey, coalesce(area, 'not available') AS area FROM c LEFT JOIN area ON c.c_custkey = area.c_custkey""")
def point_in_polygon(spark, sf):
    out = S.point_in_polygon(customer_points(spark, sf).select("c_custkey", "lon", "lat"), nation_polygons(spark, sf),
                             ("lon", "lat"), "n_nationkey", "ring", "n_name")
    return out.select("c_custkey", "area")


_PATHS_SQL = """
    pairs AS (SELECT l_suppkey AS s, -1 - l_partkey AS p, CAST(min(l_quantity) AS BIGINT) AS w FROM lineitem GROUP BY 1, 2),
    e AS (SELECT s AS u, p AS v, w FROM pairs UNION ALL SELECT p, s, w FROM pairs),
    d(source, node, distance) USING KEY (source, node) AS (
        SELECT source, source, CAST(0 AS BIGINT) FROM start
        UNION (SELECT d.source, e.v, min(d.distance + e.w) FROM d JOIN e ON d.node = e.u
               LEFT JOIN recurring.d r ON r.source = d.source AND r.node = e.v
               WHERE r.distance IS NULL OR d.distance + e.w < r.distance GROUP BY 1, 2))"""


def road_edges(spark, sf):
    """Roads between suppliers and the parts they have sent, as long as the smallest quantity."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", (-F.col("l_partkey") - 1).alias("p"), "l_quantity")
    return G.undirected(lines, "l_suppkey", "p", "l_quantity").withColumn("w", F.col("w").cast("bigint"))


@query("shortest_paths", f"""
    WITH RECURSIVE start AS (SELECT min(s_suppkey) AS source FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey), {_PATHS_SQL}
    SELECT source, node, distance FROM d""")
def shortest_paths(spark, sf):
    starts = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")) \
        .groupBy("n_regionkey").agg(F.min("s_suppkey").alias("source")).select("source")
    return G.shortest_paths(road_edges(spark, sf), starts)


_BRANCH_SQL = """
    d AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 29 > 0 THEN list_value('NK', 'TP', 'BK')[CAST(o_orderkey % 3 + 1 AS INT)] END AS code,
                 CASE WHEN o_custkey % 31 > 0 AND o_orderkey % 7 <> 1 THEN round((o_custkey % 977) / 7.0, 3) END AS km, o_orderkey % 4 = 0 AS loyal, o_totalprice AS fee FROM orders)"""


@query("impute_by_rule", f"""
    WITH RECURSIVE b AS (SELECT s_suppkey, list_value('NK', 'TP', 'BK')[row_number() OVER (ORDER BY s_suppkey)] AS branch FROM supplier ORDER BY s_suppkey LIMIT 3),
    start AS (SELECT s_suppkey AS source FROM b), {_PATHS_SQL.replace(' d(', ' path(').replace('FROM d ', 'FROM path ').replace('d.', 'path.').replace('recurring.path.', 'recurring.path').replace('recurring.d', 'recurring.path')},
    {_NEAREST_SQL}, {_BRANCH_SQL},
    whole AS (SELECT o_orderkey, d.code, coalesce(km, round(distance / 10.0, 3)) AS km, loyal, fee FROM d LEFT JOIN b ON b.branch = d.code
              LEFT JOIN near ON near.c_custkey = d.o_custkey LEFT JOIN path ON path.source = b.s_suppkey AND path.node = near.nearest),
    m AS (SELECT code, regr_slope(fee, km) AS a, regr_intercept(fee, km) AS b FROM whole WHERE o_orderkey % 13 <> 6 GROUP BY 1)
    SELECT o_orderkey, whole.code, km, CASE WHEN o_orderkey % 13 <> 6 THEN fee
        ELSE round((a * km + b) / CASE WHEN loyal THEN 2 ELSE 1 END, 4) END AS fee FROM whole JOIN m ON whole.code IS NOT DISTINCT FROM m.code""")
def impute_by_rule(spark, sf):
    """The code from the order's id, the distance from the road graph, the fee from the branch's model, in this order."""
    km = F.when(F.col("o_custkey") % 31 > 0, F.round((F.col("o_custkey") % 977) / F.lit(7.0), 3))
    gaps = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.expr("concat(if(o_orderkey % 29 > 0, 'ORD', 'ODD'), element_at(array('A', 'B', 'C'), cast(o_orderkey % 3 + 1 as int)), o_orderkey)").alias("order_id"),
        F.expr("if(o_orderkey % 5 = 2 or o_orderkey % 29 = 0, null, element_at(array('NK', 'TP', 'BK'), cast(o_orderkey % 3 + 1 as int)))").alias("code"),
        F.when(F.col("o_orderkey") % 7 != 1, km).alias("km"), (F.col("o_orderkey") % 4 == 0).alias("loyal"),
        F.when(F.col("o_orderkey") % 13 != 6, F.col("o_totalprice")).alias("fee"))
    coded = C.repair_code(gaps, "order_id", "code", BRANCH_PREFIX)
    hubs = [r[0] for r in table(spark, sf, "supplier").orderBy("s_suppkey").limit(3).select("s_suppkey").collect()]
    branch = F.when(F.col("code") == "NK", hubs[0]).when(F.col("code") == "TP", hubs[1]).when(F.col("code") == "BK", hubs[2])
    paths = G.shortest_paths(road_edges(spark, sf), spark.createDataFrame([(h,) for h in hubs], "source long"))
    near = S.nearest_join(customer_points(spark, sf).select("c_custkey", "lon", "lat"), supplier_points(spark, sf),
                          ("lon", "lat"), ("s_lon", "s_lat"), "s_suppkey")
    near = cut_lineage(near.select(F.col("c_custkey").alias("o_custkey"), "nearest"))
    # the road to each branch is looked up once per place, not once per order
    places = near.select("nearest").distinct().withColumn("hub", F.explode(F.array(*[F.lit(h).cast("long") for h in dict.fromkeys(hubs)])))
    roads = G.with_distance(places.dropna(), paths, "hub", "nearest").groupBy("nearest") \
        .agg(F.map_from_entries(F.collect_list(F.struct("hub", "distance"))).alias("roads"))
    placed = coded.withColumn("hub", branch).join(near.join(roads, "nearest", "left"), "o_custkey", "left")
    routed = placed.withColumn("distance", F.try_element_at("roads", "hub"))
    filled = C.impute_by_rule(routed, {"km": F.round(F.col("distance") / F.lit(10.0), 3)})
    whole = cut_lineage(filled.select("o_orderkey", "code", "km", "loyal", "fee"))
    model = C.group_linear_fit(whole, ["code"], ["km"], "fee")
    scored = C.predict_linear(whole, model, ["code"], ["km"])
    fee = F.round(F.col("pred") / F.when(F.col("loyal"), 2).otherwise(1), 4)
    return C.impute_by_rule(scored, {"fee": fee}).select("o_orderkey", "code", "km", "fee")


_TRAVEL_SQL = """
    t AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, event_id, ts,
                 hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT) AS sec FROM events),
    hub AS (SELECT user_id, day, sec AS arrive FROM t WHERE event_type = 'purchase'
            QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) = 1),
    leave AS (SELECT user_id, day, event_type, sec AS leave FROM t
              QUALIFY row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts, event_id) = 1),
    ride AS (SELECT event_type, round(avg((arrive - leave) / 60.0), 4) AS minutes, count(*) AS n_trips
             FROM leave JOIN hub USING (user_id, day) WHERE leave BETWEEN 25200 AND 34200 AND arrive >= leave GROUP BY 1)"""


def _travel(spark, sf):
    stops = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", "event_id", "ts",
                                              seconds_of_day(F.col("ts")).alias("sec"))
    out = G.travel_time(stops, ["user_id", "day"], "event_type", ["ts", "event_id"], "sec", "sec", ["purchase"])
    return out.withColumn("minutes", F.round("minutes", 4))


@query("travel_time_to_hub", f"WITH {_TRAVEL_SQL} SELECT event_type, minutes, n_trips FROM ride")
def travel_time_to_hub(spark, sf):
    return _travel(spark, sf)


def _school_ranks(spark, sf):
    """(nation, school_rank): a ranking whose names are spelled out, matched to abbreviated school names."""
    nation = table(spark, sf, "nation")
    schools = nation.select(F.col("n_name").alias("nation"), F.concat("n_name", F.lit(" Sec Coll")).alias("name"))
    ranking = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("school_rank")) \
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .select(F.concat("n_name", F.lit(" Secondary College")).alias("name"), "school_rank")
    matched = J.reconcile_names(schools, ranking, "name", ABBREVIATIONS).select("name", "match")
    found = matched.join(ranking.withColumnRenamed("name", "match"), "match").select("name", "school_rank")
    return schools.join(found, "name").select("nation", "school_rank")


@query("integrated_table", f"""WITH {_NEAREST_SQL}, {_AREA_SQL}, {_TRAVEL_SQL},
    first_kind AS (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1),
    yearly AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    before AS (SELECT a.c_nationkey, round(avg(b.n), 6) AS crime_mean FROM yearly a JOIN yearly b
               ON a.c_nationkey = b.c_nationkey AND b.y BETWEEN a.y - 3 AND a.y - 1 WHERE a.y = 1999 GROUP BY 1 HAVING count(*) = 3),
    med AS (SELECT c_mktsegment, c_nationkey, median(c_acctbal) AS med FROM customer GROUP BY 1, 2)
    SELECT c.c_custkey, coalesce(area, 'not available') AS area, nearest, round(m, 2) AS nearest_m,
           coalesce(ride.minutes, -1) AS minutes, CASE WHEN c_acctbal > med THEN 1 ELSE 0 END AS above_median,
           coalesce(crime_mean, -1) AS crime_mean, coalesce(n_name, 'not available') AS nation,
           coalesce(school_rank, -1) AS school_rank
    FROM c LEFT JOIN area ON c.c_custkey = area.c_custkey JOIN near ON c.c_custkey = near.c_custkey
    JOIN med ON c.c_mktsegment = med.c_mktsegment AND c.c_nationkey = med.c_nationkey
    LEFT JOIN first_kind f ON f.user_id = c.c_custkey LEFT JOIN ride ON ride.event_type = f.event_type
    LEFT JOIN before ON before.c_nationkey = c.c_nationkey LEFT JOIN nation ON c.c_nationkey = n_nationkey
    LEFT JOIN (SELECT s_nationkey, count(*) AS school_rank FROM supplier GROUP BY 1) k ON k.s_nationkey = c.c_nationkey""")
def integrated_table(spark, sf):
    points = customer_points(spark, sf)
    out = S.point_in_polygon(points, nation_polygons(spark, sf), ("lon", "lat"), "n_nationkey", "ring", "n_name")
    out = S.nearest_join(out, supplier_points(spark, sf), ("lon", "lat"), ("s_lon", "s_lat"), "s_suppkey")
    stops = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    kinds = O.first_per_key(stops, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type")
    minutes = kinds.join(_travel(spark, sf), "event_type").select(F.col("user_id").alias("c_custkey"), "minutes")
    out = out.join(minutes, "c_custkey", "left")
    out = J.above_group_median(out, ["c_mktsegment", "c_nationkey"], "c_acctbal")
    yearly = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n")) \
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    before = J.trailing_mean(yearly, ["c_nationkey"], "y", "n", 3, "crime_mean").where("y = 1999") \
        .select("c_nationkey", F.round("crime_mean", 6).alias("crime_mean"))
    out = out.join(before, "c_nationkey", "left")
    out = J.lookup(out, "c_nationkey", table(spark, sf, "nation"), "n_nationkey", "n_name", "nation", F.lit("not available"))
    out = out.join(_school_ranks(spark, sf), "nation", "left")
    return out.select("c_custkey", "area", "nearest", F.round("nearest_m", 2).alias("nearest_m"),
                      F.coalesce("school_rank", F.lit(-1)).alias("school_rank"), F.coalesce("minutes", F.lit(-1.0)).alias("minutes"), "above_median",
                      F.coalesce("crime_mean", F.lit(-1.0)).alias("crime_mean"), "nation")
