"""Filters and joins."""

from pyspark.sql import functions as F

from ..operators import joins as J, reshape as R
from ..sources.tables import table
from .registry import query

# Abbreviations spelled out when names are compared.
ABBREVIATIONS = {"Sec": "Secondary", "Coll": "College"}


@query("project_rename", """
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_extendedprice AS price, l_quantity AS qty FROM lineitem""")
def project_rename(spark, sf):
    return (table(spark, sf, "lineitem").drop("l_tax", "l_discount")
            .withColumnsRenamed({"l_orderkey": "order_id", "l_linenumber": "line", "l_extendedprice": "price",
                                 "l_quantity": "qty"}).select("order_id", "line", "price", "qty"))


@query("filter_agg", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem
    WHERE l_linestatus <> 'F' AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
      AND l_quantity BETWEEN 5 AND 40 GROUP BY 1""")
def filter_agg(spark, sf):
    return (table(spark, sf, "lineitem").where(F.col("l_linestatus") != "F")
            .where((F.col("l_shipdate") >= F.expr("timestamp_ntz'1996-01-01'"))
                   & (F.col("l_shipdate") < F.expr("timestamp_ntz'1998-01-01'")))
            .where(F.col("l_quantity").between(5, 40))
            .groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")))


@query("not_null_filter", """
    SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NOT NULL""")
def not_null_filter(spark, sf):
    return (table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
            .where(F.col("quality").isNotNull()))


@query("like_filter", """
    SELECT p_partkey, p_name, p_type FROM part WHERE lower(p_name) LIKE '%ring%' AND upper(p_type) = 'PROMO'""")
def like_filter(spark, sf):
    return (table(spark, sf, "part").where(F.lower("p_name").like("%ring%") & (F.upper("p_type") == "PROMO"))
            .select("p_partkey", "p_name", "p_type"))


@query("orders_on_day", """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%d-%b-%Y %H:%M') AS placed FROM orders
    WHERE strftime(o_orderdate, '%d-%b-%Y') = '14-Mar-1997'""")
def orders_on_day(spark, sf):
    day = table(spark, sf, "orders").where((F.col("o_orderdate") >= F.expr("timestamp_ntz'1997-03-14'"))
                                           & (F.col("o_orderdate") < F.expr("timestamp_ntz'1997-03-15'")))
    return day.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "dd-MMM-yyyy HH:mm").alias("placed"))


@query("flag_sum_filter", """
    SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE (c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))::INT + (c_acctbal > 0)::INT
        + (o_totalprice > 50000)::INT + (o_orderstatus <> 'P')::INT + (o_orderpriority <> '5-LOW')::INT = 5""")
def flag_sum_filter(spark, sf):
    both = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return R.flag_sum_filter(both, [
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), F.col("c_acctbal") > 0,
        F.col("o_totalprice") > 50000, F.col("o_orderstatus") != "P", F.col("o_orderpriority") != "5-LOW",
    ]).select("o_orderkey")


@query("dropna_rows", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE (CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END) IS NOT NULL
      AND (CASE WHEN o_orderkey % 11 = 3 THEN NULL ELSE o_orderpriority END) IS NOT NULL""")
def dropna_rows(spark, sf):
    dirty = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("if(o_orderkey % 7 = 0, null, o_totalprice)").alias("o_totalprice"),
        F.expr("if(o_orderkey % 11 = 3, null, o_orderpriority)").alias("priority"))
    return dirty.dropna(subset=["o_totalprice", "priority"]).select("o_orderkey", "o_totalprice")


@query("valid_pair_filter", """
    SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
    WHERE l_discount <> 0 AND (CASE WHEN l_tax = 0.03 THEN NULL ELSE l_tax END) IS NOT NULL""")
def valid_pair_filter(spark, sf):
    gaps = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", F.nullif("l_tax", F.lit(0.03)).alias("l_tax"))
    return gaps.where((F.col("l_discount") != 0) & F.col("l_tax").isNotNull())


@query("join_inner_3way", """
    SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def join_inner_3way(spark, sf):
    # orders shrink to one row per customer before the joins
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return (per_customer.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("n").alias("n_orders"), F.round(F.sum("total"), 2).alias("total")))


@query("left_join_chain", """
    SELECT p.p_partkey, p.p_name, coalesce(l.l_orderkey, -1) AS l_orderkey, coalesce(l.l_linenumber, -1) AS l_linenumber,
           coalesce(s.s_name, 'not available') AS s_name, n.n_name
    FROM part p LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey * 2
    LEFT JOIN supplier s ON l.l_suppkey * 2 = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def left_join_chain(spark, sf):
    lines = table(spark, sf, "lineitem")
    return (table(spark, sf, "part").join(lines, F.col("p_partkey") == F.col("l_partkey") * 2, "left")
            .join(table(spark, sf, "supplier"), F.col("l_suppkey") * 2 == F.col("s_suppkey"), "left")
            .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select("p_partkey", "p_name", F.coalesce("l_orderkey", F.lit(-1)).alias("l_orderkey"),
                    F.coalesce("l_linenumber", F.lit(-1)).alias("l_linenumber"),
                    F.coalesce("s_name", F.lit("not available")).alias("s_name"), "n_name"))


@query("merge_on_names", """
    SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def merge_on_names(spark, sf):
    return (table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", "s_name", "n_name", "r_name"))


@query("align_series", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (WHERE event_type = 'click') AS clicks,
           count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'error') AS errors,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY 1""")
def align_series(spark, sf):
    # the series are aligned by their day, not by position: one pivot instead of a four-way join
    names = {"click": "clicks", "view": "views", "error": "errors", "purchase": "purchases"}
    daily = table(spark, sf, "events").groupBy(F.col("ts").cast("date").cast("string").alias("day"))
    return daily.agg(*[F.count_if(F.col("event_type") == k).alias(n) for k, n in names.items()])


@query("semi_join_chain", """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
              SELECT c_custkey FROM customer WHERE c_nationkey IN (
                  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')))
      AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0
                        INTERSECT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')""")
def semi_join_chain(spark, sf):
    t = lambda n: table(spark, sf, n)
    nations = J.keep_members(t("nation"), "n_regionkey", t("region").where("r_name = 'ASIA'"), "r_regionkey")
    customers = J.keep_members(t("customer"), "c_nationkey", nations, "n_nationkey")
    orders = J.keep_members(t("orders"), "o_custkey", customers, "c_custkey")
    suppliers = (t("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("k"))
                 .intersect(t("lineitem").where("l_returnflag = 'R'").select("l_suppkey")))
    lines = J.keep_members(t("lineitem"), "l_suppkey", suppliers, "k")
    return J.keep_members(lines, "l_orderkey", orders, "o_orderkey").select("l_orderkey", "l_linenumber")


@query("unmatched_keys", """
    WITH a AS (SELECT DISTINCT l_partkey * 3 AS key FROM lineitem),
         b AS (SELECT p_partkey * 2 AS key FROM part)
    SELECT key, 'left' AS side FROM a WHERE key NOT IN (SELECT key FROM b)
    UNION ALL SELECT key, 'right' FROM b WHERE key NOT IN (SELECT key FROM a)""")
def unmatched_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_partkey") * 3).alias("l_partkey"))
    parts = table(spark, sf, "part").select((F.col("p_partkey") * 2).alias("p_partkey"))
    return J.unmatched_keys(lines, parts, "l_partkey", "p_partkey")


@query("scalar_subquery_eq", """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier
    WHERE s_nationkey = (SELECT n_nationkey FROM nation WHERE upper(n_name) = 'NATION_7')""")
def scalar_subquery_eq(spark, sf):
    return spark.sql("""
        SELECT s_suppkey, s_name, s_acctbal FROM {supplier}
        WHERE s_nationkey = (SELECT n_nationkey FROM {nation} WHERE upper(n_name) = 'NATION_7')""",
                     supplier=table(spark, sf, "supplier"), nation=table(spark, sf, "nation"))


@query("below_average", """
    SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice < (SELECT avg(p_retailprice) FROM part)""")
def below_average(spark, sf):
    part = table(spark, sf, "part")
    mean = part.agg(F.avg("p_retailprice")).scalar()
    return part.where(F.col("p_retailprice") < mean).select("p_partkey", "p_name", "p_retailprice")


@query("lookup_with_default", """
    SELECT e.event_id, coalesce(c.c_name, 'user ' || e.user_id) AS owner,
           coalesce(c.c_mktsegment, 'not available') AS segment
    FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey * 2""")
def lookup_with_default(spark, sf):
    known = table(spark, sf, "customer").withColumn("c_custkey", F.col("c_custkey") * 2)
    named = J.lookup(table(spark, sf, "events"), "user_id", known, "c_custkey", "c_name", "owner",
                     F.concat(F.lit("user "), F.col("user_id").cast("string")))
    return (J.lookup(named, "user_id", known, "c_custkey", "c_mktsegment", "segment", F.lit("not available"))
            .select("event_id", "owner", "segment"))


@query("rounded_key_join", """
    WITH places AS (SELECT s_suppkey, (s_suppkey * 37 % 1000) / 10.0 - 37.0000001 AS lat,
                           (s_suppkey * 91 % 1000) / 10.0 + 144.0000004 AS lon FROM supplier),
         marks AS (SELECT l_orderkey, l_linenumber, (l_suppkey * 37 % 1000) / 10.0 - 37.0000001 + 0.00000001 AS lat,
                          (l_suppkey * 91 % 1000) / 10.0 + 144.0000004 - 0.00000001 AS lon FROM lineitem)
    SELECT m.l_orderkey, m.l_linenumber, p.place FROM marks m LEFT JOIN (
        SELECT CAST(round(lat, 7) AS DECIMAL(18,7)) AS a, CAST(round(lon, 7) AS DECIMAL(18,7)) AS b,
               min(s_suppkey) AS place FROM places GROUP BY 1, 2) p
    ON CAST(round(m.lat, 7) AS DECIMAL(18,7)) = p.a AND CAST(round(m.lon, 7) AS DECIMAL(18,7)) = p.b""")
def rounded_key_join(spark, sf):
    lat = lambda k: (F.col(k) * 37 % 1000) / 10.0 - 37.0000001
    lon = lambda k: (F.col(k) * 91 % 1000) / 10.0 + 144.0000004
    places = table(spark, sf, "supplier").select("s_suppkey", lat("s_suppkey").alias("lat"), lon("s_suppkey").alias("lon"))
    marks = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (lat("l_suppkey") + 0.00000001).alias("lat"),
        (lon("l_suppkey") - 0.00000001).alias("lon"))
    out = J.match_rounded(marks, places, [("lat", "lat"), ("lon", "lon")], "s_suppkey", "place")
    return out.select("l_orderkey", "l_linenumber", "place")


@query("name_reconcile", """
    WITH loc AS (SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN c_mktsegment || ' ' || c_nationkey || ' Secondary College'
                     WHEN 1 THEN c_mktsegment || ' ' || c_nationkey || '''s School'
                     WHEN 2 THEN 'O''' || c_mktsegment || ' ' || c_nationkey WHEN 3 THEN 'St ' || c_mktsegment || ' & ' || c_nationkey
                     ELSE c_mktsegment || c_nationkey || ' Hall' END AS name FROM customer),
         ranking AS (SELECT DISTINCT CASE WHEN c_nationkey % 4 = 1 THEN 'Unlisted ' || c_custkey ELSE CASE c_custkey % 6 WHEN 0 THEN c_mktsegment || ' ' || c_nationkey || ' Sec Coll'
                     WHEN 1 THEN c_mktsegment || ' ' || c_nationkey || ' School'
                     WHEN 2 THEN 'O' || c_mktsegment || ' ' || c_nationkey WHEN 3 THEN 'St ' || c_mktsegment || ' &amp; ' || c_nationkey
                     WHEN 4 THEN c_mktsegment || ' ' || c_nationkey || ' Hall'
                     ELSE 'St ' || c_mktsegment || ' & ' || c_nationkey END END AS name FROM customer),
         lf AS (SELECT name, replace(name, '&amp;', '&') AS f FROM loc),
         rf AS (SELECT name, replace(name, '&amp;', '&') AS f FROM ranking),
         spell AS (SELECT name, f, array_to_string(list_transform(string_split(f, ' '), lambda w: CASE w WHEN 'Sec' THEN 'Secondary' WHEN 'Coll' THEN 'College' ELSE w END), ' ') AS g FROM lf),
         spellr AS (SELECT name, f, array_to_string(list_transform(string_split(f, ' '), lambda w: CASE w WHEN 'Sec' THEN 'Secondary' WHEN 'Coll' THEN 'College' ELSE w END), ' ') AS g FROM rf),
         hits AS (SELECT l.name, 0 AS rule, r.name AS cand FROM lf l JOIN rf r ON l.f = r.f
            UNION ALL SELECT l.name, 1, r.name FROM lf l JOIN rf r ON replace(l.f, '''s', '') = r.f
            UNION ALL SELECT l.name, 2, r.name FROM lf l JOIN rf r ON replace(l.f, '''', '') = r.f
            UNION ALL SELECT l.name, 3, r.name FROM lf l JOIN rf r ON replace(l.f, ' ', '') = replace(r.f, ' ', '')
            UNION ALL SELECT l.name, 4, r.name FROM spell l JOIN spellr r ON l.g = r.g),
         best AS (SELECT name, rule, min(cand) AS cand FROM hits GROUP BY 1, 2
                  QUALIFY row_number() OVER (PARTITION BY name ORDER BY rule) = 1)
    SELECT loc.name, best.cand AS match, coalesce(best.rule, -1) AS rule FROM loc LEFT JOIN best ON loc.name = best.name""")
def name_reconcile(spark, sf):
    customers = table(spark, sf, "customer")
    loc = customers.select(F.expr("""
        CASE c_custkey % 5 WHEN 0 THEN c_mktsegment || ' ' || c_nationkey || ' Secondary College'
             WHEN 1 THEN c_mktsegment || ' ' || c_nationkey || "'s School"
             WHEN 2 THEN "O'" || c_mktsegment || ' ' || c_nationkey
             WHEN 3 THEN 'St ' || c_mktsegment || ' & ' || c_nationkey
             ELSE c_mktsegment || c_nationkey || ' Hall' END""").alias("name"))
    ranking = customers.select(F.expr("""
        CASE WHEN c_nationkey % 4 = 1 THEN 'Unlisted ' || c_custkey ELSE CASE c_custkey % 6 WHEN 0 THEN c_mktsegment || ' ' || c_nationkey || ' Sec Coll'
             WHEN 1 THEN c_mktsegment || ' ' || c_nationkey || ' School'
             WHEN 2 THEN 'O' || c_mktsegment || ' ' || c_nationkey
             WHEN 3 THEN 'St ' || c_mktsegment || ' &amp; ' || c_nationkey
             WHEN 4 THEN c_mktsegment || ' ' || c_nationkey || ' Hall'
             ELSE 'St ' || c_mktsegment || ' & ' || c_nationkey END END""").alias("name"))
    return J.reconcile_names(loc, ranking, "name", ABBREVIATIONS).fillna(-1, ["rule"])


@query("above_group_median", """
    WITH d AS (SELECT * REPLACE (CASE WHEN o_custkey % 9 > 0 THEN o_orderpriority END AS o_orderpriority,
                                 CASE WHEN o_custkey % 14 > 0 THEN o_totalprice END AS o_totalprice) FROM orders)
    SELECT o_orderkey, CAST(CASE WHEN o_totalprice > median(o_totalprice) OVER (
               PARTITION BY o_orderstatus, o_orderpriority, year(o_orderdate)) THEN 1 ELSE 0 END AS INT) AS above_median
    FROM d""")
def above_group_median(spark, sf):
    orders = table(spark, sf, "orders").withColumns({
        "y": F.year("o_orderdate"), "o_orderpriority": F.expr("if(o_custkey % 9 > 0, o_orderpriority, null)"),
        "o_totalprice": F.expr("if(o_custkey % 14 > 0, o_totalprice, null)")})
    return (J.above_group_median(orders, ["o_orderstatus", "o_orderpriority", "y"], "o_totalprice")
            .select("o_orderkey", "above_median"))


@query("trailing_3y_avg", """
    WITH yearly AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n
                    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT a.c_nationkey, a.y, a.n, CASE WHEN count(b.n) = 3 THEN round(avg(b.n), 6) END AS mean_before
    FROM yearly a LEFT JOIN yearly b ON a.c_nationkey = b.c_nationkey AND b.y BETWEEN a.y - 3 AND a.y - 1
    GROUP BY 1, 2, 3""")
def trailing_3y_avg(spark, sf):
    placed = (table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y"))
              .agg(F.count("*").alias("n"))
              .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")))
    out = J.trailing_mean(placed, ["c_nationkey"], "y", "n", 3, "mean_before")
    return out.withColumn("mean_before", F.round("mean_before", 6))
