"""Grouped statistics."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.ordering import medians
from ..sources.tables import table
from .ordering import document_words
from .registry import query

# Lower edges of the score bands.
SCORE_EDGES = [0, 1, 10, 100, 500, 1000, 2000]


@query("daily_stats", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(sum(value), 3) AS total, round(avg(value), 3) AS mean,
           round(stddev_samp(value), 3) AS std, round(max(value), 3) AS maximum, round(min(value), 3) AS minimum
    FROM events GROUP BY 1 ORDER BY 1""")
def daily_stats(spark, sf):
    return A.daily_stats(table(spark, sf, "events"), "ts", "value").withColumn("day", F.col("day").cast("string"))


@query("daily_stats_extremes", """
    SELECT CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_day, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_day,
           count(DISTINCT CAST(ts AS DATE)) AS n_days FROM events""")
def daily_stats_extremes(spark, sf):
    days = A.daily_stats(table(spark, sf, "events"), "ts", "value")
    return days.agg(F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"),
                    F.count("*").alias("n_days"))


@query("group_sum_sorted", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total
    FROM lineitem GROUP BY 1, 2 ORDER BY total DESC""")
def group_sum_sorted(spark, sf):
    return (A.reduce_by_key(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "n": F.count("*"), "total": F.round(F.sum("l_extendedprice"), 2)})
        .orderBy(F.desc("total"), "l_returnflag", "l_linestatus"))


@query("having_count", """
    SELECT c_custkey, c_name, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey
    GROUP BY 1, 2 HAVING count(*) > 14 ORDER BY 3 DESC, 1""")
def having_count(spark, sf):
    busy = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders")).where("n_orders > 14")
    return (busy.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select("c_custkey", "c_name", "n_orders").orderBy(F.desc("n_orders"), "c_custkey"))


@query("avg_difference", """
    SELECT p_type, p_brand, round(avg(CAST(l_extendedprice AS DECIMAL(18,2))) - avg(CAST(p_retailprice AS DECIMAL(18,2))), 4) AS differential
    FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2""")
def avg_difference(spark, sf):
    # lines shrink to one row per part first; both averages are then weighted by the line count
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    part = table(spark, sf, "part").withColumn("price", F.col("p_retailprice").cast("decimal(18,2)"))
    both = part.join(lines, F.col("p_partkey") == F.col("l_partkey"))
    mean = lambda total: F.sum(total).cast("double") / F.sum("n")
    return both.groupBy("p_type", "p_brand").agg(
        F.round(mean(F.col("s")) - mean(F.col("price") * F.col("n")), 4).alias("differential"))


@query("left_join_max_default", """
    SELECT p_type, p_brand, coalesce(s_name, '---') AS supplier,
           coalesce(CAST(CAST(max(l_quantity) AS INT) AS VARCHAR), '---') AS max_qty
    FROM part LEFT JOIN lineitem l ON p_partkey = l_partkey * 2
    LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""")
def left_join_max_default(spark, sf):
    top = (table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey")
           .agg(F.max("l_quantity").alias("q")))
    return (table(spark, sf, "part").join(top, F.col("p_partkey") == F.col("l_partkey") * 2, "left")
            .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .groupBy("p_type", "p_brand", F.coalesce("s_name", F.lit("---")).alias("supplier"))
            .agg(F.coalesce(F.max("q").cast("int").cast("string"), F.lit("---")).alias("max_qty")))


@query("distinct_groups", """
    SELECT count(*) AS n_groups FROM (SELECT DISTINCT user_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END
                                      FROM events)""")
def distinct_groups(spark, sf):
    kinds = table(spark, sf, "events").select("user_id", F.expr("if(event_id % 10 = 0, null, event_type)").alias("kind"))
    return kinds.distinct().agg(F.count("*").alias("n_groups"))


@query("share_pct", """
    SELECT round(100.0 * count(*) FILTER (WHERE event_type = 'error')
                 / count(*) FILTER (WHERE event_type IN ('error', 'click')), 2) AS error_share,
           round(100.0 * sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) / sum(value), 2) AS purchase_value_share
    FROM events""")
def share_pct(spark, sf):
    kind = F.col("event_type")
    return table(spark, sf, "events").agg(
        A.share_pct((kind == "error").cast("int"), kind.isin("error", "click").cast("int")).alias("error_share"),
        A.share_pct(F.when(kind == "purchase", F.col("value")).otherwise(0), F.col("value")).alias("purchase_value_share"))


@query("avg_occurrence", """
    SELECT lang, sum(n)::BIGINT AS total, count(*) AS n_distinct, round(sum(n) / count(*), 4) AS avg_occurrence
    FROM (SELECT lang, w, count(*) AS n
          FROM (SELECT lang, unnest(string_split(lower(regexp_replace(regexp_replace(text, '[\\r\\n]', ' ', 'g'), '[^A-Za-z ]', '', 'g')), ' ')) AS w FROM documents)
          WHERE w <> '' GROUP BY 1, 2) GROUP BY 1""")
def avg_occurrence(spark, sf):
    tokens = document_words(spark, sf, "lang")
    counts = tokens.groupBy("lang", "w").agg(F.count("*").alias("n"))
    return counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("n_distinct"),
                                      F.round(F.sum("n") / F.count("*"), 4).alias("avg_occurrence"))


@query("reduce_by_key_min", """
    SELECT l_suppkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high, sum(l_linenumber)::BIGINT AS lines,
           bool_or(l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1""")
def reduce_by_key_min(spark, sf):
    return A.reduce_by_key(table(spark, sf, "lineitem"), ["l_suppkey"], {
        "low": F.min("l_extendedprice"), "high": F.max("l_extendedprice"), "lines": F.sum("l_linenumber"),
        "returned": F.bool_or(F.col("l_returnflag") == "R")})


@query("item_quantity_by_type", """
    SELECT l_returnflag AS order_type, item, sum(qty)::BIGINT AS qty FROM (
        SELECT l_returnflag, 'part-' || (l_partkey % 12) AS item, CAST(l_quantity AS BIGINT) AS qty FROM lineitem
        UNION ALL SELECT l_returnflag, 'supp-' || (l_suppkey % 4), l_linenumber FROM lineitem) GROUP BY 1, 2""")
def item_quantity_by_type(spark, sf):
    items = F.expr("""array(named_struct('item', concat('part-', l_partkey % 12), 'qty', cast(l_quantity as bigint)),
                            named_struct('item', concat('supp-', l_suppkey % 4), 'qty', cast(l_linenumber as bigint)))""")
    nested = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("order_type"), items.alias("items"))
    return A.sum_items(nested, ["order_type"], "items")


@query("group_mean", """
    SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INT) AS y,
           round(avg(CAST(o_totalprice AS DECIMAL(18,2))), 3) AS mean_price FROM orders GROUP BY 1, 2, 3""")
def group_mean(spark, sf):
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count("*")
    return table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("y")) \
        .agg(F.round(mean, 3).alias("mean_price"))


@query("group_median", """
    SELECT o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, CAST(year(o_orderdate) AS INT) AS y,
           CAST(quarter(o_orderdate) AS INT) AS q, round(median(o_totalprice), 3) AS median_price
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def group_median(spark, sf):
    both = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    keys = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey", "y", "q"]
    out = medians(both.withColumns({"y": F.year("o_orderdate"), "q": F.quarter("o_orderdate")}), "o_totalprice", keys,
                  "median_price")
    return out.withColumn("median_price", F.round("median_price", 3))


@query("mode_value", """
    SELECT l_suppkey, mode, n FROM (
        SELECT l_suppkey, v AS mode, count(*) AS n,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, v) AS rn
        FROM (SELECT l_suppkey, CASE WHEN l_linenumber = 3 THEN 'NA' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS v
              FROM lineitem) WHERE v <> 'NA' GROUP BY 1, 2) WHERE rn = 1""")
def mode_value(spark, sf):
    dirty = table(spark, sf, "lineitem").select("l_suppkey", F.expr(
        "if(l_linenumber = 3, 'NA', cast(cast(l_quantity as int) as string))").alias("v"))
    return A.mode_value(dirty, "v", by=["l_suppkey"], ignore="NA")


@query("iqr_bounds", """
    SELECT event_type, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
           round(q3 + 1.5 * (q3 - q1), 6) AS upper
    FROM (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)""")
def iqr_bounds(spark, sf):
    out = A.iqr_bounds(table(spark, sf, "events"), "value", by=["event_type"])
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower", "upper")])


_DESCRIBE = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_numeric", " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           min({c}) AS minimum, max({c}) AS maximum, round(quantile_cont({c}, 0.25), 4) AS q1,
           round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3,
           count(DISTINCT {c}) AS n_distinct,
           (SELECT {c} FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
           (SELECT count(*) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM lineitem"""
                                           for c in _DESCRIBE))
def describe_numeric(spark, sf):
    out = A.describe_numeric(table(spark, sf, "lineitem"), _DESCRIBE)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q1", "median", "q3")})


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("correlation_matrix", "WITH d AS (SELECT * REPLACE (CASE WHEN l_partkey % 7 > 0 THEN l_quantity END AS l_quantity, "
       "CASE WHEN l_suppkey % 5 > 0 THEN l_discount END AS l_discount) FROM lineitem) " + " UNION ALL ".join(
           f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM d" for a in _CORR for b in _CORR))
def correlation_matrix(spark, sf):
    dirty = table(spark, sf, "lineitem").withColumns({
        "l_quantity": F.expr("if(l_partkey % 7 > 0, l_quantity, null)"), "l_discount": F.expr("if(l_suppkey % 5 > 0, l_discount, null)")})
    return A.correlation_matrix(dirty, _CORR)


@query("histogram_overflow", """
    WITH d AS (SELECT CASE WHEN doc_id % 7 > 0 THEN n_chars - 400 END AS x FROM documents)
    SELECT b.bin, count(d.x) AS n FROM (SELECT unnest(range(0, 11)) AS bin) b
    LEFT JOIN d ON x >= 0 AND least(x // 250, 10) = b.bin GROUP BY 1
    UNION ALL SELECT -1, count(*) FROM d WHERE x < 0 UNION ALL SELECT NULL, count(*) FROM d WHERE x IS NULL""")
def histogram_overflow(spark, sf):
    shifted = table(spark, sf, "documents").select(F.expr("if(doc_id % 7 > 0, n_chars - 400, null)").alias("x"))
    return A.histogram(shifted, "x", width=250, bins=11)


@query("score_bands", """
    SELECT b.band, count(s.score) AS n FROM (SELECT unnest(range(0, 7)) AS band) b LEFT JOIN (
        SELECT value * value / 10 AS score FROM events WHERE event_id % 6 > 0) s
    ON b.band = CASE WHEN score IS NULL THEN NULL WHEN score < 1 THEN 0 WHEN score < 10 THEN 1 WHEN score < 100 THEN 2 WHEN score < 500 THEN 3
                     WHEN score < 1000 THEN 4 WHEN score < 2000 THEN 5 ELSE 6 END GROUP BY 1
    UNION ALL SELECT CASE WHEN event_id % 6 > 0 THEN NULL ELSE -1 END, count(*) FROM events WHERE event_id % 6 = 0 GROUP BY 1""")
def score_bands(spark, sf):
    score = F.col("value") * F.col("value") / 10
    scored = table(spark, sf, "events").select(F.when(F.col("event_id") % 6 > 0, score).otherwise(-1.0).alias("score"))
    return A.band_counts(scored, "score", SCORE_EDGES)


@query("others_bucket", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
           CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'Others' END AS event_type,
           round(sum(value), 2) AS value FROM events GROUP BY 1, 2""")
def others_bucket(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    out = A.others_bucket(events, "event_type", "value", ["click", "view"], by=["day"])
    return out.withColumn("value", F.round("value", 2))


@query("valid_extent", """
    SELECT min(nullif(l_discount, 0)) AS low, max(l_discount) AS high FROM lineitem""")
def valid_extent(spark, sf):
    return A.valid_extent(table(spark, sf, "lineitem"), "l_discount")


@query("missing_counts", """
    WITH d AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS price,
                      CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE o_orderstatus END AS status,
                      o_orderpriority AS priority FROM orders)
    SELECT 'price' AS column_name, count(*) FILTER (WHERE price = 'NA') AS n_sentinel, count(*) FILTER (WHERE price IS NULL) AS n_null FROM d
    UNION ALL SELECT 'status', count(*) FILTER (WHERE status = 'NA'), count(*) FILTER (WHERE status IS NULL) FROM d
    UNION ALL SELECT 'priority', count(*) FILTER (WHERE priority = 'NA'), count(*) FILTER (WHERE priority IS NULL) FROM d""")
def missing_counts(spark, sf):
    dirty = table(spark, sf, "orders").select(
        F.expr("if(o_orderkey % 7 = 0, 'NA', cast(o_totalprice as string))").alias("price"),
        F.expr("case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then 'NA' else o_orderstatus end").alias("status"),
        F.col("o_orderpriority").alias("priority"))
    return A.missing_counts(dirty)


@query("try_cast_numeric", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders""")
def try_cast_numeric(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("if(o_orderkey % 7 = 0, 'NA', cast(o_totalprice as string))").alias("price"))
    return text.withColumn("price", F.col("price").try_cast("double"))


@query("validity_flags", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 4 AND o_orderkey % 100 BETWEEN 1 AND 75 THEN 1 ELSE 0 END AS valid
    FROM orders""")
def validity_flags(spark, sf):
    score = F.expr("if(o_orderkey % 9 = 4, concat('x', o_orderkey), cast(o_orderkey % 100 as string))")
    number = score.try_cast("int")
    ok = F.coalesce(number.between(1, 75), F.lit(False))
    return table(spark, sf, "orders").select("o_orderkey", F.when(ok, 1).otherwise(0).alias("valid"))
