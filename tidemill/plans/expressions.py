"""Scalar functions over strings, dates and numbers."""

from pyspark.sql import functions as F

from ..functions import dates as D, numeric as N, text as X
from ..sources.tables import table
from .registry import query

# Code -> label.
STATUS_LABELS = {"O": "open order", "F": "filled order", "P": "order in part"}


@query("string_basics", """
    SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low, c_name || ' / ' || c_mktsegment AS joined,
           replace(c_name, '#', '-') AS replaced, substr(c_name, 1, 8) AS head, trim('  ' || c_mktsegment || ' ') AS trimmed,
           concat_ws(' ', CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END, c_name) AS null_safe FROM customer""")
def string_basics(spark, sf):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        "c_custkey", F.upper(name).alias("up"), F.lower(seg).alias("low"),
        F.concat(name, F.lit(" / "), seg).alias("joined"), F.replace(name, F.lit("#"), F.lit("-")).alias("replaced"),
        F.substring(name, 1, 8).alias("head"), F.trim(F.concat(F.lit("  "), seg, F.lit(" "))).alias("trimmed"),
        F.concat_ws(" ", F.when(F.col("c_custkey") % 4 != 0, seg), name).alias("null_safe"))


@query("clean_line", """
    SELECT doc_id, md5(trim(lower(regexp_replace(text, '[^A-Za-z ]', '', 'g')), ' ')) AS cleaned FROM documents""")
def clean_line(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(X.clean_line(F.col("text"))).alias("cleaned"))


def _entities_sql(c):
    for k, v in X.ENTITIES.items():
        c = f"replace({c}, '{k.replace(chr(39), chr(39) * 2)}', '{v.replace(chr(39), chr(39) * 2)}')"
    return c


_STRIPPED_SQL = "regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&(amp;)+', '&', 'g')"


@query("html_to_text", f"""
    SELECT page_id, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS body FROM (
        SELECT page_id, trim(regexp_replace({_entities_sql(_STRIPPED_SQL)}, '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS t FROM pages)""")
def html_to_text(spark, sf):
    body = table(spark, sf, "pages").select("page_id", X.html_to_text(F.col("html")).alias("t"))
    return body.select("page_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("body"))


@query("regex_fields", """
    SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme,
           coalesce(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), ''), 'NA') AS page_no,
           coalesce(nullif(regexp_extract(url, '#(\\w+)$', 1), ''), 'NA') AS anchor,
           array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS numbers FROM pages""")
def regex_fields(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract(url, "^(https?)://", 1).alias("scheme"),
        F.coalesce(X.first_match(url, "[?&]page=([0-9]+)"), F.lit("NA")).alias("page_no"),
        F.coalesce(X.first_match(url, r"#(\w+)$"), F.lit("NA")).alias("anchor"),
        F.array_join(F.regexp_extract_all(url, F.lit("[0-9]+"), F.lit(0)), ",").alias("numbers"))


@query("substring_counts", """
    SELECT doc_id, CAST(len(string_split(text, 'the')) - 1 AS BIGINT) AS n_the,
           CAST(len(string_split(text, 'tion')) - 1 AS BIGINT) AS n_tion FROM documents""")
def substring_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.substring_count(F.col("text"), "the").alias("n_the"),
                                                X.substring_count(F.col("text"), "tion").alias("n_tion"))


@query("code_labels", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open order' WHEN 'F' THEN 'filled order'
           WHEN 'P' THEN 'order in part' ELSE 'unknown' END AS label FROM orders""")
def code_labels(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", X.code_label(F.col("o_orderstatus"), STATUS_LABELS, "unknown").alias("label"))


@query("date_strings", """
    SELECT event_id, strftime(ts, '%d-%b-%Y %H:%M') AS stamp, strftime(ts, '%d/%m/%Y') AS day FROM events""")
def date_strings(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "dd-MMM-yyyy HH:mm").alias("stamp"), F.date_format("ts", "dd/MM/yyyy").alias("day"))


@query("money_strings", """
    SELECT p_partkey, '$' || printf('%.2f', p_retailprice) AS price FROM part""")
def money_strings(spark, sf):
    amount = F.to_char(F.col("p_retailprice").cast("decimal(12,2)"), F.lit("$9999999990.99"))
    return table(spark, sf, "part").select("p_partkey", F.replace(amount, F.lit(" "), F.lit("")).alias("price"))


@query("stay_length", """
    SELECT l_orderkey, l_linenumber, s // 86400 AS whole_days, round((s % 86400) / 3600.0, 1) AS rest_hours FROM (
        SELECT l_orderkey, l_linenumber,
               date_diff('second', o_orderdate, l_shipdate) + (l_partkey * 977) % 86400 AS s
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)""")
def stay_length(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .where(F.col("l_shipdate") > F.col("o_orderdate"))
    stay = D.stay_seconds(F.col("o_orderdate"), F.col("l_shipdate")) + F.col("l_partkey") * 977 % 86400
    return both.select("l_orderkey", "l_linenumber", D.whole_days(stay).alias("whole_days"),
                       D.rest_hours(stay).alias("rest_hours"))


@query("weekday_profile", """
    SELECT CAST(isodow(CAST(o_orderdate AS DATE)) - 1 AS INT) AS weekday,
           CASE WHEN isodow(o_orderdate) - 1 > 4 THEN 'weekend' ELSE 'weekday' END AS part_of_week,
           count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""")
def weekday_profile(spark, sf):
    day = F.try_to_date(F.date_format("o_orderdate", "d/M/y"), "d/M/y")
    return (table(spark, sf, "orders").withColumn("d", day)
            .groupBy(F.weekday("d").alias("weekday"),
                     F.when(D.is_weekend(F.col("d")), "weekend").otherwise("weekday").alias("part_of_week"))
            .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("month_profile", """
    SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, count(*) AS n FROM orders GROUP BY 1, 2""")
def month_profile(spark, sf):
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")) \
        .agg(F.count("*").alias("n"))


@query("quarter_trend", """
    SELECT year(l_shipdate) || 'Q' || quarter(l_shipdate) AS quarter, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def quarter_trend(spark, sf):
    return table(spark, sf, "lineitem").groupBy(D.quarter_label(F.col("l_shipdate")).alias("quarter"), "l_returnflag") \
        .agg(F.count("*").alias("n"))


@query("time_band", """
    SELECT event_id, CASE WHEN t BETWEEN TIME '08:00:00' AND TIME '12:00:00' THEN 'Breakfast'
        WHEN t > TIME '12:00:00' AND t <= TIME '16:00:00' THEN 'Lunch'
        WHEN t > TIME '16:00:00' AND t <= TIME '20:00:00' THEN 'Dinner' ELSE 'Error' END AS band
    FROM (SELECT event_id, CAST(date_trunc('second', ts) AS TIME) AS t FROM events)""")
def time_band(spark, sf):
    return table(spark, sf, "events").select("event_id", D.time_band(F.col("ts")).alias("band"))


@query("repair_dates", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def repair_dates(spark, sf):
    dirty = F.expr("""case when o_orderkey % 5 = 0 then date_format(o_orderdate, 'dd-MM-yyyy')
                           when o_orderkey % 5 = 1 and day(o_orderdate) > 12 then date_format(o_orderdate, 'yyyy-dd-MM')
                           else date_format(o_orderdate, 'yyyy-MM-dd') end""")
    return table(spark, sf, "orders").select("o_orderkey", dirty.alias("dirty")) \
        .select("o_orderkey", D.repair_date(F.col("dirty")).alias("day"))


@query("haversine", """
    WITH p AS (SELECT l_orderkey, l_linenumber, radians((l_partkey * 37 % 1800) / 10.0 - 90) AS a1,
                      radians((l_partkey * 91 % 3600) / 10.0 - 180) AS o1, radians((l_suppkey * 53 % 1800) / 10.0 - 90) AS a2,
                      radians((l_suppkey * 71 % 3600) / 10.0 - 180) AS o2 FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(2 * 6378 * asin(sqrt(least(1, pow(sin((a2 - a1) / 2), 2)
        + cos(a1) * cos(a2) * pow(sin((o2 - o1) / 2), 2)))), 3) AS km FROM p""")
def haversine(spark, sf):
    deg = lambda key, mul, span: (F.col(key) * mul % span) / 10.0 - span / 20.0
    metres = N.haversine_m(deg("l_partkey", 91, 3600), deg("l_partkey", 37, 1800),
                           deg("l_suppkey", 71, 3600), deg("l_suppkey", 53, 1800))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(metres / 1000, 3).alias("km"))


@query("guarded_rates", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.0 ELSE round(l_tax / l_discount, 6) END AS rate
    FROM lineitem""")
def guarded_rates(spark, sf):
    rate = N.guarded_ratio(F.col("l_tax"), F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(rate, 6).alias("rate"))


@query("rounding", """
    SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) / 4, 2) AS DOUBLE) AS up,
           CAST(round_even(CAST(p_size AS DOUBLE) / 2, 0) AS DOUBLE) AS even FROM part""")
def rounding(spark, sf):
    quarter = F.col("p_retailprice").cast("decimal(12,2)") / F.lit(4).cast("decimal(2,0)")
    return table(spark, sf, "part").select(
        "p_partkey", F.round(quarter, 2).cast("double").alias("up"), F.bround(F.col("p_size") / 2.0, 0).alias("even"))


@query("interaction_features", """
    SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
           round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax, round(l_discount * l_tax, 6) AS l_discount_x_l_tax,
           round(pow(l_quantity, 2), 4) AS l_quantity_p2, round(pow(l_quantity, 3), 4) AS l_quantity_p3,
           CASE WHEN l_discount = 0 THEN 0.0 ELSE round(ln(l_discount), 6) END AS log_discount,
           round(sqrt(l_quantity), 6) AS root_qty,
           round(l_quantity * sqrt(42 * l_linenumber * l_linenumber / (l_tax + 1)), 6) AS score FROM lineitem""")
def interaction_features(spark, sf):
    lines = table(spark, sf, "lineitem")
    wide = N.powers(N.interactions(lines, ["l_quantity", "l_discount", "l_tax"]), ["l_quantity"], 3)
    r = lambda c, n=6: F.round(c, n)
    return wide.select(
        "l_orderkey", "l_linenumber",
        *[r(F.col(c)).alias(c) for c in ("l_quantity_x_l_discount", "l_quantity_x_l_tax", "l_discount_x_l_tax")],
        *[r(F.col(c), 4).alias(c) for c in ("l_quantity_p2", "l_quantity_p3")],
        r(N.safe_log(F.col("l_discount"))).alias("log_discount"), r(F.sqrt("l_quantity")).alias("root_qty"),
        r(N.nerd_score(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax"))).alias("score"))


@query("repair_latlon", """
    SELECT o_orderkey, round(-(30.5 + (o_custkey % 90) / 10.0), 4) AS lat, round(140 + (o_custkey % 97) / 10.0, 4) AS lon
    FROM orders""")
def repair_latlon(spark, sf):
    lat, lon = -(F.lit(30.5) + (F.col("o_custkey") % 90) / 10.0), F.lit(140) + (F.col("o_custkey") % 97) / 10.0
    kind = F.col("o_orderkey") % 7
    dirty = table(spark, sf, "orders").select(
        "o_orderkey", F.when(kind == 0, -lat).when(kind == 1, lon).otherwise(lat).alias("lat"),
        F.when(kind == 1, lat).otherwise(lon).alias("lon"))
    fixed = N.repair_latlon(F.col("lat"), F.col("lon"))
    return dirty.select("o_orderkey", F.round(fixed["lat"], 4).alias("lat"), F.round(fixed["lon"], 4).alias("lon"))
