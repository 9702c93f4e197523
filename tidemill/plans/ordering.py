"""Ranking, top-k, windows, set operations and reshaping."""

from pyspark.sql import functions as F

from ..functions.text import clean_line
from ..operators import aggregates as A, ordering as O, reshape as R
from ..sources.tables import documents, table
from .registry import query

_WORDS = """SELECT doc_id, lang, unnest(string_split(lower(regexp_replace(regexp_replace(text, '[\\r\\n]', ' ', 'g'),
                   '[^A-Za-z ]', '', 'g')), ' ')) AS w FROM documents"""


def document_words(spark, sf, *keep):
    line = clean_line(F.translate("text", "\r\n", "  "))
    return documents(spark, sf).select(*keep, F.explode(F.split(line, " ")).alias("w")).where("w <> ''")


@query("argsort_rank", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS rank FROM orders""")
def argsort_rank(spark, sf):
    return O.argsort(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey") \
        .select("o_orderkey", "rank")


@query("centered_rolling_mean", """
    SELECT event_id, round(avg(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY ts, event_id
                           ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING), 6) AS rolling_mean FROM events""")
def centered_rolling_mean(spark, sf):
    out = O.rolling_mean(table(spark, sf, "events").select("event_id", "event_type", "ts", "value"),
                         ["event_type"], ["ts", "event_id"], "value", 15)
    return out.select("event_id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query("latest_per_key", """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return O.last_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("first_event_after", """
    SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, strftime(ts, '%H:%M:%S') AS at FROM events
    WHERE event_type = 'purchase' AND hour(ts) >= 7
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def first_event_after(spark, sf):
    buys = table(spark, sf, "events").where((F.col("event_type") == "purchase") & (F.hour("ts") >= 7)) \
        .select("user_id", F.col("ts").cast("date").cast("string").alias("day"), "event_id", "ts")
    first = O.first_per_key(buys, ["user_id", "day"], ["ts", "event_id"])
    return first.select("user_id", "day", "event_id", F.date_format("ts", "HH:mm:ss").alias("at"))


@query("padded_ids", """
    SELECT doc_id, 'doc_' || lpad(CAST(row_number() OVER (ORDER BY n_chars, doc_id) AS VARCHAR), 9, '0') AS padded_id
    FROM documents""")
def padded_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return O.padded_ids(docs, ["n_chars", "doc_id"], width=9).select("doc_id", "padded_id")


@query("top_words", f"""
    SELECT w, count(*) AS n FROM ({_WORDS}) WHERE w <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def top_words(spark, sf):
    return O.top_terms(document_words(spark, sf), "w", 20)


@query("top10_terms", f"""
    SELECT lang, w AS term, n FROM (
        SELECT lang, w, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS rn
        FROM ({_WORDS}) WHERE length(w) > 2 GROUP BY 1, 2) WHERE rn <= 10""")
def top10_terms(spark, sf):
    counts = (document_words(spark, sf, "lang").where(F.length("w") > 2)
              .groupBy("lang", F.col("w").alias("term")).agg(F.count("*").alias("n")))
    return O.top_per_key(counts, ["lang"], [F.desc("n"), F.asc("term")], 10)


def _word_sql(table_name, column):
    return f"""SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) AS rank FROM (SELECT unnest(string_split(lower(
        regexp_replace(regexp_replace({column}, '[\\r\\n]', ' ', 'g'), '[^A-Za-z ]', '', 'g')), ' ')) AS w FROM {table_name})
        WHERE length(w) > 2 GROUP BY 1"""


@query("top10_side_by_side", f"""
    SELECT CAST(rank AS INT) AS rank, d.w AS documents, c.w AS conversations, b.w AS benchmark
    FROM ({_word_sql('documents', 'text')}) d JOIN ({_word_sql('conversations', 'text')}) c USING (rank)
    JOIN ({_word_sql('benchmark', 'text')}) b USING (rank) WHERE rank <= 10""")
def top10_side_by_side(spark, sf):
    tops = {}
    for name in ("documents", "conversations", "benchmark"):
        line = clean_line(F.translate("text", "\r\n", "  "))
        tokens = table(spark, sf, name).select(F.explode(F.split(line, " ")).alias("w")).where(F.length("w") > 2)
        tops[name] = tokens.groupBy("w").agg(F.count("*").alias("n"))
    return O.side_by_side(tops, "w", [F.desc("n"), F.asc("w")])


@query("argbest_row", """
    SELECT p_brand, p_type, mean_price FROM (
        SELECT p_brand, p_type, round(avg(CAST(p_retailprice AS DECIMAL(18,2))), 4) AS mean_price FROM part GROUP BY 1, 2)
    ORDER BY mean_price DESC, p_brand || p_type LIMIT 1""")
def argbest_row(spark, sf):
    mean = F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double") / F.count("*")
    results = (table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.round(mean, 4).alias("mean_price"))
               .withColumn("cell", F.concat("p_brand", "p_type")))
    return O.best_row(results, "mean_price", "cell", mode="max").drop("cell")


@query("set_ops", """
    WITH a AS (SELECT l_suppkey * 3 AS key FROM lineitem),
         b AS (SELECT s_suppkey * 2 AS key FROM supplier)
    SELECT key, 'both' AS side FROM (SELECT key FROM a INTERSECT SELECT key FROM b)
    UNION ALL SELECT key, 'left' FROM (SELECT key FROM a EXCEPT SELECT key FROM b)
    UNION ALL SELECT key, 'right' FROM (SELECT key FROM b EXCEPT SELECT key FROM a)""")
def set_ops(spark, sf):
    return R.set_split(table(spark, sf, "lineitem").select((F.col("l_suppkey") * 3).alias("l_suppkey")),
                       table(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("s_suppkey")))


@query("melt_long", """
    SELECT l_orderkey, l_linenumber, variable, value FROM (
        SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
    UNPIVOT (value FOR variable IN (l_quantity, l_discount, l_tax))""")
def melt_long(spark, sf):
    return R.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("invert_map", """
    SELECT upper(replace(unnest(regexp_extract_all(html, '<li><a href="/([^"]*)"', 1)), 'ß', 'ss')) AS value, page_id AS key FROM pages""")
def invert_map(spark, sf):
    lists = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)"'), F.lit(1)).alias("paths"))
    return R.invert_map(lists, "page_id", "paths")


@query("complete_axis", """
    SELECT CAST(d AS VARCHAR) AS day, count(event_id) AS n
    FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY)) AS DATE) AS d)
    LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1""")
def complete_axis(spark, sf):
    daily = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    out = R.complete_axis(daily, "day", "n", "2023-12-25", "2024-02-10")
    return out.select(F.col("day").cast("string").alias("day"), F.col("n").cast("bigint").alias("n"))


@query("sample_rows", """
    SELECT event_id, user_id, value FROM events ORDER BY ('0x' || substr(md5('sample 1 ' || event_id), 1, 15))::BIGINT, event_id LIMIT 100""")
def sample_rows(spark, sf):
    return O.sample_rows(table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id", 100)


@query("dedup_keep_last", """
    SELECT doc, source, doc_id FROM (SELECT md5(text) AS doc, source, doc_id FROM documents)
    QUALIFY row_number() OVER (PARTITION BY doc ORDER BY doc_id DESC) = 1""")
def dedup_keep_last(spark, sf):
    docs = table(spark, sf, "documents").select(F.md5("text").alias("doc"), "source", "doc_id")
    return O.last_per_key(docs, ["doc"], ["doc_id"])


@query("zipf_rank", f"""
    SELECT w, n, row_number() OVER (ORDER BY n DESC, w) AS rank
    FROM (SELECT w, count(*) AS n FROM ({_WORDS}) WHERE w <> '' GROUP BY 1)""")
def zipf_rank(spark, sf):
    return A.zipf_rank(document_words(spark, sf), "w")


@query("zipf_by_lang", f"""
    SELECT lang, w, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS rank
    FROM (SELECT lang, w, count(*) AS n FROM ({_WORDS}) WHERE w <> '' GROUP BY 1, 2)""")
def zipf_by_lang(spark, sf):
    return A.zipf_rank(document_words(spark, sf, "lang"), "w", by=["lang"])


@query("frequency_of_frequencies", f"""
    SELECT lang, n, count(*) AS n_terms FROM (SELECT lang, w, count(*) AS n FROM ({_WORDS}) WHERE w <> '' GROUP BY 1, 2)
    GROUP BY 1, 2""")
def frequency_of_frequencies(spark, sf):
    return A.count_of_counts(document_words(spark, sf, "lang"), "w", by=["lang"])
