"""Sources and sinks: round trips through each format, record extraction from text."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import readers, records, sinks
from ..sources.tables import SCHEMAS, table
from .registry import query


@query("csv_roundtrip", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path)
    return readers.read_csv(spark, path, SCHEMAS["customer"])


@query("append_rows", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT -1, 'walk-in', 0, 0.0, 'NONE' UNION ALL SELECT -2, 'staff', 0, 0.0, 'NONE'""")
def append_rows(spark, sf):
    path, customer = scratch_path(spark, "append"), table(spark, sf, "customer")
    customer.where("c_custkey % 3 > 0").write.parquet(path)
    sinks.append_rows(customer.where("c_custkey % 3 = 0"), path, ["c_custkey"])
    constant = spark.createDataFrame([(-1, "walk-in", 0, 0.0, "NONE"), (-2, "staff", 0, 0.0, "NONE")], "k long, n string, a int, b double, m string")
    sinks.append_rows(constant.toDF(*customer.columns), path, ["c_custkey"])
    return spark.read.schema(SCHEMAS["customer"]).parquet(path)


@query("text_line_scan", """
    SELECT CAST(length(line) AS BIGINT) AS n_chars, count(*) AS n_lines
    FROM (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents) GROUP BY 1""")
def text_line_scan(spark, sf):
    path = scratch_path(spark, "text")
    sinks.write_lines(table(spark, sf, "documents").select(F.translate("text", "\r", " ").alias("value")), path)
    lines = readers.read_lines(spark, path, separator="\n")
    return lines.groupBy(F.length("value").cast("bigint").alias("n_chars")).agg(F.count("*").alias("n_lines"))


@query("union_dedup", """
    SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""")
def union_dedup(spark, sf):
    base = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("date").cast("string").alias("day"))
    paths = []
    for kinds in (("click", "view", "purchase"), ("view", "error", "signup")):
        paths.append(scratch_path(spark, "feed"))
        sinks.write_csv(base.where(F.col("event_type").isin(*kinds)), paths[-1])
    return readers.union_sources(spark, paths, "user_id bigint, event_type string, day string")


@query("record_split", """
    SELECT page_id, CAST(ordinality - 1 AS BIGINT) AS record_no, CAST(length(rec) AS BIGINT) AS n_chars
    FROM (SELECT page_id, list_filter(regexp_split_to_array(html, '<p>|</p>'), lambda x: x <> '') AS recs FROM pages),
         unnest(recs) WITH ORDINALITY AS u(rec, ordinality)""")
def record_split(spark, sf):
    out = records.split_records(table(spark, sf, "pages").select("page_id", "html"), "html", "<p>|</p>")
    return out.select("page_id", F.col("record_no").cast("bigint").alias("record_no"),
                      F.length("record").cast("bigint").alias("n_chars"))


@query("xml_fields", """
    SELECT event_id AS post_id, event_type AS kind, user_id AS owner, value AS score FROM events""")
def xml_fields(spark, sf):
    path = scratch_path(spark, "xml")
    posts = table(spark, sf, "events").select(F.col("event_id").alias("_Id"), F.col("event_type").alias("_Kind"),
                                              F.col("user_id").alias("Owner"), F.col("value").alias("Score"))
    sinks.write_xml(posts, path, "posts", "row")
    back = readers.read_xml(spark, path, "row", "_Id bigint, _Kind string, Owner bigint, Score double")
    return back.select(F.col("_Id").alias("post_id"), F.col("_Kind").alias("kind"),
                       F.col("Owner").alias("owner"), F.col("Score").alias("score"))


@query("html_list_rows", """
    SELECT page_id, CAST(i - 1 AS BIGINT) AS pos, hrefs[i] AS href, labels[i] AS label
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS labels FROM pages),
         unnest(generate_series(1, len(hrefs))) AS u(i)""")
def html_list_rows(spark, sf):
    out = records.extract_items(table(spark, sf, "pages"), "html", r'<li><a href="([^"]*)">([^<]*)</a></li>',
                                ["href", "label"], ["page_id"])
    return out.withColumn("pos", F.col("pos").cast("bigint"))


@query("json_roundtrip", """
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    props = F.from_json("props", "k bigint")
    keyed = table(spark, sf, "events").select(
        "event_id", F.to_json(F.struct("event_type", props.alias("props"))).alias("record"))
    sinks.write_json(keyed, path)
    back = readers.read_json(spark, path, "event_id bigint, record string")
    record = F.from_json("record", "event_type string, props struct<k: bigint>")
    return back.withColumn("record", record).select("event_id", "record.event_type", F.col("record.props.k").alias("k"))


@query("json_extract", """
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total
    FROM events GROUP BY 1""")
def json_extract(spark, sf):
    flat = table(spark, sf, "events").select(F.from_json("props", "k bigint").alias("p"), "value")
    return flat.groupBy(F.col("p.k").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("partitioned_sink", """
    SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS id_sum FROM events
    WHERE event_type IN ('purchase', 'signup') GROUP BY 1""")
def partitioned_sink(spark, sf):
    path = scratch_path(spark, "routed")
    sinks.write_partitioned(table(spark, sf, "events"), path, ["event_type"], kinds=["purchase", "signup"])
    back = spark.read.schema(SCHEMAS["events"]).parquet(path)
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query("page_fields", """
    SELECT page_id,
           coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'NA') AS title,
           coalesce(nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), ''), 'NA') AS lang,
           coalesce(nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ''), 'NA') AS heading,
           TRY_CAST(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') AS BIGINT) AS track_id,
           CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n_paragraphs,
           CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS n_links,
           '[' || array_to_string(regexp_extract_all(html, '<li><a href="([^"]*)"', 1), ',') || ']' AS links,
           coalesce(nullif(regexp_extract(url, '^https?://([^/]+)', 1), ''), 'NA') AS host
    FROM pages""")
def page_fields(spark, sf):
    pages = table(spark, sf, "pages")
    fields = {"title": ("<title>([^<]*)</title>", "NA", "string"),
              "lang": ('<html lang="([a-z]+)"', "NA", "string"),
              "heading": ("<h1>([^<]*)</h1>", "NA", "string"),
              "track_id": (r"track\(([0-9]+)\)", None, "bigint")}
    counts = pages.withColumns({
        "n_paragraphs": F.regexp_count("html", F.lit("<p>")).cast("bigint"),
        "n_links": F.regexp_count("html", F.lit("<a href=")).cast("bigint"),
        "links": F.concat(F.lit("["), F.array_join(
            F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), F.lit(1)), ","), F.lit("]")),
        "host": F.coalesce(F.nullif(F.regexp_extract("url", "^https?://([^/]+)", 1), F.lit("")), F.lit("NA"))})
    return records.extract_fields(counts, "html", fields, ["page_id", "n_paragraphs", "n_links", "links", "host"])
