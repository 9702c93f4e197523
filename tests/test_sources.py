from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.session import scratch_path, shared_dir
from tidemill.sources import readers, records, sinks


def test_routing_drops_other_classes_and_keeps_every_row(spark):
    path = scratch_path(spark, "routes")
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "q").when(F.col("id") % 3 == 1, "a").otherwise("x").alias("kind"))
    sinks.write_partitioned(df, path, ["kind"], kinds=["q", "a"])
    back = spark.read.parquet(path)
    assert rows(back.groupBy("kind").count(), "kind") == [("a", 300), ("q", 300)]


def test_feeds_are_united_without_repeats(spark):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    sinks.write_csv(spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string"), a)
    sinks.write_csv(spark.createDataFrame([(2, "y"), (3, None)], "i int, s string"), b)
    assert rows(readers.union_sources(spark, [a, b], "i int, s string"), "i") == [(1, "x"), (2, "y"), (3, None)]
    assert readers.union_sources(spark, [a, b], "i int, s string", dedup=False).count() == 4


def test_records_and_fields(spark):
    df = spark.createDataFrame([(1, "<doc>a: 1</doc><doc>b: x</doc><doc></doc>")], "id int, t string")
    parts = records.split_records(df, "t", "</?doc>")
    assert rows(parts.select("record"), "record") == [("a: 1",), ("b: x",)]
    out = records.extract_fields(parts, "record", {"key": ("^([a-z]):", "NA", "string"), "n": (": (.*)$", None, "int"),
                                                   "z": ("(zzz)", "NA", "string")}, ["id"])
    assert rows(out, "key") == [(1, "a", 1, "NA"), (1, "b", None, "NA")]


def test_literal_separator_is_read_by_the_source(spark):
    path = scratch_path(spark, "sep")
    sinks.write_lines(spark.createDataFrame([("a%%b%%c",)], "value string").coalesce(1), path)
    assert [r["value"].strip() for r in readers.read_lines(spark, path, "%%").collect()] == ["a", "b", "c"]


def test_sparse_lines(spark):
    counts = spark.createDataFrame([("d1", 10, 2), ("d1", 3, 1), ("d2", 0, 5)], "d string, term_index int, n int")
    assert rows(sinks.sparse_vector_lines(counts, "d"), "value") == [("d1,3:1,10:2",), ("d2,0:5",)]


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or shared_dir(spark) == configured.rstrip("/")
