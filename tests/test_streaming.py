from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.session import scratch_path
from tidemill.streaming import totals as X


def test_totals_follow_arriving_rows(spark):
    source, out, state = (scratch_path(spark, t) for t in ("in", "out", "state"))
    schema = "k string, v double"

    def arrive(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        X.running_totals(spark.readStream.schema(schema).parquet(source), "k", "v", out, state).awaitTermination()
        return rows(X.read_totals(spark, out, "k"), "k")

    assert arrive([("a", 1.0), ("b", 2.0), ("a", 3.0)]) == [("a", 4.0, 2), ("b", 2.0, 1)]
    assert arrive([("a", 10.0), ("c", 5.0)]) == [("a", 14.0, 3), ("b", 2.0, 1), ("c", 5.0, 1)]
    batch = spark.read.schema(schema).parquet(source).groupBy("k").agg(F.sum("v"), F.count("*"))
    assert rows(X.read_totals(spark, out, "k"), "k") == rows(batch, "k")
    snapshot = scratch_path(spark, "snapshot")
    X.compact_totals(spark, out, "k", snapshot)
    assert rows(X.read_totals(spark, snapshot, "k"), "k") == rows(batch, "k")


def _stream(spark):
    source, out, state = (scratch_path(spark, t) for t in ("in", "out", "state"))
    schema = "k string, v double"

    def arrive(data, state=state, **more):
        if data:
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        X.running_totals(spark.readStream.schema(schema).parquet(source), "k", "v", out, state, **more).awaitTermination()
        return rows(X.read_totals(spark, out, "k"), "k")
    return arrive, out, state


def test_compaction_between_batches_and_a_replayed_batch(spark):
    import os
    arrive, out, state = _stream(spark)
    arrive([("a", 1.0), ("b", 2.0)])
    arrive([("a", 3.0)])
    assert X.compact_totals(spark, out, "k") == 1
    assert rows(X.read_totals(spark, out, "k"), "k") == [("a", 4.0, 2), ("b", 2.0, 1)]
    reader = X.read_totals(spark, out, "k")
    assert arrive([("a", 10.0), ("c", 5.0)]) == [("a", 14.0, 3), ("b", 2.0, 1), ("c", 5.0, 1)]
    # the last batch ended without a commit: Spark runs it once more
    last = max(int(n) for n in os.listdir(f"{state}/commits") if n.isdigit())
    os.remove(f"{state}/commits/{last}")
    for name in os.listdir(f"{state}/commits"):
        if name == f".{last}.crc":
            os.remove(f"{state}/commits/{name}")
    assert X.compact_totals(spark, out, "k") == 2
    assert rows(reader, "k") == [("a", 4.0, 2), ("b", 2.0, 1)]      # a reader of the version before can finish
    assert arrive([]) == [("a", 14.0, 3), ("b", 2.0, 1), ("c", 5.0, 1)]
    assert arrive([("b", 1.0)]) == [("a", 14.0, 3), ("b", 3.0, 2), ("c", 5.0, 1)]
    assert X.compact_totals(spark, out, "k") == 3 and X.compact_totals(spark, out, "k") == 3
    kept = sorted(n for n in os.listdir(out) if not n.startswith((".", "manifest")))
    assert rows(X.read_totals(spark, out, "k"), "k") == [("a", 14.0, 3), ("b", 3.0, 2), ("c", 5.0, 1)]
    assert not [n for n in kept if n in ("batch=0", "batch=1", "batch=2")] and len([n for n in kept if n.startswith("snapshot")]) == 2


def test_the_stream_compacts_by_itself(spark):
    import os
    arrive, out, _ = _stream(spark)
    for i in range(4):
        got = arrive([("a", 1.0), (f"k{i}", 2.0)], compact_every=2)
    assert got[0] == ("a", 4.0, 4) and len(got) == 5
    assert sorted(n for n in os.listdir(f"{out}/manifest") if n.endswith("json") and not n.startswith(".")) == ["00000001.json", "00000002.json"]


def test_two_compactions_do_not_overwrite_each_other(spark, monkeypatch):
    import pytest
    arrive, out, _ = _stream(spark)
    arrive([("a", 1.0)])
    folder = X._Folder(spark, out)
    folder.commit({"version": 1, "snapshot": None, "upto": -1, "replaced": []})
    with pytest.raises(RuntimeError, match="another"):
        folder.commit({"version": 1, "snapshot": None, "upto": 0, "replaced": []})
    with pytest.raises(ValueError, match="no batch"):
        X.read_totals(spark, scratch_path(spark, "none"), "k")
