import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, none, odd
from tidemill.llm import sharding


def test_odd_rows(spark):
    got = sharding.shard_documents(odd(spark), shards=4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in DOCS)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_even_bytes_and_whole_groups(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    got = sharding.shard_documents(docs, shards=4).collect()
    sizes, places = Counter(), {}
    for r in got:
        sizes[r.shard] += r.size
        places.setdefault(r.text_crc32, set()).add(r.shard)
    mean = sum(sizes.values()) / 4
    assert max(abs(s - mean) for s in sizes.values()) <= 2 * max(r.size for r in got)
    assert all(len(p) == 1 for p in places.values())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("rows_per_range", [7, 250_000])
def test_only_texts_larger_than_a_shard_are_split(spark, folder, rows_per_range):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").select("doc_id", "text")
    n, total = docs.agg(F.count("*"), F.sum(F.octet_length("text") + 1)).first()
    mean, group = total / 16, "group " * 30
    parts = [docs]
    for i, share in enumerate((0.07, 0.3, 0.97, 2.5)):      # of a shard's bytes, in copies of one text
        text = f"{i} {group}"
        parts.append(spark.range(int(share * mean / (len(text) + 1))).select((F.col("id") + 10**6 * (i + 1)).alias("doc_id"), F.lit(text).alias("text")))
    for more in parts[1:]:
        docs = docs.unionByName(more)
    got = sharding.shard_documents(docs, rows_per_range=rows_per_range).collect()
    mean = sum(r.size for r in got) / 16
    places, groups, sizes = defaultdict(set), Counter(), Counter()
    for r in got:
        places[r.text_crc32].add(r.shard)
        groups[r.text_crc32] += r.size
        sizes[r.shard] += r.size
    assert all(len(places[t]) == 1 for t, size in groups.items() if size <= mean)
    assert max(len(p) for p in places.values()) >= 2
    largest = max([size for size in groups.values() if size <= mean] + [r.size for r in got])
    assert all(abs(sizes[s] - mean) <= largest for s in range(16))


def test_shards_against_a_sorted_list(spark):
    """With one range, every text lies where its middle falls in the list sorted by hash."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, "word " * rng.randint(0, 60) + str(rng.randint(0, 150))) for i in range(400)], "doc_id long, text string")
    h = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    groups = defaultdict(list)
    for r in docs.collect():
        groups[h[r.text]].append((r.doc_id, len(r.text) + 1))
    total, before, want = sum(n for g in groups.values() for _, n in g), 0, {}
    for _, g in sorted(groups.items()):
        size = sum(n for _, n in g)
        for i, _ in g:
            want[i] = int((before + size / 2) * 4 / total)
        before += size
    got = sharding.shard_documents(docs, shards=4).collect()
    assert {r.doc_id: r.shard for r in got} == want


def test_a_hot_text_is_split(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("copy " * 20)).otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"), F.repeat(F.lit(" x"), 40))).alias("text"))
    got = sharding.shard_documents(docs, shards=16, rows_per_range=100).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert len(sizes) == 16 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_empty_table(spark):
    assert sharding.shard_documents(none(spark)).collect() == []


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = odd(spark).drop("shard", "slot")
    sharding.write_shards(df, str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s")).select(df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_written_shards_may_have_a_column_of_that_name(spark, tmp_path):
    df = odd(spark)
    sharding.write_shards(df, str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s")).select(df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
