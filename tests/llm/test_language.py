import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import CLASHES, none, odd
from tidemill.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.fit(docs.filter(~held))
    judged = docs.filter(held).select("doc_id", "lang", language.predict(F.col("text"), model, spark).alias("p")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in judged)
    assert sum(r.lang == r.p.lang_pred for r in judged) >= 0.98 * len(judged)
    assert sum(r.p.rejected for r in judged) <= 0.01 * len(judged)
    noise = spark.createDataFrame([("zqxj vkwq pzzx qqkj wvxz jjqk " * 60,)], "text string")
    assert noise.select(language.predict(F.col("text"), model, spark).alias("p")).first().p.rejected


def test_odd_rows(spark):
    df = odd(spark)
    model = language.fit(df)
    assert set(model["langs"]) == {"en", "fr"}      # the only German text has no letters
    got = df.select("text", language.predict(F.col("text"), model, spark).alias("p")).collect()
    for r in got:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.p.lang_pred == language.UNKNOWN) == (not letters) and 0 <= r.p.score <= 1
    kept = language.drop_rejected(df, model).collect()
    assert all(any(map(str.isalpha, r.text)) and all(r[c] == f"own {c}" for c in CLASHES) for r in kept)


def test_whole_texts_count(spark, monkeypatch):
    text = "some words repeated again " * 50
    whole = language.trigram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 17)
    assert (language.trigram_counts(text) == whole).all()


def test_nothing_to_learn(spark):
    model = language.fit(none(spark))
    assert language.drop_rejected(none(spark), model).collect() == []
    got = odd(spark).select(language.predict(F.col("text"), model, spark).alias("p")).collect()
    assert all(r.p.lang_pred == language.UNKNOWN and r.p.rejected for r in got)


def test_sample_is_bounded_and_never_empty(spark, monkeypatch):
    sizes, cluster = spark.sparkContext.accumulator(0), language._cluster

    def watched(*args):
        run = cluster(*args)

        def counted(group):
            sizes.add(len(group))
            return run(group)
        return counted
    monkeypatch.setattr(language, "_cluster", watched)
    texts = [("en", f"some words of text {'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10] * 3}") for i in range(100)]
    hot = [("en", "a text that comes again and again")] * 3000 + [("de", f"viel kopierter Satz {c}") for c in "xyz"] * 1000
    df = spark.createDataFrame(texts + hot, "lang string, text string")
    assert set(language.fit(df, sample=2)["langs"]) == {"en", "de"}
    assert sizes.value == 4
    sizes.value = 0
    language.fit(df)
    assert sizes.value == 104       # 101 and 3 different texts
