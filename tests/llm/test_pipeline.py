import corpus_pipeline
from tests.llm.helpers import none, odd

from tidemill.llm import exact, mixing, simhash


def test_stages_on_odd_rows(spark, sf):
    docs = odd(spark).drop("ids", "n_tokens")
    for name, stage in corpus_pipeline.STAGES:
        columns, docs = docs.columns, stage(spark, docs, sf)
        if name != "token ids":
            assert docs.columns == columns
    rows = docs.collect()
    assert rows and all(len(r.ids) == r.n_tokens > 0 for r in rows)


def test_stages_on_an_empty_table(spark, sf):
    docs = none(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.collect() == []


def test_decisions_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs, sf)
    assert known.count() >= 0.99 * docs.count()
    unique = stages["exact dedup"](spark, known, sf)
    assert {r.doc_id for r in unique.collect()} == {r.doc_id for r in exact.exact_duplicates(known).filter("kept").collect()}
    near = stages["near duplicates"](spark, unique, sf)
    groups = simhash.simhash_groups(unique).collect()
    assert {r.doc_id for r in near.collect()} == {r.component_id for r in groups} and near.count() == len({r.component_id for r in groups})
    mixed = stages["mixing"](spark, near, sf)
    copies = {r.id: r.copies for r in mixing.mix(near).collect()}
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: c for i, c in copies.items() if c}
