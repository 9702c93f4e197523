import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import CLASHES, DOCS, none, odd
from tidemill.llm import exact, exchange


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300))
def test_rice_code_round_trip(values):
    v = np.array(sorted(values), dtype=np.uint64)
    assert (exchange.rice_decode(len(v), *exchange.rice_code(v)) == v).all()


def test_rice_code_is_short():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 10_000, dtype=np.uint64))
    assert len(exchange.rice_code(v)[1]) * 8 / len(v) < 63 - np.log2(len(v)) + 3


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_of_odd_rows(spark):
    got = exact.exact_duplicates(odd(spark)).collect()
    assert len(got) == len(DOCS)
    members = {}
    for i, text, *_ in DOCS:
        members.setdefault(normal(text), []).append(i)
    want = sorted((str(i), str(min((x for x in members[normal(t)] if x is not None), default=None)), len(members[normal(t)]))
                  for i, t, *_ in DOCS)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(members)


def test_kept_rows_have_all_columns(spark):
    df = odd(spark)
    kept = exact.drop_exact_duplicates(df).collect()
    assert kept[0].asDict().keys() == dict.fromkeys(df.columns).keys()
    assert sorted(normal(r.text) for r in kept) == sorted({normal(t) for _, t, *_ in DOCS})
    assert all(r[c] == f"own {c}" for r in kept for c in CLASHES)


@pytest.mark.parametrize("operator", [exact.exact_duplicates, exact.drop_exact_duplicates])
def test_empty_table(spark, operator):
    assert operator(none(spark)).collect() == []


def test_marks_are_shared(spark):
    rows = spark.createDataFrame([(0, 5, False), (0, 7, True), (1, 7, False), (1, 5, False), (2, 9, False)],
                                 "run long, fp long, mark boolean")
    twice = {r.run: r.found for r in exchange.exchanged(rows, 5, 3, 1).collect()}
    assert twice == {0: [5, 7], 1: [5, 7], 2: []}
    marked = {r.run: r.found for r in exchange.exchanged(rows, 5, 3, 1, flagged=True).collect()}
    assert marked == {0: [7], 1: [7], 2: []}
