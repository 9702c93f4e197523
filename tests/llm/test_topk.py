import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import topk


def brute(rows, k, every):
    ints = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ints):
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for other, (i, b) in enumerate(ints) if other != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, k, every):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit(1) for c in ("id", "v", "norm", "ids", "data")})
    return sorted(map(tuple, topk.top_inner_products(df, F.col("vec_id") % every == 0, k).collect()))


def single(x):
    import struct
    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("blocks", [(4096, 8192, 256), (7, 5, 3)])
def test_against_all_pairs(spark, monkeypatch, blocks):
    for name, value in zip(("CANDIDATE_BLOCK", "QUERY_BLOCK", "QUERIES_AT_ONCE"), blocks, strict=True):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(7)
    rows = [(i, [single(rng.gauss(0, 1) * (1 + i % 5)) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]         # ties
    assert found(spark, rows, 5, 4) == brute(rows, 5, 4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [0.5, None]), (5, [-1.0, 0.25]), (None, [9.0, 9.0]),
            (6, []), (7, [3.0]), (5, [-2.0, 0.25]), (0, [1.0, 2.0]), (8, [0.0, 0.0])]
    assert found(spark, rows, 20, 4) == brute(rows, 20, 4)


def test_rows_with_a_repeated_id(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (4, [2.0]), (4, [2.0]), (4, [5.0])]
    got = found(spark, rows, 20, 4)
    assert got == brute(rows, 20, 4) and (0, 2, 1, 64 * 192) in got and len(got) == 4 * 5


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        found(spark, [(0, [1e30]), (1, [1e30]), (2, [1.0])], 3, 1)
    rows = [(0, [3e7, 0.0]), (1, [3e7, 1.0]), (2, [-3e7, 1.0])]
    assert found(spark, rows, 3, 1) == brute([(i, [single(x) for x in v]) for i, v in rows], 3, 1)


def test_empty_table(spark):
    assert found(spark, [], 3, 1) == [] and found(spark, [(1, [1.0])], 3, 1) == [] and found(spark, [(1, [1.0]), (2, [1.0])], 3, 5) == []
