import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.helpers import CLASHES, DOCS, none, odd
from tidemill.llm import repeats


def brute(texts, length):
    """Per text: bytes, removed bytes, runs, digest of the rest."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if counts[d[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df, length):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in repeats.repeated_passages(df, length).collect())


def test_odd_rows(spark):
    want = sorted((str(i), *b) for (i, *_), b in zip(DOCS, brute([d[1] for d in DOCS], 400), strict=True))
    assert found(odd(spark), 400) == want


def test_random_passages(spark):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [noise(n) for n in (160, 170, 199, 200, 201, 230, 300, 900)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            a = rng.randrange(40)
            parts += [noise(rng.choice([0, 1, 3, 80])), p[a:len(p) - rng.randrange(40)]]
        texts.append("".join(parts))
    texts += ["z" * 500, "xy" * 130, "z" * 199, "z" * 200, passages[7], passages[7] * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert found(df, 200) == sorted((str(i), *b) for i, b in enumerate(brute(texts, 200)))


def test_edges_and_kept_bytes(spark):
    rng = random.Random(1)
    passage, a, b = ("".join(rng.choice("abcdefghij") for _ in range(n)) for n in (500, 90, 70))
    df = spark.createDataFrame([(1, a + passage), (2, passage + b), (3, a)], "doc_id long, text string")
    got = {r.doc_id: (r.edges, r.kept) for r in repeats.repeated_passages(df, 400).collect()}
    assert got == {1: ([90, 590], bytearray(a.encode())), 2: ([0, 500], bytearray(b.encode())), 3: ([], None)}


def test_equal_strings_share_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(97, 105, 400, dtype=np.uint8).tobytes()
    places = []
    for seed in (1, 2):
        left = np.random.default_rng(seed).integers(97, 105, 333, dtype=np.uint8).tobytes()
        data = left + shared + left
        at = repeats.anchors(repeats.Hashed(data), np.array([0]), np.array([len(data)]))
        places.append({int(x) - 333 for x in at if 333 + repeats.WINDOW <= x < 733 - repeats.WINDOW - repeats.GRAM})
    assert places[0] == places[1] and places[0]


def test_empty_table(spark):
    assert repeats.repeated_passages(none(spark)).collect() == []


def test_rows_find_their_anchors_by_place(spark):
    """A search in the array of the run, row by row, made every row carry a copy of it: the time grew with rows times rows of a run."""
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefghij") for _ in range(600))
    df = spark.createDataFrame([(i, passage[i:] if i % 3 else "short") for i in range(60)], "doc_id long, text string").coalesce(1)
    out = repeats.repeated_passages(df, 400)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "aggregate(" not in plan
    texts = [passage[i:] if i % 3 else "short" for i in range(60)]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == sorted(
        (str(i), *b) for i, b in enumerate(brute(texts, 400)))


def test_sliding_windows_of_any_width():
    x = np.random.default_rng(2).integers(0, 1000, 300)
    for width in (1, 2, 5, 63, 64):
        assert (repeats._sliding(np.minimum, x, width) == [x[i:i + width].min() for i in range(300 - width + 1)]).all()
