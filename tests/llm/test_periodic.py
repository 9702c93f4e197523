import hashlib
import random
import re
import zlib
from fractions import Fraction

from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, LONG, none, odd
from tidemill.llm import periodic, queries


def lyndon_by_definition(v):
    def lyndon(s):
        return all(s < s[k:] for k in range(1, len(s)))
    return [max(j - i for j in range(i + 1, len(v) + 1) if lyndon(v[i:j])) for i in range(len(v))]


def runs_by_definition(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in gone]


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(1500):
        letters = rng.choice([1, 2, 3, 4])
        v = [rng.randrange(letters) for _ in range(rng.randint(1, 14))]
        assert periodic.lyndon_lengths(v) == lyndon_by_definition(v)


def test_runs_and_collapsed_words():
    rng = random.Random(2)
    for _ in range(1500):
        letters, w = rng.choice([1, 2, 3, 5]), []
        for _ in range(rng.randint(1, 6)):
            w += ([rng.randrange(letters) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7))[:rng.randint(1, 30)]
        runs = periodic.word_runs(w)
        assert runs == runs_by_definition(w) and periodic.collapse(w, runs) == collapsed(w, runs)


def test_long_periods():
    rng = random.Random(3)
    w = [rng.randrange(40) for _ in range(2500)]
    assert periodic.word_runs(["x", "y"] + w * 5 + ["z"]) == [(2, 12500, 2500)]
    assert periodic.word_runs(["a"] * 30_000) == [(0, 30_000, 1)]


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in queries.QUERIES["op13_lyndon_runs"](spark, sf).collect():
        w, h = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or ""), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if n > 1500:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = runs_by_definition(w)
        found += len(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None, None, None)))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(collapsed(w, runs)).encode()).hexdigest()
    assert found > 5


def test_odd_rows(spark):
    df = odd(spark).withColumn("text", F.when(F.col("doc_id") == 2, "no no no no no no é é é é é é").otherwise(F.col("text")))
    got = df.select("doc_id", "text", periodic.periodic_runs(F.col("text")).alias("r")).collect()
    assert len(got) == len(DOCS)
    for r in got:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = [tuple(x) for x in r.r.runs]
        assert r.r.collapsed == " ".join(collapsed(w, runs)) and hashlib.sha256(r.r.collapsed.encode()).hexdigest() == r.r.collapsed_sha256
        if r.doc_id == 2:
            assert runs == [(0, 6, 1), (6, 6, 1)] and r.r.collapsed == "no é"
        elif r.text != LONG and r.text != LONG + " tail":
            assert runs == runs_by_definition(w)
    assert none(spark).select(periodic.periodic_runs(F.col("text"))).collect() == []


def test_best_run_is_exact_and_ties_go_left(spark):
    df = spark.createDataFrame([([(0, 13, 3), (20, 26, 6), (50, 13, 3)],), ([],), ([(5, 10**9 + 1, 10**8), (1, 10**9, 10**8 - 1)],)], "runs " + periodic.RUNS)
    got = [r.b for r in df.select(periodic.best_run(F.col("runs")).alias("b")).collect()]
    assert [tuple(b) if b else None for b in got] == [(0, 13, 3), None, (1, 10**9, 10**8 - 1)]
    assert df.select(periodic.written(F.col("runs")).alias("w")).collect()[0].w == "0,13,3\n20,26,6\n50,13,3\n"
