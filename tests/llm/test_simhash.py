import random

import numpy as np
import xxhash

from tests.llm.helpers import CLASHES, DOCS, none, odd
from tidemill.llm import simhash


def plain(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, radius):
    """Smallest place reachable, by comparing every two points."""
    label = list(range(len(points)))
    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def clusters(rng, n, radius):
    out = []
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 120])):
            x = centre
            for _ in range(rng.randrange(2 * radius)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
            centre = x if rng.random() < 0.3 else centre
    return list(dict.fromkeys(out))


def test_fingerprints(spark):
    got = simhash.simhash_groups(odd(spark)).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{plain(t):016x}") for i, t, *_ in DOCS)
    blank = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert blank == {4}


def test_tree_finds_all_links():
    points = clusters(random.Random(3), 700, 4)
    links = simhash.Links(len(points))
    array = np.array(points, dtype=np.uint64)
    simhash.vantage_links(array, np.arange(len(points)), 4, links)
    assert links.label.tolist() == groups(points, 4)


def test_components_of_random_fingerprints(spark):
    points = clusters(random.Random(4), 500, 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4)
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    want, seen = groups(points, 4), {}
    for place, fp in zip(want, signed, strict=True):
        assert seen.setdefault(place, root.get(fp, fp)) == root.get(fp, fp)
    assert len(seen) == len(set(want)) == len({root.get(s, s) for s in signed})


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {root[i] for i in range(201)} == {0} and root[501] == 500


def test_one_row_of_each_group_stays(spark):
    df = odd(spark)
    kept = simhash.drop_near_duplicates(df).collect()
    best = {}
    for r in simhash.simhash_groups(df).collect():
        best.setdefault(r.component_id, r.doc_id)
    assert {r.doc_id for r in kept} == set(best) and all(r[c] == f"own {c}" for r in kept for c in CLASHES)


def test_empty_table(spark):
    assert simhash.simhash_groups(none(spark)).collect() == [] and simhash.drop_near_duplicates(none(spark)).collect() == []


def test_whole_table_against_all_pairs(spark, sf):
    """Fingerprints by definition and components of all pairs, end to end."""
    import re

    import xxhash

    from tidemill.llm.queries import QUERIES

    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: fingerprint(r.text) for r in docs}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(fps)
    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = QUERIES["op2_simhash_vantage"](spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", find(i)) for i in ids} and len(got) == len(ids)
