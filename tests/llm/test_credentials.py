import random
import re

from tests.llm.helpers import DOCS, none, odd
from tidemill.llm import credentials


def spans(text):
    """All reported spans, by comparing every two matches."""
    parts = []
    for number, (kind, pattern, group, least, role) in enumerate(credentials.KINDS):
        parts += [(m.start(), number, kind, m.end(), role) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    near = lambda p, role: any(q[4] == role and q is not p and q[3] >= p[0] - credentials.SCOPE
                               and q[0] <= p[3] + credentials.SCOPE for q in parts)
    out = []
    for p in parts:
        if p[1] >= credentials.SURE:
            if any(q[1] < credentials.SURE and q[0] < p[3] and q[3] > p[0] for q in parts):
                continue
            needs = {"identifier": ["secret"], "secret": ["identifier"], "endpoint": ["identifier", "secret"]}[p[4]]
            if not all(near(p, r) for r in needs):
                continue
        out.append(p[:4])
    return sorted(out)


def found(df):
    return [(r.doc_id, [(s.start, s.kind_no, s.kind, s.end) for s in r.spans]) for r in credentials.find_secrets(df).collect()]


def test_odd_rows(spark):
    want = sorted((str(i), spans(t)) for i, t, *_ in DOCS)
    assert sorted((str(i), s) for i, s in found(odd(spark))) == want


def test_random_texts(spark):
    rng = random.Random(5)
    bits = ["token=", "secret: \"", "user=bob77", "AKIA" + "Z9" * 9, "https://db.example.com/x?y=1", "0af3" * 7, " and ", "é日😀 ",
            "Q7" * 17, "passwd=short", "pass=abc", "api_key='abcdef.123' ", "client_id: 12345 ", "\n", " " * 150, "token=token: abcdefgh"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for i in range(300)]
    got = dict(found(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == {i: spans(t) for i, t in docs}


def test_weak_parts_need_each_other(spark):
    docs = [(1, "user=robert and nothing else"), (2, "user=robert, " + "aB3" * 12), (3, "see https://example.com/page"),
            (4, "user=robert " + "." * 300 + " " + "aB3" * 12)]
    got = dict(found(spark.createDataFrame(docs, "doc_id long, text string")))
    assert [len(got[i]) for i in (1, 2, 3, 4)] == [0, 2, 0, 0]


def test_empty_table(spark):
    assert credentials.find_secrets(none(spark)).collect() == []


def test_no_python_in_the_plan(spark, sf, capsys):
    credentials.find_secrets(spark.read.parquet(f"{sf}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan) and plan.count("Exchange") == 1
