import base64
import random

import pytest
import tiktoken

import public_tokenizers
from tests.llm.helpers import DOCS, none, odd
from tidemill.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def transducer(ranks):
    return bpe.Transducer(ranks)


def test_random_pieces(transducer, known):
    rng = random.Random(2)
    alphabet = ["a", "b", "e", "th", "er", "ing", "é", "日", "😀", "1", "!!", "=", "-", "Z", "\x00", "tion", "ou"]
    for _ in range(1500):
        piece = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))).encode()
        assert transducer.encode(piece) == known._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("piece", ["a" * 4000, " " * 3000, "=" * 2000, "ab" * 3000, "the" * 1500])
def test_long_pieces(transducer, known, piece, monkeypatch):
    monkeypatch.setattr(bpe, "PATH", 50)
    assert transducer.encode(piece.encode()) == known._core_bpe.encode_single_piece(piece.encode())


def test_forgetting_changes_nothing(ranks, known):
    pieces = bpe.Pieces(bpe.Transducer(ranks, (20, 10, 5)), 5)
    for word in "one two three four five six seven one two three extraordinary one".split() * 2:
        assert pieces[word] == " ".join(map(str, known.encode_ordinary(word)))


def test_tokens_are_certain_after_bounded_lookahead(transducer, ranks, known):
    longest, piece = max(map(len, ranks)), b"internationalizations" * 40
    state, path, out = transducer.start, [], []
    for byte in piece:
        state, origins = state[byte]
        path.append(origins)
        transducer._emit(path, state, out)
        assert len(path) <= longest
    whole = known._core_bpe.encode_single_piece(piece)
    assert out == whole[:len(out)] and len(out) >= len(whole) - longest


@pytest.mark.parametrize("cut", range(1, 5))
def test_streams_of_split_characters(cut):
    text = "aé日😀z" * 3
    data, stream = text.encode(), bpe.Utf8Stream()
    parts = [stream.feed(data[i:i + cut]) for i in range(0, len(data), cut)]
    assert "".join([*parts, stream.close()]) == text and not any("�" in p for p in parts)


def test_broken_streams_do_not_crash():
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe6\x97") + stream.feed(b"z\xff") + stream.close() == "a�z�"


def test_odd_rows_round_trip(spark, known):
    import hashlib
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = bpe.round_trip(odd(spark), bpe.load_ranks(spark, PATH), PATTERN, block=3).collect()
    want = []
    for i, text, *_ in DOCS:
        ids = known.encode_ordinary(text or "")
        want.append((str(i), len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_ids_and_texts(spark, known):
    shared = bpe.load_ranks(spark, PATH)
    ids = bpe.with_ids(odd(spark).drop("ids", "n_tokens"), shared, PATTERN)
    back = ids.select("doc_id", "ids", "n_tokens", bpe.decode(ids["ids"], shared, PATTERN).alias("text")).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t, *_ in DOCS)
    assert all(r.ids == known.encode_ordinary(r.text) and r.n_tokens == len(r.ids) for r in back)


def test_empty_table(spark):
    shared = bpe.load_ranks(spark, PATH)
    assert bpe.round_trip(none(spark), shared, PATTERN).collect() == []
    assert bpe.with_ids(none(spark), shared, PATTERN).collect() == []
