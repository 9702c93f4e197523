"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

A token sequence is what the merges produce exactly if every two neighbours are: undoing the merges across
their border, latest first, never meets a merge that would have come earlier. So a nondeterministic
transducer can read bytes, walk the trie of the tokens, and end a token only where it fits the one
before; just one run survives to the end of a piece. The subset construction keeps the live runs as one
state; a transition notes from which run each of its runs comes and the token that ended. Two runs part for at most
the length of the longest token, so after that lookahead they have one origin and the tokens up to it
are emitted. States and transitions are made when first met.

Texts are first cut by the tokenizer's pattern; every piece is read separately from the start state.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# what a worker remembers: states of the automaton (half a kilobyte each; it is emptied when full and built anew), pairs of tokens whose
# fit is known, and pieces since the last turn (as many from before it are kept)
FULL = (260_000, 350_000, 200_000)
LEAN = (120_000, 150_000, 100_000)      # 80 MB less a worker, and half as much time again: for tasks that hold token ids as well
PATH = 4096              # transitions kept before the tokens that are certain are emitted
NONE = 1 << 31           # no token, and later than any merge
SLICE_BYTES = 1 << 20    # of texts whose ids are made before they are sent on
_NODE, _PLACE = (1 << 24) - 1, (1 << 12) - 1    # bits of a run that hold its node, and of an origin that hold its place


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary of a rank file (one base64 token and its rank a line), sent to the workers.

    Only the driver needs the file. Its size is a fixed property of the tokenizer, and so the bound of what is
    broadcast. The workers keep their automaton beside it, so one broadcast serves all queries of an application.
    """
    sent = spark.sparkContext.__dict__.setdefault("_tidemill_vocabularies", {})
    if path not in sent:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        sent[path] = spark.sparkContext.broadcast({"ranks": ranks})
    return sent[path]


class State(dict):
    """Maps bytes to ``(state, origins)``; ``origins`` has for each run of that state the place of the run it comes from
    and, above these bits, one more than the token that ended, if any. A transition is made when it is first taken.
    """

    __slots__ = ("runs", "owner")

    def __init__(self, runs: tuple, owner: Transducer):
        super().__init__()
        self.runs, self.owner = runs, owner

    def __missing__(self, byte: int) -> tuple[State, tuple]:
        step = self[byte] = self.owner.step(self, byte)
        return step


class Transducer:
    """Encodes pieces of bytes; ``ranks`` gives every token's id, which is also the order of its merge.

    A trie node is a number; its dict maps a byte to ``(node or 0, token or -1)``. A run of the nondeterministic machine is one
    number, too: one more than the last token (0: none yet), and the node in the low bits.
    """

    def __init__(self, ranks: dict[bytes, int], sizes: tuple[int, int, int] = FULL):
        self.ranks, (self.max_states, self.max_fits, _) = ranks, sizes
        self.parts: dict[int, tuple[int, int]] = {}     # of longer tokens, the two of their last merge
        self.merges: dict[int, int] = {}                # two tokens as one number, to the token they make
        self.fits: dict[int, bool] = {}
        self.nodes: list[dict[int, tuple[int, int]]] = [{}]     # the first is the root
        for token in sorted(ranks, key=len):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merges[left << 32 | right] = ranks[token]
            if self._last_merge(token) is not None:
                node = self.nodes[0]
                for byte in token[:-1]:
                    below, end = node.get(byte, (0, -1))
                    if not below:
                        below = len(self.nodes)
                        self.nodes.append({})
                        node[byte] = (below, end)
                    node = self.nodes[below]
                below, _ = node.get(token[-1], (0, -1))
                node[token[-1]] = (below, ranks[token])
        self._forget()

    def _forget(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()       # states point at each other; without this only a full garbage collection frees them
        self.start = State((0,), self)
        self.states: dict[tuple, State] = {}
        self.origins: dict[tuple, tuple] = {}       # equal ones are kept once

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; itself twice for a byte, None if no merges lead to it."""
        whole = self.ranks[token]
        pieces = [token[i:i + 1] for i in range(len(token))]
        if any(p not in self.ranks for p in pieces):
            return None
        while len(pieces) > 2:
            rank, at = min((self.ranks.get(pieces[i] + pieces[i + 1], whole), i) for i in range(len(pieces) - 1))
            if rank >= whole:
                return None
            pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
        made = self.ranks[pieces[0]], self.ranks[pieces[-1]]
        if len(pieces) == 2:
            self.parts[whole] = made
        return made

    def _fit(self, left: int, right: int) -> bool:
        """Whether the merges of ``left`` and ``right`` next to each other leave exactly these two tokens."""
        # step back through the merges on both sides of the border; ``when`` is the merge undone last
        merges, parts, when = self.merges, self.parts, NONE
        while True:
            if merges.get(left << 32 | right, NONE) < when:
                return False
            split, other = parts.get(left), parts.get(right)
            if split is None and other is None:
                return True
            if other is None or (split is not None and left > right):
                when, left = left, split[1]
            else:       # of equal merges the left one comes first, so one across the border would win
                when, right = right + 1, other[0]

    def step(self, state: State, byte: int) -> tuple[State, tuple]:
        """The transition of ``state`` on ``byte``."""
        runs, origins, fits, nodes = [], [], self.fits, self.nodes
        for place, run in enumerate(state.runs):
            entry = nodes[run & _NODE].get(byte)
            if entry is None:
                continue
            below, token = entry
            if below:
                runs.append(run & ~_NODE | below)
                origins.append(place)
            if token >= 0:
                last = (run >> 24) - 1
                pair = last << 32 | token
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = last < 0 or self._fit(last, token)
                if fit:
                    runs.append(token + 1 << 24)
                    origins.append(token + 1 << 12 | place)
        runs, origins = tuple(runs), tuple(origins)
        following = self.states.get(runs)
        if following is None:
            following = self.states[runs] = State(runs, self)
        return following, self.origins.setdefault(origins, origins)

    @staticmethod
    def _emit(path: list, state: State, out: list[int]) -> None:
        """Move the tokens that all runs of the state have in common from the path to ``out``."""
        places, at = set(range(len(state.runs))), len(path)
        while at and len(places) > 1:
            at -= 1
            places = {path[at][place] & _PLACE for place in places}
        place, tokens = places.pop(), []
        for origins in reversed(path[:at]):
            token, place = origins[place] >> 12, origins[place] & _PLACE
            if token:
                tokens.append(token - 1)
        out += reversed(tokens)
        del path[:at]

    def encode(self, piece: bytes) -> list[int]:
        """The token ids of one piece."""
        if len(self.states) > self.max_states:
            self._forget()
        if len(self.fits) > self.max_fits:
            self.fits.clear()
        state, path, out = self.start, [], []
        for byte in piece:
            state, origins = state[byte]
            path.append(origins)
            if len(path) >= PATH:
                self._emit(path, state, out)
        tokens = []
        for place, run in enumerate(state.runs):
            if not run & _NODE:
                for origins in reversed(path):
                    origin = origins[place]
                    place = origin & _PLACE
                    if origin > _PLACE:
                        tokens.append((origin >> 12) - 1)
                break
        tokens.reverse()
        return out + tokens if out else tokens


class Pieces(dict):
    """Remembered pieces: each is mapped to its token ids, written with spaces.

    A full table becomes the old one, from which pieces in use come back, so rare ones fall out.
    """

    def __init__(self, transducer: Transducer, most: int = FULL[2]):
        super().__init__()
        self.transducer, self.most, self.old = transducer, most, {}

    def __missing__(self, piece: str) -> str:
        ids = self.old.get(piece)
        if ids is None:
            ids = " ".join(map(str, self.transducer.encode(piece.encode())))
        if len(self) >= self.most:
            self.old = {}       # freed before the copy is made
            self.old = dict(self)
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids


class Utf8Stream:
    """Decodes bytes as they come: what is complete is returned, an unfinished character is kept for later.

    The state is the number of bytes the open character still needs. It is found from the last bytes alone.
    """

    def __init__(self) -> None:
        self.tail = b""

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """How many bytes at the end belong to a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                needs = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if needs > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.tail + data
        cut = len(data) - self.open_bytes(data)
        self.tail = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.tail = self.tail, b""
        return rest.decode("utf-8", "replace")


def _tools(vocabulary: Broadcast, pattern: str, sizes: tuple[int, int, int] = FULL):
    """A worker's piece cutter and piece table, made once and kept beside the vocabulary."""
    import regex

    kept = vocabulary.value
    if kept.get("made") != (pattern, sizes):
        gc.set_threshold(500_000, 10, 1000)     # states and pieces are no garbage; scanning them often is costly
        kept |= {"made": (pattern, sizes), "cut": regex.compile(pattern).findall, "pieces": Pieces(Transducer(kept["ranks"], sizes), sizes[2])}
    return kept["cut"], kept["pieces"]


def _written(vocabulary: Broadcast) -> dict[str, bytes]:
    """The bytes of every token, by its written id."""
    kept = vocabulary.value
    if "written" not in kept:
        kept["written"] = {str(i): t for t, i in kept["ranks"].items()}
    return kept["written"]


def _encoded(text: str | None, cut, pieces: Pieces) -> str:
    return " ".join([pieces[p] for p in cut(text or "")])


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The rows of the batches in parts of about ``SLICE_BYTES``, so that memory does not depend on the rows of a batch."""
    for batch in batches:
        rows = max(1, len(batch) * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, max(1, len(batch)), rows):
            yield batch.slice(at, rows)


def encode(text: Column, vocabulary: Broadcast, pattern: str, sizes: tuple[int, int, int] = LEAN) -> Column:
    """The token ids of ``text`` as an array; empty for an empty or null text. ``sizes`` bounds what a worker remembers."""
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cut, pieces = _tools(vocabulary, pattern, sizes)
        for batch in _slices(batches):
            tokens = [np.fromstring(_encoded(t.as_py(), cut, pieces), dtype=np.int32, sep=" ") for t in batch]
            ends = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            yield pa.ListArray.from_arrays(ends, np.concatenate(tokens) if tokens else np.empty(0, np.int32))
    return ids(text)


def with_ids(docs: DataFrame, vocabulary: Broadcast, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by ``n_tokens`` and ``ids``, which hide columns of these names."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "n_tokens", "ids")]
    ids = docs.select(*kept, encode(F.col(text_col), vocabulary, pattern).alias("ids"))
    return ids.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids")


def decode(ids: Column, vocabulary: Broadcast, pattern: str, block: int = 4096) -> Column:
    """The text behind an array of token ids, decoded block by block; null for null.

    Bytes that are no UTF-8 come out as replacement characters.
    """
    def text_of(tokens: Iterable[int], by_id: dict[str, bytes]) -> str:
        stream, out, tokens = Utf8Stream(), [], list(tokens)
        for at in range(0, len(tokens), block):
            out.append(stream.feed(b"".join(by_id[str(i)] for i in tokens[at:at + block])))
        return "".join([*out, stream.close()])

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        written = _written(vocabulary)
        for batch in batches:
            yield pa.array([None if t is None else text_of(t, written) for t in (x.as_py() for x in batch)], pa.string())
    return texts(ids)


def round_trip(docs: DataFrame, vocabulary: Broadcast, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row per input row: ``id_col, n_tokens, ids_sha256, decoded_sha256``, without moving the ids.

    A null text is empty: no tokens, and the digests of nothing. Repeated rows and ids keep a row each.
    """
    def of(text: str | None, cut, pieces: Pieces, written: dict[str, bytes]) -> tuple[int, str, str]:
        ids = _encoded(text, cut, pieces)
        tokens, stream, seen = ids.split(), Utf8Stream(), hashlib.sha256()
        for at in range(0, len(tokens), block):
            seen.update(stream.feed(b"".join(map(written.__getitem__, tokens[at:at + block]))).encode())
        seen.update(stream.close().encode())
        return len(tokens), hashlib.sha256(ids.encode()).hexdigest(), seen.hexdigest()

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tools = *_tools(vocabulary, pattern), _written(vocabulary)
        for batch in batches:
            columns = list(zip(*(of(t.as_py(), *tools) for t in batch), strict=True)) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col), digest(F.col(text_col)).alias("d")).select(id_col, "d.*")
