"""Which fingerprints occur in more than one place, found by exchanging Golomb-coded lists.

The rows are dealt into runs. Every run sends each owner, a range of the fingerprint space, its distinct 64-bit
fingerprints sorted and Golomb-Rice coded: about ``64 - log2(list length * owners)`` + 2 bits each. An owner merges
its lists and answers each with a bitmap, which the run reads against the list it has sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import cut_lineage, drop_stage

HASHES_PER_LIST = 64        # a list should hold as many hashes on average
LISTS = "run long, chunk string, owner int, n int, k int, code binary, local binary"
FLUSH_ROWS = 500_000      # fingerprints a task holds before it sends lists


def rice_code(values: np.ndarray) -> tuple[int, bytes]:
    """Golomb-Rice code of sorted distinct uint64 values: the parameter k, and the packed bits.

    The first value and then the gaps are written as quotient (unary, closed by a 0) and k low bits.
    """
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(values[-1]) / len(values)
    k = min(63, max(0, int(np.log2(max(mean, 1.0)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 0
    low = np.unpackbits(gaps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, count=k, bitorder="little")
    return k, np.packbits(np.concatenate([unary, low.ravel()])).tobytes()


def rice_decode(n: int, k: int, code: bytes) -> np.ndarray:
    """The ``n`` sorted values behind ``rice_code``."""
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    ends = np.flatnonzero(bits == 0)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    rest = np.zeros((n, 8), dtype=np.uint8)
    rest[:, :-(-k // 8)] = np.packbits(bits[ends[-1] + 1: ends[-1] + 1 + n * k].reshape(n, k), axis=1, bitorder="little")
    rest = rest.view("<u8").ravel()
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) + rest, dtype=np.uint64)


def _bounds(owners: int) -> np.ndarray:
    """First fingerprint of each owner's range."""
    return np.array([(i << 64) // owners for i in range(owners)], dtype=np.uint64)


def _arrays(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Run, fingerprints and marks of a batch: one item per run, or per row if the rows hold packed arrays."""
    if len(batch) and isinstance(batch["fp"].iloc[0], bytes):
        for run, fp, mark in zip(batch["run"], batch["fp"], batch["mark"], strict=True):
            yield run, np.frombuffer(fp, dtype=np.uint64), np.frombuffer(mark, dtype=bool)
    else:
        for run, group in batch.groupby("run"):
            yield run, group["fp"].to_numpy(np.int64).view(np.uint64), group["mark"].to_numpy(bool)


def _flags(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of marked pieces, marked if any of their occurrences is."""
    values, place = np.unique(np.concatenate([v for v, _ in pieces]), return_inverse=True)
    marks = np.zeros(len(values), dtype=bool)
    marks[place[np.concatenate([m for _, m in pieces])]] = True
    return values, marks


def _merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of marked pieces; values that come twice are marked too."""
    values, place, counts = np.unique(np.concatenate([v for v, _ in pieces]), return_inverse=True, return_counts=True)
    marks = counts > 1
    marks[place[np.concatenate([m for _, m in pieces])]] = True
    return values, marks


class Lists:
    """Collects marked fingerprints by run and codes them for their owners whenever enough are held.

    The coded lists are rows of ``LISTS``; ``name`` tells apart the senders of one run.
    """

    def __init__(self, owners: int, flagged: bool, name: object = ""):
        self.starts, self.flagged, self.name = _bounds(owners), flagged, name
        self.chunk, self.rows, self.held = 0, 0, {}

    def add(self, run: int, values: np.ndarray, marks: np.ndarray) -> list[tuple]:
        self.held.setdefault(run, []).append((values, marks))
        self.rows += len(values)
        return self.flush() if self.rows >= FLUSH_ROWS else []

    def flush(self) -> list[tuple]:
        out = []
        for run, pieces in self.held.items():
            values, marks = _flags(pieces) if self.flagged else _merged(pieces)
            cuts = [*np.searchsorted(values, self.starts), len(values)]
            for owner, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:
                    k, code = rice_code(values[a:b] - self.starts[owner])
                    out.append((run, f"{self.name}.{self.chunk}", owner, b - a, k, code, np.packbits(marks[a:b]).tobytes()))
        self.chunk, self.rows, self.held = self.chunk + 1, 0, {}
        return out

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["run", "chunk", "owner", "n", "k", "code", "local"])


def _lists(owners: int, flagged: bool):
    """mapInPandas: rows of (run, fp, mark) to coded lists; fp and mark are numbers or packed arrays of them."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lists = Lists(owners, flagged, TaskContext.get().partitionId())
        for batch in batches:
            out = []
            for item in _arrays(batch):
                out += lists.add(*item)
            if out:
                yield lists.frame(out)
        yield lists.frame(lists.flush())
    return encode


def _answers(flagged: bool):
    """applyInPandas by owner: for every list bitmaps of the fingerprints that are marked or occur in another list,
    and of those among them that it is the first list to have."""
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        return _answer(group, flagged)
    return answer


def _answer(group: pd.DataFrame, flagged: bool) -> pd.DataFrame:
    lists = [rice_decode(n, k, code) for n, k, code in zip(group["n"], group["k"], group["code"], strict=True)]
    local = [np.unpackbits(np.frombuffer(b, dtype=np.uint8))[:n].astype(bool)
             for b, n in zip(group["local"], group["n"], strict=True)]
    values, first, place, counts = np.unique(np.concatenate(lists), return_index=True, return_inverse=True, return_counts=True)
    found = np.zeros(len(values), dtype=bool) if flagged else counts > 1
    found[place[np.concatenate(local)]] = True
    twice, lead = found[place], np.zeros(len(place), dtype=bool)
    lead[first[found]] = True
    cuts = np.cumsum([len(x) for x in lists])[:-1]
    return pd.DataFrame({"run": group["run"], "chunk": group["chunk"], "owner": group["owner"],
                         "bits": [np.packbits(x).tobytes() for x in np.split(twice, cuts)],
                         "lead": [np.packbits(x).tobytes() for x in np.split(lead, cuts)]})


def _read(owners: int):
    """applyInPandas by run: its lists and the answers to the sorted fingerprints that were found, and that it leads."""
    def joined(parts: list[np.ndarray]) -> np.ndarray:
        values = np.sort(np.concatenate(parts).view(np.int64)) if parts else np.empty(0, np.int64)
        return values[np.diff(values, prepend=values[:1] - 1) != 0]     # no np.unique: its hashing is far slower than the sort

    def decode(group: pd.DataFrame) -> pd.DataFrame:
        starts, found, leads = _bounds(owners), [], []
        for owner, n, k, code, bits, lead in zip(*(group[c] for c in ("owner", "n", "k", "code", "bits", "lead")), strict=True):
            marked, led = (np.unpackbits(np.frombuffer(x, dtype=np.uint8))[:n].astype(bool) for x in (bits, lead))
            if marked.any():
                values = rice_decode(n, k, code) + starts[owner]
                found.append(values[marked])
                leads.append(values[led])
        return pd.DataFrame({"run": [group["run"].iloc[0]], "found": [joined(found)], "lead": [joined(leads)]})
    return decode


def owners_for(total: int, runs: int, rows_per_owner: int) -> int:
    """Owners for about ``total`` fingerprints, so that lists do not get too short."""
    return max(1, min(total // rows_per_owner, total // (HASHES_PER_LIST * max(1, runs))))


def answered(lists: DataFrame, owners: int, flagged: bool = False) -> DataFrame:
    """``run, found, lead`` for the coded lists of all runs, a table that is read twice."""
    answers = (lists.repartition(owners, "owner").groupBy("owner")
               .applyInPandas(_answers(flagged), "run long, chunk string, owner int, bits binary, lead binary"))
    return (lists.join(answers, ["run", "chunk", "owner"]).groupBy("run")
            .applyInPandas(_read(owners), "run long, found array<long>, lead array<long>"))


def exchanged(rows: DataFrame, total: int, runs: int, rows_per_owner: int, flagged: bool = False) -> DataFrame:
    """``run, found, lead``: each run's fingerprints that occur at least twice anywhere, as a sorted array of longs.

    Of all lists that have a found fingerprint one leads: that is noted in ``lead`` of its run.

    ``rows``: ``run, fp, mark`` with single values or packed arrays. A marked fingerprint is found in any
    case; with ``flagged`` only those are that some run has marked. ``total``: about how many there are.
    The result is a stage; the lists it was made from are deleted.
    """
    owners = owners_for(total, runs, rows_per_owner)
    lists = cut_lineage(rows.mapInPandas(_lists(owners, flagged), LISTS))
    found = cut_lineage(answered(lists, owners, flagged))
    drop_stage(lists)
    return found
