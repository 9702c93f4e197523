"""Periodic runs of words by Lyndon roots, whose lengths come from the grouping phase of a suffix sorter.

The grouping phase puts suffixes with the same longest Lyndon prefix into one group, from the highest group to the
lowest, and never needs the second phase that would sort within groups: the length of a group's prefix, when its turn
comes, is the entry of the Lyndon array of all its members. Done under an order of the words and under its
opposite, this gives a root of every run. Roots are extended to both sides as far as words one period apart agree.

A word of a run with at least four periods stands in three-word sequences that occur at least three times in the text. So
a text is first cut, exactly, into stretches of such sequences; runs never cross their borders, and no stretch is limited.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

LEAST_WORDS, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start:long,length:long,period:long>>"


def lyndon_lengths(values: list[int]) -> list[int]:
    """For every position, the length of the longest Lyndon word that starts there; the end counts as smallest."""
    n = len(values)
    members: list[list[int]] = []       # of each group; those that have moved on are left in and skipped
    group, length, below = [0] * n, [], []
    first: dict[int, list[int]] = {}
    for i, v in enumerate(values):
        first.setdefault(v, []).append(i)
    for v in sorted(first):
        for i in first[v]:
            group[i] = len(members)
        below.append(len(members) - 1)
        members.append(first[v])
        length.append(1)
    above = [*range(1, len(members)), -1]
    left = list(range(-1, n))           # left[i + 1]: i if its group is still to come, else on the way to the nearest before
    out, g = [0] * n, len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g], size = own, length[g]
        for i in own:
            out[i] = size
            left[i + 1] = i - 1
        times: dict[int, int] = {}      # how often this group's word follows an earlier position's word
        for i in own:
            p = i
            while left[p + 1] != p:
                left[p + 1] = left[left[p + 1] + 1]     # halves the way for the next visitor
                p = left[p + 1]
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((k, group[p]), []).append(p)
        # u v^k is higher than u: next above it, and the more v the higher
        for k, old in sorted(moved, reverse=True):
            new = len(members)
            members.append(moved[k, old])
            for p in moved[k, old]:
                group[p] = new
            length.append(length[old] + k * size)
            below.append(old)
            above.append(above[old])
            below[above[old]] = new     # the highest group is never ``old``
            above[old] = new
        g = below[g]
    return out


def _agree(data: bytes, a: int, b: int, most: int) -> int:
    """How many of the next ``most`` words from ``a`` and ``b`` on are the same; 4 bytes a word."""
    low, step = 0, 1
    while low < most and data[4 * (a + low):4 * (a + min(low + step, most))] == data[4 * (b + low):4 * (b + min(low + step, most))]:
        low, step = min(low + step, most), 2 * step
    high = min(low + step, most)        # a difference lies before, unless all agree
    while low < high:
        mid = (low + high + 1) // 2
        if data[4 * (a + low):4 * (a + mid)] == data[4 * (b + low):4 * (b + mid)]:
            low = mid
        else:
            high = mid - 1
    return low


def _stretch_runs(words: np.ndarray) -> set[tuple[int, int, int]]:
    """Runs as (start, length, period) in a stretch of word numbers."""
    n, found = len(words), set()
    ahead, back = words.astype(np.int32).tobytes(), words[::-1].astype(np.int32).tobytes()
    top = int(words.max())
    for order in (words, top - words):
        roots = np.array(lyndon_lengths(order.tolist()))
        at = np.arange(n)
        fits = at + roots < n
        at, q = at[fits], roots[fits]
        # of four periods, the first whole root is followed by an equal one
        twice = (roots[at + q] == q) & (words[at] == words[at + q])
        ends: dict[int, int] = {}
        for i, p in zip(at[twice].tolist(), q[twice].tolist()):
            if i + p <= ends.get(p, 0):
                continue                # inside the run of this period just found
            right = _agree(ahead, i, i + p, n - i - p)
            before = _agree(back, n - i - p, n - i, i)
            ends[p] = i + p + right
            size = before + p + right
            if size >= max(LEAST_WORDS, LEAST_PERIODS * p):
                found.add((i - before, size, p))
    return found


def word_runs(words: list) -> list[tuple[int, int, int]]:
    """All runs of a text's words as (start, length, period), by start and period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    numbers: dict = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=n)
    triples = ids[:-2] * len(numbers) + ids[1:-1]
    if len(numbers) ** 3 >= 1 << 63:
        triples = np.unique(triples, return_inverse=True)[1]
    triples = triples * len(numbers) + ids[2:]
    order = np.argsort(triples, kind="stable")
    same = np.flatnonzero(np.diff(triples[order], prepend=-1))      # starts of equal triples
    sizes = np.diff(same, append=n - 2)
    often = np.zeros(n, dtype=bool)
    often[order] = np.repeat(sizes >= LEAST_PERIODS - 1, sizes) if n > 2 else False
    edges = np.flatnonzero(np.diff(often, prepend=False, append=False))
    runs: set[tuple[int, int, int]] = set()
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if hi + 2 - lo >= LEAST_WORDS:
            runs |= {(lo + s, size, p) for s, size, p in _stretch_runs(ids[lo:hi + 2])}
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, period in runs:
        edge[start + period] += 1
        edge[start + size] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(text: Column, keep_text: bool = True) -> Column:
    """``runs, collapsed_sha256, collapsed`` of a text: its runs by start and period, and what is left without repetitions.

    Words are what ASCII white space separates. A run is a stretch of consecutive words with smallest period q and at least
    6 and 4 * q words that neither neighbour extends. Collapsed text keeps words once, joined by one space; it is null without
    ``keep_text``. Null and empty texts have no runs and an empty collapsed text. The task holds one batch of texts.
    """
    @F.pandas_udf(f"runs {RUNS}, collapsed_sha256 string, collapsed string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                words = (text or "").encode("utf-8").split()
                runs = word_runs(words)
                left = b" ".join(collapse(words, runs))
                named = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                out.append((named, hashlib.sha256(left).hexdigest(), left.decode("utf-8") if keep_text else None))
            yield pd.DataFrame(out, columns=["runs", "collapsed_sha256", "collapsed"])
    return find(text)


def best_run(runs: Column) -> Column:
    """The run with the greatest exact length / period, ties by start and period; null without a run."""
    # one product decides between two quotients, so nothing is rounded
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"].cast("decimal(19,0)") * best["period"] > best["length"].cast("decimal(19,0)") * r["period"], r).otherwise(best))


def written(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
