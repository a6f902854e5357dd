"""Periodic runs of words, found by a descending-LCP Kruskal over the suffixes of each text.

The suffixes of a text start as classes of one position each. The edges between
neighbours of the suffix order are taken by decreasing LCP; each unites two classes
(union-find), whose positions are kept in order. When the smaller class's positions
are put into the larger one, pairs of positions become neighbours; both suffixes
agree on exactly LCP words, so a pair at distance d within LCP spans a stretch with
period d that no word to the right extends. A stretch that no word to the left
extends either is a run; every run's first two period starts become neighbours this
way, because a position between them would give the run a smaller period.

A run of period q and length at least ``min_exponent`` times q has an LCP of length
less q, so edges below the smallest such LCP are never needed.

A null or empty text has no words and no runs. Repeated rows, ties and null ids are
rows of their own: nothing is looked up by id. Columns named like the results are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_bounded, ddl, renamed, slices

RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

#: Positions a block of an ordered set holds before it is cut in two.
BLOCK = 4096


def smallest_lcp(min_length: int, min_exponent: int) -> int:
    """The least LCP that the two first period starts of a wanted run can have, over all periods."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def suffix_neighbours(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the suffix order of each text that agree on at least ``least`` words.

    ``words`` are word numbers, ``text`` says whose they are (rising). Returns left and
    right positions and their LCP. Ranks are doubled, and only positions that
    share their rank with another are looked at again.
    """
    n = len(words)
    none = np.empty(0, np.int64)
    if n == 0:
        return none, none, none
    ends = np.searchsorted(text, text, side="right")
    rank = np.empty(n, np.int64)
    key = text.astype(np.int64) * (int(words.max()) + 1) + words
    active, levels, reach = np.arange(n), [], 1
    while True:
        order = np.argsort(key, kind="stable")
        at, sorted_key = active[order], key[order]
        first = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
        group = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        if reach == 1:
            rank[at] = group
        else:
            # Ranks count from the first place of the class that is being cut.
            old = rank[at]
            head = np.r_[True, old[1:] != old[:-1]]
            rank[at] = old + group - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        last = np.r_[first[1:], True]
        shared = at[~(first & last)]
        if len(shared) == 0:
            break
        levels.append((reach, shared, rank[shared].copy()))
        beyond = shared + reach
        inside = beyond < ends[shared]
        key = rank[shared] * (n + 1) + np.where(inside, rank[np.where(inside, beyond, 0)] + 1, 0)
        active, reach = shared, 2 * reach
    deep = next((level for level in reversed(levels) if level[0] <= least), None)
    if deep is None:
        return none, none, none
    _, places, classes = deep
    order = np.argsort(rank[places])
    places, classes = places[order], classes[order]
    same = classes[1:] == classes[:-1]
    left, right = places[:-1][same], places[1:][same]
    lcp = np.zeros(len(left), np.int64)
    dense = np.empty(n, np.int64)
    for reach, shared, ranks in reversed(levels):
        dense[:] = -1 - np.arange(n)
        dense[shared] = ranks
        a, b = left + lcp, right + lcp
        ok = (a < n) & (b < n)
        equal = np.zeros(len(left), bool)
        equal[ok] = dense[a[ok]] == dense[b[ok]]
        lcp[equal] += reach
    enough = lcp >= least
    return left[enough], right[enough], lcp[enough]


def _first(block: list[int]) -> int:
    return block[0]


def _insert(blocks: list[list[int]], x: int) -> tuple[int | None, int | None]:
    """Put a position into an ordered set; returns its neighbours there."""
    b = max(bisect_right(blocks, x, key=_first) - 1, 0) if len(blocks) > 1 else 0
    block = blocks[b]
    i = bisect_left(block, x)
    before = block[i - 1] if i else (blocks[b - 1][-1] if b else None)
    after = block[i] if i < len(block) else (blocks[b + 1][0] if b + 1 < len(blocks) else None)
    block.insert(i, x)
    if len(block) > BLOCK:
        blocks[b : b + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
    return before, after


def seeds(left: np.ndarray, right: np.ndarray, lcp: np.ndarray, min_exponent: int) -> list[tuple[int, int, int]]:
    """(position, distance, LCP) of newly adjacent positions whose distance lets the exponent be reached."""
    order = np.argsort(-lcp, kind="stable")
    places, numbers = np.unique(np.r_[left, right], return_inverse=True)
    half = len(left)
    a_of, b_of, lcps = numbers[:half][order].tolist(), numbers[half:][order].tolist(), lcp[order].tolist()
    parent, weight = list(range(len(places))), [1] * len(places)
    members: list = [[[p]] for p in places.tolist()]

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for a, b, common in zip(a_of, b_of, lcps):
        a, b = find(a), find(b)
        if weight[a] < weight[b]:
            a, b = b, a
        parent[b] = a
        weight[a] += weight[b]
        most, into, previous = common // (min_exponent - 1), members[a], None
        for block in members[b]:
            for x in block:
                before, after = _insert(into, x)
                # A neighbour from the same class was one before.
                if before is not None and before != previous and x - before <= most:
                    found.append((before, x - before, common))
                if after is not None and after - x <= most:
                    found.append((x, after - x, common))
                previous = x
        members[b] = None
    return found


def runs_of(words: np.ndarray, text: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period; starts count over all texts."""
    ends: dict[tuple[int, int], int] = {}
    for at, period, common in seeds(*suffix_neighbours(words, text, smallest_lcp(min_length, min_exponent)), min_exponent):
        extends = at > 0 and text[at - 1] == text[at] and words[at - 1] == words[at - 1 + period]
        if not extends and period + common >= max(min_length, min_exponent * period):
            # The same stretch is also found with multiples of its period.
            place = (at, period + common)
            ends[place] = min(period, ends.get(place, period))
    return sorted((start, length, period) for (start, length), period in ends.items())


def _texts(values: list[str | None], min_length: int, min_exponent: int) -> tuple[list[list[dict]], list[bytes]]:
    # Bytes split at exactly the six ASCII blanks that end a word.
    split = [(v or "").encode().split() for v in values]
    sizes = np.array([len(s) for s in split], np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    flat = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(split)), sizes)
    runs: list[list[dict]] = [[] for _ in split]
    gone: dict[int, np.ndarray] = {}
    for start, length, period in sorted(runs_of(flat, owner, min_length, min_exponent), key=lambda r: (r[0], r[2])):
        doc = int(owner[start])
        at = start - int(starts[doc])
        runs[doc].append({"start": at, "length": length, "period": period})
        gone.setdefault(doc, np.zeros(len(split[doc]), bool))[at + period : at + length] = True
    joined = [b" ".join(w for w, lost in zip(s, gone[i].tolist()) if not lost) if i in gone else b" ".join(s) for i, s in enumerate(split)]
    return runs, joined


def find_runs(df: DataFrame, text: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Add ``runs`` and ``collapsed`` to every row.

    A run is a longest stretch of words with smallest period q and at least
    ``min_length`` words and ``min_exponent`` (2 or more) periods; runs come by start,
    then period. ``collapsed`` is the text's words, one blank apart, without those that
    some run holds after its first period. Each row is worked on where it is: no shuffle.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    arrow_bounded(df.sparkSession)
    rows = renamed(df, ["runs", "collapsed"])

    def find(batches):
        for batch in batches:
            for part in slices(batch, text):
                runs, joined = _texts(part.column(text).to_pylist(), min_length, min_exponent)
                columns = [*part.columns, pa.array(runs, _ARROW_RUNS), pa.array(joined, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "runs", "collapsed"])

    return rows.mapInArrow(find, f"{ddl(rows)}, runs {RUNS_TYPE}, collapsed string")
