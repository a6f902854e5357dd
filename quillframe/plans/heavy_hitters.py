"""The most frequent words by mergeable counters and one exact count over the words they leave open.

Each task keeps a bounded number of counters. When they are too many, the count of the
first one too many is taken off all of them, the emptied ones go, and what was taken off
adds to the task's error. Sketches merge by addition: a word's counts are summed, and so
are the errors, whatever the order. A word then occurs at least as often as its sum
says, and at most that plus the whole error; a word without counter at most as often as
the whole error.

So every word that can be among the most frequent is known, unless the error reaches the
least of the greatest sums. Then all words are counted. That is decided by the bound the
sketch itself gives, not by the size of the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partitions import explode_once
from ..session import stored
from .topics import vocabulary


def _pruned(counts: dict[str, int], counters: int) -> tuple[dict[str, int], int]:
    """At most ``counters`` counts left after the next largest one is taken off all, and that one."""
    if len(counts) <= counters:
        return counts, 0
    off = sorted(counts.values(), reverse=True)[counters]
    return {w: n - off for w, n in counts.items() if n > off}, off


def sketch(df: DataFrame, counters: int, tokens: str = "tokens") -> DataFrame:
    """(word, least) of the words with counters; the null word has the sum of the errors.

    A task holds twice ``counters`` words at most, besides those of one batch of rows,
    and sends ``counters`` rows and its error. Null words and arrays are left out.
    """
    if counters < 1:
        raise ValueError("at least one counter is needed")

    def count(batches):
        counts: dict[str, int] = {}
        error = 0
        for batch in batches:
            found = pc.value_counts(pc.drop_null(pc.list_flatten(batch.column(0))))
            for word, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                counts[word] = counts.get(word, 0) + n
            if len(counts) > 2 * counters:
                counts, off = _pruned(counts, counters)
                error += off
        counts, off = _pruned(counts, counters)
        yield pa.RecordBatch.from_arrays([pa.array([None, *counts], pa.string()), pa.array([error + off, *counts.values()], pa.int64())], ["word", "least"])

    parts = df.select(F.col(f"`{tokens}`").alias("tokens")).mapInArrow(count, "word string, least bigint")
    return parts.groupBy("word").agg(F.sum("least").alias("least"))


@dataclass
class HeavyHitters:
    """The most frequent words with their exact counts, and how they were found."""

    words: DataFrame
    error: int
    #: Words counted in the second pass; None if it counted all, 0 if the sketch was exact.
    candidates: int | None


def heavy_hitters(df: DataFrame, size: int, tokens: str = "tokens", counters: int = 1 << 16) -> HeavyHitters:
    """The ``size`` most frequent words, equal counts by the word, as ``vocabulary`` has them.

    ``df`` is read once for the sketch and once for the exact count, so it should be a
    stored table. Words that differ in nothing but their place are one; an empty input
    has no words.
    """
    found = stored(sketch(df, counters, tokens), "word-sketch")
    error = found.where(F.col("word").isNull()).agg(F.coalesce(F.sum("least"), F.lit(0))).first()[0]
    sums = found.where(F.col("word").isNotNull())
    best = F.desc("least"), F.col("word")
    if error == 0:
        return HeavyHitters(sums.select("word", F.col("least").alias("n")).orderBy(F.desc("n"), "word").limit(size), 0, 0)
    known, least = sums.orderBy(*best).limit(size).agg(F.count(F.lit(1)), F.min("least")).first()
    if known < size or error >= least:
        return HeavyHitters(vocabulary(df, size, tokens), error, None)
    # Below ``least`` no word can be among the first ``size``, since as many have that count for certain.
    able = stored(sums.where(F.col("least") + error >= least).select("word"), "word-candidates")
    return HeavyHitters(
        explode_once(df, F.col(f"`{tokens}`"), "word").join(able, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(size),
        error,
        able.count(),
    )
