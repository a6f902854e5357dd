"""Quality rules as a cascade that stops at the first rule a text breaks.

Each rule has a cost, measured in seconds per text on a sample, and a
rejection rate on it; rules run in falling order of rejection per cost. The
order changes the time taken, never the verdict: a text is kept if it breaks
no rule. The sample is bounded by ``sample_rows`` and used for the order alone.

A null or empty text has no words. Clashing columns are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_bounded, ddl, renamed, slices

_CLASS = {name: np.frombuffer(chars, np.uint8) for name, chars in {"blank": b" \t\n\x0b\x0c\r", "symbol": b"#*$%&|<>", "shout": b"!"}.items()}
BASE_SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, broken string"


class Text:
    """A text and what the rules ask of it, each worked out when first asked."""

    def __init__(self, text: str | None):
        self.bytes = (text or "").encode()

    def __getattr__(self, name):
        value = getattr(type(self), f"_{name}")(self)
        setattr(self, name, value)
        return value

    def _histogram(self):
        return np.bincount(np.frombuffer(self.bytes, np.uint8), minlength=256)

    def _words(self):
        return self.bytes.split()

    def _n_words(self):
        return len(self.words)

    def _word_chars(self):
        h = self.histogram  # every byte that does not continue a character begins one
        return int(h[:128].sum() + h[192:].sum() - h[_CLASS["blank"]].sum())

    def _n_symbols(self):
        return int(self.histogram[_CLASS["symbol"]].sum())

    def _lines(self):
        return [line for line in self.bytes.split(b"\n") if line.strip()]

    def _n_dup_lines(self):
        return len(self.lines) - len(set(self.lines))

    def _ids(self):
        """A number for each word: equal words have equal ones, counted from 0."""
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)

    def _n_repeat_words(self):
        n = self.n_words
        if n < 6:
            return 0
        one = self.ids
        if one.max() == n - 1:
            return 0

        def paired(a, b):  # ids of pairs; exact, as both sides are below n
            return np.unique(a * n + b, return_inverse=True)[1]

        two = paired(one[:-1], one[1:])
        if two.max() + 1 == n - 1:
            return 0
        four = paired(two[:-2], two[2:])
        windows = four[:-1] * n + one[4:]
        _, at, count = np.unique(windows, return_inverse=True, return_counts=True)
        edge = np.zeros(n + 1, np.int64)
        twice = np.flatnonzero(count[at] > 1)
        np.add.at(edge, twice, 1)
        np.add.at(edge, twice + 5, -1)
        return int((np.cumsum(edge[:-1]) > 0).sum())

    def _ascii_letters(self):
        return int(self.histogram[65:91].sum() + self.histogram[97:123].sum())


@dataclass(frozen=True)
class Rule:
    """A name and a test that is true for a text that breaks the rule."""

    name: str
    broken: Callable[[Text], bool]


#: Words of a window in which distinct ones are counted; shorter texts are one window.
WINDOW = 1000


def _distinct_share(t: Text, window: int = WINDOW) -> float:
    """Share of distinct words, as the mean over all windows of the text, so that it doesn't fall with its length."""
    n, at = t.n_words, np.arange(t.n_words)
    window = min(window, n)
    by_word = np.argsort(t.ids, kind="stable")
    again = t.ids[by_word[1:]] == t.ids[by_word[:-1]]
    before = np.full(n, -1)
    before[by_word[1:][again]] = by_word[:-1][again]
    # A word is counted in the windows that hold it and begin after the one before it.
    counted = np.minimum(at, n - window) - np.maximum(before, at - window)
    return int(np.maximum(counted, 0).sum()) / ((n - window + 1) * window)


#: The base rules decide ``base_failed``; a text that breaks one runs no other rule.
BASE = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
#: Thresholds far from ordinary prose of any language: clean texts break none of them.
RULES = (
    Rule("symbols", lambda t: t.n_symbols > 0.3 * t.n_words),
    Rule("shouting", lambda t: t.histogram[_CLASS["shout"]].sum() > 0.5 * t.n_words),
    Rule("capitals", lambda t: t.ascii_letters > 0 and t.histogram[65:91].sum() > 0.6 * t.ascii_letters),
    Rule("duplicate_lines", lambda t: len(t.lines) >= 4 and t.n_dup_lines > 0.5 * len(t.lines)),
    Rule("word_length", lambda t: not 1.5 <= t.word_chars / max(1, t.n_words) <= 25),
    Rule("few_distinct_words", lambda t: t.n_words >= 50 and _distinct_share(t) < 0.05),
)


def cascade_order(df: DataFrame, text: str, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, seed: int = 7) -> list[Rule]:
    """Rules by rejection per second on a sample, greatest first; equal ones by name.

    Every row is in the sample with the same chance, ``sample_rows`` of them on
    average, and is measured in the task that reads it: no text is moved. A rule's cost is
    what it takes on a text of which nothing has been worked out yet.
    """
    full = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    share = min(1.0, sample_rows / max(1, df.count()))
    sample = df.select(full.alias("text")).sample(share, seed) if share < 1 else df.select(full.alias("text"))

    def measure(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = []
            for rule in rules:
                start = time.perf_counter()
                broken = sum(bool(rule.broken(Text(t))) for t in texts)
                rows.append((rule.name, time.perf_counter() - start, broken))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["name", "seconds", "broken"])

    found = sample.mapInArrow(measure, "name string, seconds double, broken bigint").groupBy("name").agg(F.sum("seconds").alias("s"), F.sum("broken").alias("b"))
    gain = {r.name: r.b / max(r.s, 1e-9) for r in found.collect()}
    return sorted(rules, key=lambda r: (-gain.get(r.name, 0.0), r.name))


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """Add the base counts, ``base_failed``, ``kept`` and ``broken`` (the rule that rejected, else null)."""
    arrow_bounded(df.sparkSession)
    order = cascade_order(df, text, rules, sample_rows)
    names = [part.split()[0] for part in BASE_SCHEMA.split(",")]
    rows = renamed(df, names)
    columns = rows.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                out = []
                for value in part.column(text).to_pylist():
                    t = Text(value)
                    failed = next((r.name for r in BASE if r.broken(t)), None)
                    broken = failed or next((r.name for r in order if r.broken(t)), None)
                    out.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed is not None, broken is None, broken))
                made = zip(*out) if out else [[] for _ in names]
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(list(v), k) for v, k in zip(made, kinds))], [*columns, *names])

    return rows.mapInArrow(run, f"{ddl(rows)}, {BASE_SCHEMA}")
