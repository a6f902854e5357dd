"""The most frequent words by counters, against a full count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillframe.plans.heavy_hitters import heavy_hitters, sketch
from quillframe.plans.topics import vocabulary


def frame(spark, rows, parts):
    return spark.createDataFrame([(r,) for r in rows], "tokens array<string>").repartition(parts)


@pytest.fixture(scope="module")
def skewed():
    """One word is a third of all, twenty follow, and thousands come once."""
    pick = random.Random(7)
    common = [f"c{i % 20}" for i in range(4000)]
    words = ["hot"] * 4000 + common + [f"rare{i}" for i in range(4000)]
    pick.shuffle(words)
    return [words[i : i + 40] for i in range(0, len(words), 40)] + [None, [], [None, "hot"], [None]]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_counters_leave_few_words_open(spark, skewed, parts):
    df = frame(spark, skewed, parts)
    found = heavy_hitters(df, 15, counters=60)
    assert found.error > 0 and found.candidates is not None and 15 <= found.candidates <= 60 * parts
    assert found.words.collect() == vocabulary(df, 15).collect()  # equal counts by the word


def test_bounds_hold(spark, skewed):
    true = Counter(w for r in skewed for w in r or () if w is not None)
    rows = {r.word: r.least for r in sketch(frame(spark, skewed, 4), 50).collect()}
    error = rows.pop(None)
    assert all(n <= true[w] <= n + error for w, n in rows.items())
    assert all(n <= error for w, n in true.items() if w not in rows)
    assert error <= sum(true.values()) / 50


def test_error_bound_decides_on_the_full_count(spark):
    """Words of about one count leave everything open; few words leave nothing."""
    flat = frame(spark, [[f"w{i}" for i in range(j, j + 50)] for j in range(0, 2000, 10)], 4)
    found = heavy_hitters(flat, 30, counters=40)
    assert found.candidates is None and found.words.collect() == vocabulary(flat, 30).collect()
    small = frame(spark, [["b", "a"], ["a"], ["b"], ["c"]], 2)
    found = heavy_hitters(small, 2)
    assert (found.error, found.candidates) == (0, 0)
    assert [tuple(r) for r in found.words.collect()] == [("a", 2), ("b", 2)]


def test_nothing_to_count(spark):
    empty = frame(spark, [["a"]], 1).where("false").withColumn("n", F.lit(1))
    assert heavy_hitters(empty, 5).words.count() == 0
    assert heavy_hitters(frame(spark, [None, [], [None]], 2), 5).words.count() == 0
    with pytest.raises(ValueError):
        sketch(empty, 0)
