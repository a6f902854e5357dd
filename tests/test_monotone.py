"""Isotonic fits by ranges and tree against the min-max formula."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.plans.monotone import fit_monotone, pool


def min_max(points):
    """The fit at i is the greatest over starts up to i of the least mean from there to an end from i on."""
    xs = sorted({x for _, x in points})
    total, weight = np.zeros(len(xs)), np.zeros(len(xs))
    at = {x: i for i, x in enumerate(xs)}
    for y, x in points:
        total[at[x]] += y
        weight[at[x]] += 1
    ct, cw = np.r_[0, np.cumsum(total)], np.r_[0, np.cumsum(weight)]
    n = len(xs)
    return {xs[i]: max(min((ct[t + 1] - ct[s]) / (cw[t + 1] - cw[s]) for t in range(i, n)) for s in range(i + 1)) for i in range(n)}


RNG = random.Random(7)
SHAPES = {
    "noise": [(RNG.gauss(0, 1), RNG.randrange(60)) for _ in range(300)],
    "rising": [(float(i), i) for i in range(60)],
    "falling": [(-float(i), i) for i in range(60)],  # every range is pooled into its neighbour
    "saw": [(float(i % 8), i) for i in range(64)],
    "flat": [(1.0, i) for i in range(40)],
    "hot": [(5.0, 3)] * 200 + [(RNG.gauss(0, 3), RNG.randrange(30)) for _ in range(90)],
    "one": [(2.0, 1), (4.0, 1)],
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_equals_min_max(spark, name):
    points = SHAPES[name]
    frame = spark.createDataFrame([(float(y), float(x)) for y, x in points], "y double, x double").withColumn("part", F.lit("old"))
    ranges = 5 if name in ("noise", "falling") else 8
    got = {r.feature: r.fitted for r in fit_monotone(frame, "y", "x", ranges=ranges).fitted().collect()}
    want = min_max(points)
    assert sorted(got) == sorted(want)
    assert all(math.isclose(got[x], want[x], abs_tol=1e-9) for x in want)


def test_falling_and_left_out_rows(spark):
    points = SHAPES["noise"][:80]
    rows = [(float(y), float(x)) for y, x in points] + [(None, 1.0), (1.0, None), (math.nan, 2.0), (1.0, math.nan)]
    frame = spark.createDataFrame(rows, "y double, x double")
    fit = fit_monotone(frame, "y", "x", increasing=False, ranges=4)
    got = {r.feature: r.fitted for r in fit.fitted().collect()}
    want = {x: -v for x, v in min_max([(-y, x) for y, x in points]).items()}
    assert all(math.isclose(got[x], want[x], abs_tol=1e-9) for x in want) and len(got) == len(want)
    assert fit.blocks.agg(F.sum("weight")).first()[0] == 80
    assert fit_monotone(frame.where("false"), "y", "x", ranges=4).fitted().count() == 0


def test_pool_is_by_means():
    assert pool(np.array([1.0, 6.0, 2.0, 9.0]), np.array([1.0, 2.0, 1.0, 1.0])) == [(0, 0, 1.0, 1.0), (1, 2, 8.0, 3.0), (3, 3, 9.0, 1.0)]
