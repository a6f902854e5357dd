"""Isotonic regression without a task or driver that holds all of it.

The points are cut into ranges of the feature. Each range pools its adjacent
violators in its own task; then neighbouring lists of blocks are merged in a tree. What a
merge can change is known from two numbers: blocks of the left list that lie above the
right list's first block, and blocks of the right list that lie below the left
list's last one. Only these meet in a task, all others stay where they are. On a trend these are few;
where they are many, pooling has made them fewer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BLOCK = "part bigint, lo double, hi double, total double, weight double, lo_part bigint, hi_part bigint"
INFINITY = float("inf")


def pool(total: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(first, last, total, weight) of the blocks after pooling neighbours whose means fall."""
    done: list[tuple[int, int, float, float]] = []
    for i, (t, w) in enumerate(zip(total.tolist(), weight.tolist())):
        first = i
        # Means are compared crosswise; equal ones are pooled as well.
        while done and done[-1][2] * w >= t * done[-1][3]:
            first, _, more, heavy = done.pop()
            t, w = t + more, w + heavy
        done.append((first, i, t, w))
    return done


@dataclass
class Monotone:
    """``points`` (part, feature, total, weight) and ``blocks`` (lo, hi, value, weight, lo_part, hi_part), rising by ``lo``."""

    points: DataFrame
    blocks: DataFrame

    def fitted(self) -> DataFrame:
        """(feature, fitted) of every feature value seen: each range's points take the block begun last, its first ones the block it starts in."""
        seeds = self.blocks.select(F.explode(F.sequence("lo_part", "hi_part")).alias("part"), "lo_part", "lo", "value")
        seeds = seeds.select("part", F.when(F.col("part") == F.col("lo_part"), F.col("lo")).otherwise(F.lit(-INFINITY)).alias("feature"), "value")
        marked = self.points.select("part", "feature", F.lit(None).cast("double").alias("value")).unionByName(seeds)
        # A block's start comes before the point at the same value.
        order = Window.partitionBy("part").orderBy("feature", F.col("value").isNull()).rowsBetween(Window.unboundedPreceding, 0)
        found = marked.withColumn("fitted", F.last("value", ignorenulls=True).over(order))
        return found.where("value IS NULL").select("feature", "fitted")


def fit_monotone(df: DataFrame, label: str, feature: str, *, increasing: bool = True, ranges: int | None = None) -> Monotone:
    """Least-squares fit of a rising (or falling) step function of one feature.

    Rows with a null or NaN label or feature are left out. Rows of one feature value are
    merged first, with their number as weight, so a value held by most rows is no
    burden. ``ranges`` is the number of feature ranges, by default the shuffle's; the fit does not depend on it.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sign = 1.0 if increasing else -1.0
    named = df.select(F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{feature}`").cast("double").alias("feature"))
    named = named.where(F.col("y").isNotNull() & F.col("feature").isNotNull() & ~F.isnan("y") & ~F.isnan("feature"))
    merged = named.groupBy("feature").agg((sign * F.sum("y")).alias("total"), F.count(F.lit(1)).cast("double").alias("weight"))
    dealt = merged.repartitionByRange(ranges, "feature").sortWithinPartitions("feature").withColumn("part", F.spark_partition_id().cast("bigint"))
    points = stored(dealt, "monotone-points")

    def pooled(group: pd.DataFrame, part: int) -> pd.DataFrame:
        group = group.sort_values("lo")
        lo, hi, first_part, last_part = (group[c].to_numpy() for c in ("lo", "hi", "lo_part", "hi_part"))
        rows = [(part, lo[a], hi[b], t, w, first_part[a], last_part[b]) for a, b, t, w in pool(group["total"].to_numpy(), group["weight"].to_numpy())]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCK.split(", ")])

    single = points.select("part", F.col("feature").alias("lo"), F.col("feature").alias("hi"), "total", "weight", F.col("part").alias("lo_part"), F.col("part").alias("hi_part"))
    blocks = stored(single.groupBy("part").applyInPandas(lambda key, g: pooled(g, int(key[0])), BLOCK), "monotone-blocks")
    reach = 1
    while reach < ranges:
        blocks = stored(_merged(blocks, pooled), "monotone-blocks")
        reach *= 2
    value = sign * F.col("total") / F.col("weight")
    return Monotone(points.withColumn("total", sign * F.col("total")), blocks.select("lo", "hi", value.alias("value"), "weight", "lo_part", "hi_part"))


def _merged(blocks: DataFrame, pooled) -> DataFrame:
    """Lists 2n and 2n + 1 become list n."""
    mean = F.col("total") / F.col("weight")
    placed = blocks.withColumn("pair", F.shiftright("part", 1)).withColumn("left", F.col("part") % 2 == 0).withColumn("mean", mean)
    # Lists rise, so their first and last blocks are their least and greatest means.
    edges = placed.groupBy("pair").agg(F.min(F.when(~F.col("left"), F.col("mean"))).alias("right_first"), F.max(F.when(F.col("left"), F.col("mean"))).alias("left_last"))
    both = placed.join(edges, "pair")
    touched = F.coalesce(F.when(F.col("left"), F.col("mean") >= F.col("right_first")).otherwise(F.col("mean") <= F.col("left_last")), F.lit(False))
    names = [c.split()[0] for c in BLOCK.split(", ")]
    still = both.where(~touched).withColumn("part", F.col("pair")).select(*names)
    meeting = both.where(touched).withColumn("part", F.col("pair")).select(*names)
    return still.unionByName(meeting.groupBy("part").applyInPandas(lambda key, g: pooled(g, int(key[0])), BLOCK))
