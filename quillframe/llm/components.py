"""Connected components of a large edge list by alternating stars.

Each round is two shuffles of rows of two numbers. A hub's neighbours are never
gathered in one task: minima are combined before the shuffle and joined back,
and the adaptive join splits a hub's rows. Every round is written to the shared
folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _stars(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs: (u, v). Every neighbour of u is tied to the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = pairs.join(least, "u")
    if large:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) for every id of ``edges`` (columns a, b); the component is its smallest id."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, before = stored(now, label), None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        grown = _stars(both, large=True).where("u <> v").distinct()
        now = stored(_stars(grown, large=False).where("u <> v").distinct(), label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots.select("id", F.col("id").alias("component")))
