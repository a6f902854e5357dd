"""Joins, aggregations, sets and ordered limits.

Joins carry no hints: Catalyst and AQE broadcast a side only after its size is
known, and AQE splits the shuffle partitions of hot keys. Aggregations use
Spark's map-side combine, so a hot key reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import row_maximum
from ..session import stored
from .partitions import explode_once


def join_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner equi-join; several matches multiply."""
    return left.join(right, key, "inner")


def join_self(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Join a frame of (key, value) pairs with itself on the key, per left pair.

    Gives each distinct pair with its number of copies, and with the number of
    rows it has in the joined frame. A key with n rows has n * n joined rows;
    they are counted here without being made, from one row per key on the
    right side. To have the joined rows themselves, use ``join_pairs`` with
    the same frame twice.
    """
    merged = pairs.groupBy(key, value).agg(F.count(F.lit(1)).alias("copies"))
    partners = merged.groupBy(key).agg(F.sum("copies").alias("partners"))
    return merged.join(partners, key).select(
        key, value, "copies", (F.col("copies") * F.col("partners")).alias("joined")
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns all at once, so that two may swap their names."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def rows_in(df: DataFrame, members: DataFrame, key: str, member_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``members`` (null never does)."""
    found = members.select(F.col(member_key or key).alias(key))
    return df.join(found, key, "left_semi")


def subtract_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Drop every row equal to a row of ``other``; other duplicates stay.

    Null equals null here. ``other`` is reduced to distinct rows first.
    """
    gone = other.select(df.columns).distinct().alias("gone")
    same = reduce(
        lambda a, b: a & b, [F.col(f"kept.`{c}`").eqNullSafe(F.col(f"gone.`{c}`")) for c in df.columns]
    )
    return df.alias("kept").join(gone, same, "left_anti")


def set_difference(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``other``."""
    return df.subtract(other.select(df.columns))


def limit_rows(df: DataFrame, n: int, *keys: str, direct: int = 10_000) -> DataFrame:
    """The first ``n`` rows by ``keys``, or all rows when ``n`` is not positive.

    Rows with equal keys go by a hash of their whole content, so the choice does
    not depend on the partitions. Only keys and hashes are compared to find the
    cut; the rows stay where they are, so what follows still runs on all partitions.
    Up to ``direct`` rows the first keys meet in one task; beyond, the cut is found
    by the sizes of ranges, and one range is sorted.
    """
    if n <= 0:
        return df
    place = F.struct(*[F.col(k) for k in keys], F.xxhash64(*df.columns).alias("_content"))
    placed = df.withColumn("_place", place)
    found = _first_cut(placed, n) if n <= direct else _range_cut(placed, n)
    if found is None:
        return df
    cut, taken = found
    kinds = placed.schema["_place"].dataType.fields
    at = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, kinds)])
    same = placed.where(F.col("_place") == at)
    if same.count() == taken:
        return placed.where(F.col("_place") <= at).drop("_place")
    # Rows at the cut are alike in every column, so it does not matter which of them are taken.
    return placed.where(F.col("_place") < at).unionByName(same.limit(taken)).drop("_place")


def _first_cut(placed: DataFrame, n: int):
    """The last place of the first ``n`` rows and how many of them have it; None if there are fewer rows."""
    first = placed.select("_place").orderBy("_place").limit(n)
    per_place = first.groupBy("_place").agg(F.count(F.lit(1)).alias("n"))
    found, cut = per_place.agg(F.sum("n"), F.max(F.struct("_place", "n"))).first()
    return None if found is None or found < n else (cut["_place"], cut.n)


def _range_cut(placed: DataFrame, n: int):
    """As ``_first_cut``; places are counted, dealt out in ranges, and only the range of the cut is gone through.

    Equal places are one row before they are dealt out, so repeated rows make no range large.
    """
    counted = placed.groupBy("_place").agg(F.count(F.lit(1)).alias("n"))
    ranged = stored(counted.repartitionByRange("_place").withColumn("_range", F.spark_partition_id()), "limit-ranges")
    before = 0
    for part in ranged.groupBy("_range").agg(F.sum("n").alias("n")).orderBy("_range").toLocalIterator():
        if before + part.n >= n:
            upto = F.sum("n").over(Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + before
            placed_upto = ranged.where(F.col("_range") == part["_range"]).withColumn("upto", upto)
            cut = placed_upto.where(F.col("upto") >= n).orderBy("_place").first()
            return cut["_place"], n - (cut.upto - cut.n)
        before += part.n
    return None


def rows_at_max(df: DataFrame, by: str) -> DataFrame:
    """All rows with the largest value of ``by``; the maximum is one scalar."""
    return df.where(F.col(by).eqNullSafe(F.lit(df.agg(F.max(by)).first()[0])))


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """Any number of conditional counts in one pass over the data."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group; null is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def group_average(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Averages of text or number columns per group. Text that is no number,
    such as NA, counts as null and is skipped."""
    return df.groupBy(*keys).agg(*[F.avg(F.col(v).try_cast("double")).alias(f"avg_{v}") for v in values])


def sum_by_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(f"sum_{value}"))


def grep_counts(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """Every match of a pattern with its number of occurrences, most frequent first."""
    matches = explode_once(df, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "match")
    return matches.groupBy("match").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "match")


def sum_of_row_maxima(df: DataFrame, vector: str = "features") -> DataFrame:
    """Sum over rows of the largest vector entry; 0 for a frame without rows."""
    return df.agg(F.coalesce(F.sum(row_maximum(vector)), F.lit(0.0)).alias("total"))
