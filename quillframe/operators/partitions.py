"""Use of all cores, and one evaluation of what is exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows of a small input out to all cores before heavy row work.

    A few files with few row groups would keep most cores idle. Inputs with a
    partition for every core are returned as they are, so nothing large is
    ever shuffled for this. Rows are dealt round-robin, whatever their keys.
    Only row-wise work should follow: fits take their partitions as a parameter.
    With ``rows`` there are at least as many partitions as give each so many rows,
    for work that holds a task's rows in a larger form than their files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = -(-df.count() // rows) if rows else 0
    if df.rdd.getNumPartitions() >= max(cores, wanted):
        return df
    return df.repartition(max(2 * cores, wanted))


def explode_once(df: DataFrame, values: Column | str, name: str, *keep: str | Column) -> DataFrame:
    """One row per element of an array column; null elements are left out.

    Plain ``explode`` makes Catalyst add a filter on the array's size, and with
    it a second evaluation of the expression that makes the array.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).where(F.col(name).isNotNull())
