"""Frames made from values in the program."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def from_values(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def range_step(spark: SparkSession, start: int, end: int, step: int = 1, partitions: int | None = None) -> DataFrame:
    """Integers from ``start`` up to but not including ``end``."""
    return spark.range(start, end, step, partitions)
