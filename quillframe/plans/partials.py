"""Aggregates over many versions, each version aggregated once.

A version adds one row per group: its number of rows, and of each value its
number, sum, least and greatest. Reading merges the rows of the live versions.
A version that is archived again replaces its former rows; one that is dropped
counts no more. The data of other versions is not read for either.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class PartialStore:
    """Partial aggregates of ``values`` by ``keys`` in a shared folder, one folder for each attempt, named by a manifest."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str]):
        self.spark, self.path, self.keys, self.values = spark, path, list(keys), list(values)

    def add(self, version: str, df: DataFrame) -> None:
        """Aggregate one version. It counts from the moment its manifest row is written, which is last."""
        made = [F.count(F.lit(1)).alias("n")]
        for v in self.values:
            col = F.col(f"`{v}`")
            made += [F.count(col).alias(f"{v}_n"), F.sum(col).alias(f"{v}_sum"), F.min(col).alias(f"{v}_min"), F.max(col).alias(f"{v}_max")]
        folder = uuid.uuid4().hex
        df.groupBy(*self.keys).agg(*made).write.parquet(f"{self.path}/parts/{folder}")
        self._note(version, folder)

    def drop(self, version: str) -> None:
        self._note(version, None)

    def _note(self, version: str, folder: str | None) -> None:
        row = self.spark.createDataFrame([(version, folder, time.time_ns())], "version string, folder string, at bigint")
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def live(self) -> dict[str, str]:
        """Folder of each version that counts: the newest manifest row of a version decides."""
        newest = Window.partitionBy("version").orderBy(F.desc("at"), F.desc("folder"))
        rows = self.spark.read.parquet(f"{self.path}/manifest").withColumn("nth", F.row_number().over(newest))
        return {r.version: r.folder for r in rows.where("nth = 1 AND folder IS NOT NULL").collect()}

    def total(self, versions: Sequence[str] | None = None) -> DataFrame:
        """Keys, n and of each value its number, sum, least, greatest and mean over the live versions, or over those named."""
        live = self.live()
        named = sorted(live) if versions is None else list(versions)
        if missing := [v for v in named if v not in live]:
            raise KeyError(f"no such versions: {missing}")
        if not named:
            raise KeyError("no version counts")
        rows = self.spark.read.parquet(*[f"{self.path}/parts/{live[v]}" for v in named])
        merged = [F.sum("n").alias("n")]
        for v in self.values:
            merged += [F.sum(f"{v}_n").alias(f"{v}_n"), F.sum(f"{v}_sum").alias(f"{v}_sum"), F.min(f"{v}_min").alias(f"{v}_min"), F.max(f"{v}_max").alias(f"{v}_max")]
        return rows.groupBy(*self.keys).agg(*merged).withColumns({f"{v}_mean": F.col(f"{v}_sum").cast("double") / F.col(f"{v}_n") for v in self.values})
