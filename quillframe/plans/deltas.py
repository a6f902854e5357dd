"""Versions stored as differences to the version before.

A version is either a full copy or, where its predecessor has the same columns, what
has changed: the added rows and the hashes of the removed ones, each with
its number of copies. Restoring replays the differences onto the last full copy; after
``compact_after`` differences the next version is a full copy again. Rows that
are in both versions are neither written nor, on restoring, shuffled where the changes are small
enough for the adaptive join to send them out.

As in any version store, a version counts once its manifest row is written, after its data.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import new_tag
from .versions import MANIFEST, VersionStore

HASH = ["_h1", "_h2"]


def hashed(df: DataFrame) -> DataFrame:
    """The frame with two independent 64-bit hashes of the whole row.

    Spark's hash passes over nulls, so which columns are null is hashed along.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    return df.withColumns({"_h1": F.xxhash64(nulls, *columns), "_h2": F.xxhash64(F.lit("second"), nulls, *reversed(columns))})


def copies(df: DataFrame, n: str = "_n") -> DataFrame:
    """Every row as often as its number says."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n)))).drop("_copy", n)


class DeltaStore(VersionStore):
    def __init__(self, spark: SparkSession, root: str, compact_after: int = 8):
        super().__init__(spark, root)
        self.compact_after = compact_after

    def archive(self, df: DataFrame, stage: str, run_id: str | None = None, **details) -> str:
        """Write the rows that differ from the stage's newest version, or all of them, as version ``run_id``.

        Top-level column names must be unique; maps cannot be hashed by Spark and need a full store.
        """
        run_id = run_id or new_tag()
        before = self.entry(stage)
        links = json.loads(before.details).get("links", 0) + 1 if before else 0
        if before is None or links > self.compact_after or self._schema(stage, before.run_id) != df.schema.simpleString():
            return super().archive(df, stage, run_id, **(details | {"links": 0, "schema": df.schema.simpleString()}))
        path = self.attempt(stage, run_id)
        # One read of the input, so that hashes and rows are of the same rows whatever a retried task makes.
        hashed(df).write.parquet(f"{path}/staging")
        now = self.spark.read.schema(hashed(df).schema).parquet(f"{path}/staging")
        then = hashed(self.restore(stage, before.run_id))
        count = lambda frame, name: frame.groupBy(*HASH).agg(F.count(F.lit(1)).alias(name))
        both = count(now, "_now").join(count(then, "_then"), HASH, "full")
        change = both.select(*HASH, (F.coalesce("_now", F.lit(0)) - F.coalesce("_then", F.lit(0))).alias("_n")).where("_n <> 0")
        change.write.parquet(f"{path}/change")
        change = self.spark.read.parquet(f"{path}/change")
        # A row of each added hash; equal hashes are equal rows.
        new = now.join(change.where("_n > 0"), HASH).dropDuplicates(HASH)
        new.write.parquet(f"{path}/added")
        change.where("_n < 0").select(*HASH, (-F.col("_n")).alias("_n")).write.parquet(f"{path}/removed")
        row_count = now.count()
        self._remove(f"{path}/staging", f"{path}/change")
        more = details | {"links": links, "before": before.run_id, "schema": df.schema.simpleString()}
        row = (run_id, stage, path, row_count, json.dumps(more, sort_keys=True), dt.datetime.now(dt.timezone.utc))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return run_id

    def _remove(self, *names: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)

    def _schema(self, stage: str, run_id: str) -> str | None:
        return self.details(stage, run_id).get("schema")

    def chain(self, stage: str, run_id: str | None = None) -> list:
        """Manifest rows from the full copy to the version."""
        rows = []
        found = self.entry(stage, run_id)
        while found is not None:
            rows.append(found)
            before = json.loads(found.details).get("before")
            found = self.entry(stage, before) if before else None
        return rows[::-1]

    def restore(self, stage: str, run_id: str | None = None) -> DataFrame:
        """A named version of a stage, by default the newest."""
        chain = self.chain(stage, run_id)
        if not chain:
            raise LookupError(f"no version of {stage}" + (f" from run {run_id}" if run_id else ""))
        base = self.spark.read.parquet(chain[0].path)
        if len(chain) == 1:
            return base
        added, changes = None, None
        for link in chain[1:]:
            more = self.spark.read.parquet(f"{link.path}/added")
            less = self.spark.read.parquet(f"{link.path}/removed")
            step = more.select(*HASH, "_n").unionByName(less.select(*HASH, (-F.col("_n")).alias("_n")))
            added = more if added is None else added.unionByName(more)
            changes = step if changes is None else changes.unionByName(step)
        touched = changes.groupBy(*HASH).agg(F.sum("_n").alias("_change"))
        rows = hashed(base)
        untouched = rows.join(touched, HASH, "left_anti")
        # Of the rows that any link names: how many the full copy has, and what all links change.
        had = rows.join(touched, HASH, "left_semi")
        number = touched.join(had.groupBy(*HASH).agg(F.count(F.lit(1)).alias("_had")), HASH, "left")
        number = number.select(*HASH, (F.coalesce("_had", F.lit(0)) + F.col("_change")).alias("_n")).where("_n > 0")
        known = had.unionByName(added.drop("_n")).dropDuplicates(HASH)
        return untouched.select(*base.columns).unionByName(copies(known.join(number, HASH)).select(*base.columns))
