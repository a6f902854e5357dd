"""Line dedup over levelled, sorted runs of line hashes.

A run is a Parquet folder of one row per line key: its 128-bit hash, in how
many documents of its batch it stood, and, in the run that saw the key first,
the document that keeps it. Runs are bucketed by hash and sorted within each
file. A batch merge-anti-joins the runs to find its new keys, then adds its
own run on level 0; when a level holds ``fanout`` runs they are merged into one
run of the next level, so a key is rewritten once per level and a look-up reads
few runs. A manifest row written last makes a run count; a failed attempt
leaves files that no manifest names.

Batches must come in falling order of document id: the first run that holds a
key then names the largest document with it. Null ids count as smaller than
all others and together as one document.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import BLANKS, arrow_bounded, lower_ascii, renamed, slices

KEY = ["h1", "h2"]
RUN_SCHEMA = "h1 bigint, h2 bigint, n_docs bigint, keeper bigint, known boolean"
NO_DOC = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; equal keys are equal in both."""
    return F.xxhash64(key), F.xxhash64(F.lit("line"), key)


def line_array(text: Column, min_chars: int) -> Column:
    """One struct (h1, h2) per line, null where the key is shorter than ``min_chars`` code points."""

    def one(line):
        # A line has at least as many bytes as its key has code points.
        long = F.when(F.octet_length(line) >= min_chars, F.btrim(line, F.lit(BLANKS)))
        h1, h2 = hashes(lower_ascii(long))
        return F.when(F.char_length(long) >= min_chars, F.struct(h1.alias("h1"), h2.alias("h2")))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), one)


def document_keys(df: DataFrame, min_chars: int) -> DataFrame:
    """(doc, keys) of documents with long lines: the distinct hashes that ``line_array`` gives for the lines, worked out on batches of bytes."""
    blanks = BLANKS.encode()
    salt = xxhash.xxh64_intdigest(b"line", 42)

    def keys(text: bytes) -> set[bytes]:
        long = (line.strip(blanks) for line in text.split(b"\n") if len(line) >= min_chars)
        return {k.lower() for k in long if len(k) >= min_chars and (k.isascii() or len(k.decode()) >= min_chars)}

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = [keys(t.as_buffer().to_pybytes()) if t.is_valid else () for t in part.column("text")]
                sizes = np.array([len(f) for f in found], np.int32)
                flat = [k for f in found for k in f]
                # Spark's hash of two columns seeds the second with the hash of the first.
                halves = [np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in flat), np.uint64, len(flat)).view(np.int64) for seed in (42, salt)]
                pairs = pa.StructArray.from_arrays([pa.array(h) for h in halves], KEY)
                lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), pairs)
                some = pa.array(sizes > 0)
                yield pa.RecordBatch.from_arrays([part.column("doc").filter(some), lists.filter(some)], ["doc", "keys"])

    return df.mapInArrow(work, "doc bigint, keys array<struct<h1:bigint,h2:bigint>>")


class LineRuns:
    """The runs of one folder. ``buckets`` is the number of files of a run, by default as many as a shuffle has partitions."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 4, buckets: int | None = None):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._version = 0

    @classmethod
    def load(cls, spark: SparkSession, folder: str, **settings) -> LineRuns:
        """The runs that the newest manifest row of the folder names."""
        store = cls(spark, folder, **settings)
        newest = spark.read.schema("version bigint, levels string").json(f"{folder}/manifest").orderBy(F.desc("version")).first()
        store.levels, store._version = json.loads(newest.levels), newest.version
        return store

    def _write(self, run: DataFrame) -> str:
        path = f"{self.folder}/runs/{uuid.uuid4().hex}"
        run.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def _commit(self) -> None:
        self._version += 1
        row = self.spark.createDataFrame([(self._version, json.dumps(self.levels))], "version bigint, levels string")
        row.coalesce(1).write.mode("append").json(f"{self.folder}/manifest")

    def runs(self) -> DataFrame:
        """Rows of all live runs; a key has a row in each run that holds it."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    @staticmethod
    def merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"), F.bool_and("known").alias("known"))

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (doc, h1, h2) rows; returns its new keys, those that no earlier run held."""
        own = lines.distinct().groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        if self.levels:
            held = self.runs().select(*KEY).distinct()
            fresh = own.join(held, KEY, "left_anti").withColumn("known", F.lit(False))
            again = own.join(held, KEY, "left_semi").withColumns({"keeper": F.lit(None).cast("bigint"), "known": F.lit(True)})
            own = fresh.unionByName(again)
        else:
            own = own.withColumn("known", F.lit(False))
        path = self._write(own)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(path)
        self._compact()
        self._commit()
        return self.spark.read.schema(RUN_SCHEMA).parquet(path).where(~F.col("known")).select(*KEY)

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                path = self._write(self.merged(self.spark.read.schema(RUN_SCHEMA).parquet(*self.levels[level])))
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(path)
            level += 1

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, n_docs, keeper) of the keys in at least ``min_docs`` documents."""
        return self.merged(self.runs()).where(F.col("n_docs") >= min_docs).drop("known")


def dedupe_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 2,
    buckets: int | None = None,
) -> DataFrame:
    """Replace the text by its kept lines; add ``n_lines`` (before) and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and stands in at
    least ``min_docs`` documents stays only in the largest document that holds
    it, there as often as it stands. A null or empty text is one empty line.
    Repeated ids are one document. Any number of ``batches`` gives the same result.
    """
    spark = df.sparkSession
    full, doc = F.col(f"`{text}`"), F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_DOC))
    lines_path = fresh_path(spark, "line-keys")
    arrow_bounded(spark)
    document_keys(df.select(doc.alias("doc"), full.alias("text")), min_chars).write.parquet(lines_path)
    lines = spark.read.parquet(lines_path)
    # Cuts of the id range decide the work of a batch, never the result.
    cuts = sorted(set(lines.approxQuantile("doc", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    ends = [None, *(int(c) for c in reversed(cuts)), None]
    store = LineRuns(spark, fresh_path(spark, "line-runs"), fanout, buckets)
    for high, low in zip(ends, ends[1:]):
        part = lines
        if high is not None:
            part = part.where(F.col("doc") <= high)
        if low is not None:
            part = part.where(F.col("doc") > low)
        store.add(part.select("doc", F.explode("keys").alias("k")).select("doc", "k.h1", "k.h2"))
    frequent = store.frequent(min_docs)
    # Lines of frequent keys only; the hottest key is split by the adaptive join, and copies of a row meet before the shuffle.
    losing = (
        lines.select("doc", F.explode("keys").alias("k")).select("doc", "k.h1", "k.h2")
        .join(frequent.select(*KEY, "keeper"), KEY)
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc").agg(F.collect_set(F.struct(*KEY)).alias("_lost"))
    )
    rows = renamed(df, ["n_lines", "n_dropped"]).withColumn("_doc", doc)
    joined = rows.join(losing.withColumnRenamed("doc", "_doc"), "_doc", "left")
    split = F.split(F.coalesce(full, F.lit("")), "\n", -1)
    # Rows that lose nothing pass without their lines being hashed again.
    kept = F.when(
        F.col("_lost").isNotNull(),
        F.transform(
            F.filter(F.arrays_zip(split.alias("line"), line_array(full, min_chars).alias("key")), lambda s: s["key"].isNull() | ~F.array_contains(F.col("_lost"), s["key"])),
            lambda s: s["line"],
        ),
    )
    joined = joined.withColumns({"n_lines": F.size(split).cast("bigint"), "_kept": kept})
    return joined.withColumns(
        {
            "n_dropped": F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_kept")).cast("bigint"),
            text: F.when(F.col("_kept").isNull(), full).otherwise(F.concat_ws("\n", "_kept")),
        }
    ).drop("_doc", "_lost", "_kept")
