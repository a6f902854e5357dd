"""Counting matches of patterns over archived text, reading only files that may match.

The archive is Parquet files; beside it lies an index of one bitmap of hashed
trigrams for each file part that a task read. Every row that matches a pattern
holds the pattern's literal trigrams, so a file without a part that has all of
them has no match. Patterns without literals of three characters read everything.

Nulls match nothing. The index is read as a whole for each pattern: one bitmap
of 2 ** ``bits`` bits per part.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def trigram_places(text: str, bits: int) -> np.ndarray:
    """Bit of every run of three code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * _MIX[0] + codes[1:-1] * _MIX[1] + codes[2:] * _MIX[2]
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX[0] >> np.uint64(64 - bits)).astype(np.int64)


def literals(pattern: str) -> list[str]:
    """Texts of three characters or more that every match of a Java pattern holds; fewer than there are, never one too many.

    Groups, classes and escaped letters end a literal; a pattern with a choice at
    its top, with quoting or with flags that change what letters mean has none.
    """
    if re.search(r"\(\?-?[a-zA-Z]*[ixu]|\\[QExuc0]", pattern):
        return []
    found, run, at = [], "", 0

    def end() -> None:
        nonlocal run
        found.append(run)
        run = ""

    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            if at + 1 == len(pattern):
                return []
            if pattern[at + 1].isalnum():
                if pattern[at + 1] in "pPkNX":
                    return []  # what follows in braces belongs to the escape
                end()
            else:
                run += pattern[at + 1]
            at += 2
        elif c == "|":
            return []
        elif c in "*?{":
            # The character before may be missing; a lazy or possessive mark after it changes nothing.
            run = run[:-1]
            end()
            at = pattern.find("}", at) + 1 if c == "{" else at + 1
            if not at:
                return []
        elif c in "+.^$":
            end()
            at += 1
        elif c in "[(":
            end()
            at = _behind(pattern, at)
            if at < 0:
                return []
        elif c in ")]":
            return []
        else:
            run += c
            at += 1
    end()
    return [x for x in found if len(x) >= 3]


def _behind(pattern: str, at: int) -> int:
    """Place behind the class or group that begins here, or -1 where it is not a plain one."""
    depth = 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif c == "[":
            close = at + 1 + (pattern[at + 1 : at + 2] == "^")
            close += pattern[close : close + 1] == "]"
            while close < len(pattern) and pattern[close] != "]":
                if pattern[close] in "[&":
                    return -1
                close += 1 + (pattern[close] == "\\")
            at = close
            if not depth:
                return at + 1 if at < len(pattern) else -1
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if not depth:
                return at + 1
        at += 1
    return -1


class GrepArchive:
    """Text files with their trigram index in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, bits: int = 20):
        self.spark, self.rows, self.index, self.bits = spark, f"{path}/rows", f"{path}/trigrams", bits

    def add(self, df: DataFrame, column: str = "text") -> None:
        """Append rows of text and index the files that no finished index knows, also those that a lost run left without."""
        df.select(F.col(f"`{column}`").alias("text")).write.mode("append").parquet(self.rows)
        files, known = self._files(), self._known()
        new = {name: path for name, path in files.items() if name not in known}
        if not new:
            return
        every = self.spark.read.parquet(*new.values()).select("text", F.col("_metadata.file_name").alias("file"))
        bits = self.bits

        def mark(batches):
            maps: dict[str, np.ndarray] = {}
            for batch in batches:
                for text, file in zip(batch.column("text"), batch.column("file").to_pylist()):
                    if file not in maps and len(maps) == 64:
                        yield _packed(maps)
                        maps = {}
                    if file not in maps:
                        maps[file] = np.zeros(1 << bits, bool)
                    maps[file][trigram_places(text.as_py() or "", bits)] = True
            if maps:
                yield _packed(maps)

        # A file without rows gets no marks; a row without marks says that it is known all the same.
        named = self.spark.createDataFrame([(name, None) for name in new], "file string, marks binary")
        every.mapInArrow(mark, "file string, marks binary").unionAll(named).write.parquet(f"{self.index}/{uuid.uuid4().hex}")

    def _files(self) -> dict[str, str]:
        """Path of each file by its name, which is unique in the one folder of rows."""
        return {path.rsplit("/", 1)[1]: path for path in sorted(self.spark.read.parquet(self.rows).inputFiles())}

    def _marks(self) -> DataFrame | None:
        """All finished indexes: those whose folder was committed."""
        context = self.spark.sparkContext
        done = context._jvm.org.apache.hadoop.fs.Path(f"{self.index}/*/_SUCCESS")
        found = done.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(done)
        folders = [str(f.getPath().getParent()) for f in found or []]
        return self.spark.read.parquet(*folders) if folders else None

    def _known(self) -> set[str]:
        marks = self._marks()
        return {r.file for r in marks.select("file").distinct().collect()} if marks is not None else set()

    def candidates(self, pattern: str) -> list[str] | None:
        """Files that may hold a match, those without an index among them; None stands for all. Paths only, as many as Spark lists to read them."""
        places = sorted({int(p) for text in literals(pattern) for p in trigram_places(text, self.bits)})
        marks = self._marks()
        if not places or marks is None:
            return None
        at = np.array(places)

        def fits(batches):
            for batch in batches:
                kept = [m.is_valid and bool((np.frombuffer(m.as_py(), np.uint8)[at >> 3] >> (7 - (at & 7)) & 1).all()) for m in batch.column("marks")]
                yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(kept, pa.bool_())], ["file", "fits"])

        said = marks.mapInArrow(fits, "file string, fits boolean").groupBy("file").agg(F.bool_or("fits").alias("fits"))
        without = {r.file for r in said.where("NOT fits").collect()}
        return [path for name, path in self._files().items() if name not in without]

    def count(self, pattern: str) -> DataFrame:
        """One row: pattern, number of rows in which it is found, files read and files there are."""
        every = list(self._files().values())
        found = self.candidates(pattern)
        files = every if found is None else found
        columns = [F.lit(pattern).alias("pattern"), F.col("n"), F.lit(len(files)).cast("bigint").alias("files_read"), F.lit(len(every)).cast("bigint").alias("files")]
        if not files:
            return self.spark.range(1).select(F.lit(0).cast("bigint").alias("n")).select(*columns)
        return self.spark.read.parquet(*files).agg(F.count_if(F.col("text").rlike(pattern)).alias("n")).select(*columns)


def _packed(maps: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(maps)), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())], ["file", "marks"])
