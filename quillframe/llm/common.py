"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

#: ASCII white space, as the words and line keys of these operators know it.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of UTF-8 text that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20
#: Bytes of a row group of wide rows; a reader decodes a row group at a time.
WIDE_GROUP_BYTES = 8 << 20


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def arrow_bounded(spark: SparkSession) -> None:
    """Keep batches sent to Python small in bytes; the default of 10,000 rows knows nothing of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``most`` bytes of a string or binary column, or one row."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def stored_wide(df: DataFrame, label: str) -> DataFrame:
    """As ``stored``, for rows of a megabyte and more: pages and row groups end by their bytes and are compressed by zstd.

    The writer's default looks at sizes every 100 rows only, so that a page of wide
    rows, its compression buffers and the batch a reader decodes grow with the rows of a file.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("parquet.page.size.row.check.min", 1).option("parquet.block.size", WIDE_GROUP_BYTES).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def row_uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the values only, so that retried tasks and other partitionings agree."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 53))


def renamed(df: DataFrame, taken: list[str]) -> DataFrame:
    """The frame without columns of the given names (any case): results replace clashing inputs."""
    low = {c.lower() for c in taken}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def ddl(df: DataFrame) -> str:
    """The frame's columns as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
