"""Array and vector columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout in which a vector column lies in Parquet files. Reading the files with
# this schema gives the parts of sparse vectors as plain columns.
VECTOR_PARTS = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def array_total(col: Column | str) -> Column:
    """Sum of an array of numbers; an empty array gives 0."""
    col = F.col(col) if isinstance(col, str) else col
    return F.aggregate(col, F.lit(0.0), lambda total, x: total + x.cast("double"))


def vector_total(col: str) -> Column:
    return array_total(F.unwrap_udt(F.col(col))["values"])


def row_maximum(col: str) -> Column:
    """Largest entry of a vector column, read from the stored entries; null for a vector of size 0."""
    parts = F.unwrap_udt(F.col(col))
    top, length = F.array_max(parts["values"]), F.size(parts["values"])
    # Entries that a sparse vector leaves out are zeros.
    return F.when((parts["type"] == 1) | (length == parts["size"]), top).otherwise(F.greatest(F.lit(0.0), top))


def entries(col: str) -> Column:
    """Non-zero entries of a vector column as ``array<struct<index, value>>``.

    Works within the row, so it needs no shuffle.
    """
    parts = F.unwrap_udt(F.col(col))
    dense = F.transform(parts["values"], lambda v, i: F.struct(i.alias("index"), v.alias("value")))
    sparse = F.zip_with(parts["indices"], parts["values"], lambda i, v: F.struct(i.alias("index"), v.alias("value")))
    return F.filter(F.when(parts["type"] == 1, dense).otherwise(sparse), lambda p: p["value"] != 0)


def to_parts_column(df: DataFrame, vector: str = "features", parts: str = "f2") -> DataFrame:
    """Replace a vector column by a struct (size, indices, values) of its non-zero entries."""
    found, raw = entries(vector), F.unwrap_udt(F.col(vector))
    size = F.coalesce(raw["size"], F.size(raw["values"]))
    made = F.struct(
        size.alias("size"), F.transform(found, lambda p: p["index"]).alias("indices"), F.transform(found, lambda p: p["value"]).alias("values")
    )
    return df.withColumn(parts, made).drop(vector)


def to_array_column(df: DataFrame, vector: str = "features", array: str = "f1") -> DataFrame:
    """Replace a vector column by a plain array column."""
    return df.withColumn(array, vector_to_array(F.col(vector))).drop(vector)


def to_vector_column(df: DataFrame, array: str = "f1", vector: str = "features") -> DataFrame:
    """Replace a plain array column by a vector column."""
    return df.withColumn(vector, array_to_vector(F.col(array))).drop(array)


def zip_positions(df: DataFrame, left: str, right: str, keep: list[str]) -> DataFrame:
    """One row per position of two equally long arrays."""
    zipped = F.arrays_zip(F.col(left).alias("left"), F.col(right).alias("right"))
    # The outer form, because the plain one evaluates the arrays twice.
    out = df.select(*keep, F.posexplode_outer(zipped).alias("pos", "pair")).where("pos IS NOT NULL")
    return out.select(*keep, "pos", F.col("pair.left").alias(left), F.col("pair.right").alias(right))


def pick(indices: Column, values: Column) -> Column:
    """Array of the elements of ``values`` at the 0-based ``indices``."""
    return F.transform(indices, lambda i: F.element_at(values, i + 1))


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two arrays of numbers; null when one of them has no length."""
    dot = F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return dot / F.nullif(norm(left) * norm(right), F.lit(0.0))


def norm(col: Column) -> Column:
    return F.sqrt(F.aggregate(col, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
