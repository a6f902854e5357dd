"""File sources. Every reader returns a lazy DataFrame over all files at a path."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    sep: str = ",",
    schema: StructType | str | None = None,
    infer: bool = True,
) -> DataFrame:
    """Delimited files. Inference reads the files once more, so give a schema
    for large inputs; with neither, every column is a string."""
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def read_token_lines(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """One row per line with its words in ``words``; repeated blanks give empty words."""
    return read_lines(spark, path).select("value", F.split("value", f"\\Q{sep}\\E").alias("words"))


def read_typed_delimited(
    spark: SparkSession,
    path: str,
    int_positions: Sequence[int] = (),
    *,
    sep: str = ",",
    strict: bool = True,
) -> DataFrame:
    """Delimited text whose first line names the columns.

    Columns at ``int_positions`` (counted from 1) become integers: a bad value
    stops the job when ``strict``, else it becomes null. Every line equal to
    the header is dropped, also one in the middle of a file.
    """
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    is_header = reduce(
        lambda left, right: left & right, [F.col(f"`{c}`").eqNullSafe(F.lit(c)) for c in raw.columns]
    )
    ints = {raw.columns[i - 1] for i in int_positions}

    def typed(name: str):
        col = F.col(f"`{name}`")
        if name not in ints:
            return col
        return (col.cast("int") if strict else col.try_cast("int")).alias(name)

    return raw.where(~is_header).select(*[typed(c) for c in raw.columns])


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; the schema is inferred when not given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    """Parquet files; ``merge_schema`` unites the columns of all part schemas.
    ``key=value`` folders become columns."""
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    return reader.parquet(path)


def sql_on_file(spark: SparkSession, path: str, columns: str = "*", fmt: str = "parquet") -> DataFrame:
    """Select straight from files without registering them."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}`")


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    """Labelled points as ``label double, features vector``. Giving the number
    of features saves the extra pass that counts them."""
    reader = spark.read.format("libsvm")
    if n_features is not None:
        reader = reader.option("numFeatures", n_features)
    return reader.load(path)
