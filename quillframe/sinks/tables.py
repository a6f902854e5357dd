"""Views and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import fresh_path


def register_view(df: DataFrame, name: str, *, replace: bool = True) -> None:
    """Name a frame for SQL; without ``replace`` an existing name is an error."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)


def create_table_as(df: DataFrame, name: str, *, path: str | None = None) -> None:
    """Drop the table if it exists and make it from a frame.

    Data goes to ``path``, by default a new folder in the shared folder, so
    that dropping the table never removes files another table reads.
    """
    location = path or fresh_path(df.sparkSession, name)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").option("path", location).saveAsTable(name, format="parquet")


def create_empty_table(spark: SparkSession, name: str, columns: str) -> None:
    """Declare a table, e.g. ``columns="key INT, value STRING"``, if it does not exist."""
    location = fresh_path(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'")


def load_into_table(spark: SparkSession, path: str, name: str, *, sep: str = "\x01") -> None:
    """Append a delimited file to a declared table, read with the table's own schema."""
    schema: StructType = spark.table(name).schema
    spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST").csv(path).write.insertInto(name)


def scan_table(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table
