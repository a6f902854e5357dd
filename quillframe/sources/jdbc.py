"""JDBC source and sink.

The read is split over tasks by ranges of a numeric column; without one, Spark
would fetch the whole table through a single connection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    user: str,
    password: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    driver: str | None = None,
) -> DataFrame:
    properties = {"user": user, "password": password, "fetchsize": str(fetch_size)}
    if driver:
        properties["driver"] = driver
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None or partitions is None:
        raise ValueError("a split column needs lower, upper and partitions")
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    user: str,
    password: str,
    mode: str = "errorifexists",
    connections: int = 32,
    batch_size: int = 10_000,
    driver: str | None = None,
) -> None:
    """Write with at most ``connections`` tasks talking to the database."""
    properties = {
        "user": user,
        "password": password,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }
    if driver:
        properties["driver"] = driver
    df.write.jdbc(url, table, mode=mode, properties=properties)
