"""Table layouts that save the shuffle of repeated joins, and the reads of joins on a date.

A bucketed table is dealt by its key once, when it is written; two tables with
equally many buckets then join bucket by bucket without an exchange. Keys that
alone outgrow a bucket (and null keys, which join nothing) are kept in a table
beside it that is not bucketed: their rows meet in an ordinary join, which AQE
may broadcast or split. There are fewer such keys than buckets.

A partitioned table has a folder per value; a join with a filtered dimension on
that column reads the folders of the dimension's values only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, stored


@dataclass(frozen=True)
class BucketedTable:
    """Catalog names of the bucketed rows and of the rows with hot or null keys."""

    name: str
    key: str
    buckets: int
    hot: tuple

    @property
    def beside(self) -> str:
        return f"{self.name}_hot"

    def all_rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).unionByName(spark.table(self.beside))


def hot_keys(df: DataFrame, key: str, buckets: int, factor: float = 2.0) -> tuple:
    """Keys with more than ``factor`` times the rows of an even bucket: at most ``buckets / factor`` of them."""
    if factor < 1:
        raise ValueError("factor is at least 1, so that there are at most as many hot keys as buckets")
    counts = stored(df.where(F.col(key).isNotNull()).groupBy(key).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return tuple(r[0] for r in counts.where(F.col("count") * buckets > factor * total).orderBy(key).collect())


def create_bucketed_table(df: DataFrame, name: str, key: str, buckets: int, *, factor: float = 2.0) -> BucketedTable:
    """Drop the table if it exists and write a frame in buckets of ``key``, each bucket one sorted file."""
    spark = df.sparkSession
    made = BucketedTable(name, key, buckets, hot_keys(df, key, buckets, factor))
    hot = F.col(key).isNull() | _among(key, made.hot)
    for table in (made.name, made.beside):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    # Dealt as the buckets are, so that a task writes whole buckets and a bucket is one file.
    cold = df.where(~hot).repartition(buckets, key)
    cold.write.bucketBy(buckets, key).sortBy(key).option("path", fresh_path(spark, name)).saveAsTable(made.name, format="parquet")
    df.where(hot).write.option("path", fresh_path(spark, made.beside)).saveAsTable(made.beside, format="parquet")
    return made


def _among(key: str, values: tuple) -> Column:
    return F.col(key).isin(list(values)) if values else F.lit(False)


def join_bucketed(spark: SparkSession, left: BucketedTable, right: BucketedTable, how: str = "inner") -> DataFrame:
    """Inner or left join of two bucketed tables on their common key.

    The bucketed rows join without an exchange if both tables have the same number
    of buckets. Rows with a key that is hot on either side join apart.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    if left.key != right.key:
        raise ValueError(f"the tables have different keys: {left.key}, {right.key}")
    key = left.key
    clash = ({c.lower() for c in spark.table(left.name).columns} & {c.lower() for c in spark.table(right.name).columns}) - {key.lower()}
    if clash:
        raise ValueError(f"both tables have columns {sorted(clash)}")

    def parts(table: BucketedTable, other: BucketedTable) -> tuple[DataFrame, DataFrame]:
        rows, apart = spark.table(table.name), spark.table(table.beside)
        foreign = tuple(k for k in other.hot if k not in table.hot)
        if not foreign:
            return rows, apart
        return rows.where(~_among(key, foreign)), apart.unionByName(rows.where(_among(key, foreign)))

    (cold, hot), (other_cold, other_hot) = parts(left, right), parts(right, left)
    return cold.join(other_cold, key, how).unionByName(hot.join(other_hot, key, how))


def write_by_value(df: DataFrame, column: str, path: str, files: int) -> None:
    """Write a folder per value of ``column`` with about ``files`` files in all.

    Ranges of (value, hash of the row) keep most values in one file and cut a value
    that holds many of the rows into several.
    """
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    df.repartitionByRange(files, F.col(column), spread).write.partitionBy(column).parquet(path)


def join_on_partition(fact: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Inner join of a frame read from ``write_by_value`` with a filtered dimension.

    No hint is given: where the dimension's size lets Spark broadcast it, the same
    broadcast prunes the folders of the fact table before they are read.
    """
    return fact.join(dimension, column)
