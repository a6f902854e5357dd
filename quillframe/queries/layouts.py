"""Table layouts, the skip index of archived text and aggregates over versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.grep_index import GrepArchive
from ..plans.partials import PartialStore
from ..session import fresh_name, fresh_path, stored
from ..sinks.layout import create_bucketed_table, join_bucketed, join_on_partition, write_by_value
from .registry import query, table


@query(
    "bucketed_join",
    """
    SELECT o_orderpriority, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority, l_returnflag
    """,
)
def bucketed_join(spark, sf):
    """Lines and orders in buckets of the order key, joined without an exchange."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_returnflag", "l_quantity")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    left = create_bucketed_table(lines, fresh_name("lines"), "orderkey", 8)
    right = create_bucketed_table(orders, fresh_name("orders"), "orderkey", 8)
    sums = join_bucketed(spark, left, right).groupBy("o_orderpriority", "l_returnflag")
    return sums.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("quantity"))


@query(
    "bucketed_left_join",
    """
    SELECT c_mktsegment, e.event_type, count(*) AS n, count(e.event_type) AS matched
    FROM customer LEFT JOIN events e ON c_custkey = e.user_id GROUP BY c_mktsegment, e.event_type
    """,
)
def bucketed_left_join(spark, sf):
    """All customers with their events, both in buckets; keys with many events join apart."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    left = create_bucketed_table(customers, fresh_name("customers"), "user_id", 8)
    right = create_bucketed_table(table(spark, sf, "events").select("user_id", "event_type"), fresh_name("events"), "user_id", 8)
    joined = join_bucketed(spark, left, right, "left").groupBy("c_mktsegment", "event_type")
    return joined.agg(F.count(F.lit(1)).alias("n"), F.count("event_type").alias("matched"))


@query(
    "pruned_partitions",
    """
    SELECT month, l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) AS quantity
    FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem) l
    JOIN (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, CAST(strftime(o_orderdate, '%m') AS INTEGER) AS number FROM orders) USING (month)
    WHERE number = 3 GROUP BY month, l_returnflag
    """,
)
def pruned_partitions(spark, sf):
    """Lines in a folder per month of shipping, joined to the Marches of the orders: only those folders are read."""
    month = lambda name: F.date_format(name, "yyyy-MM").alias("month")
    path = fresh_path(spark, "lines-by-month")
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", month("l_shipdate"))
    write_by_value(lines, "month", path, files=16)
    months = table(spark, sf, "orders").select(month("o_orderdate"), F.month("o_orderdate").alias("number")).distinct()
    march = stored(months, "months").where("number = 3")
    fact = spark.read.schema("l_returnflag string, l_quantity double, month string").parquet(path)
    sums = join_on_partition(fact, march, "month").groupBy("month", "l_returnflag")
    return sums.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("quantity"))


PATTERNS = ("the data", r"[0-9]{3}\.[0-9]", "zebra crossing", "a|b")


@query(
    "grep_skip_index",
    " UNION ALL ".join(f"SELECT '{p}' AS pattern, count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS n FROM documents" for p in PATTERNS),
)
def grep_skip_index(spark, sf):
    """Counts of patterns over archived documents, from the files that may hold them."""
    archive = GrepArchive(spark, fresh_path(spark, "grep"))
    archive.add(table(spark, sf, "documents"))
    return reduce(DataFrame.unionAll, [archive.count(p).select("pattern", "n") for p in PATTERNS])


@query(
    "partial_aggregates",
    """
    SELECT event_type, count(*) AS n, count(cents) AS cents_n, CAST(sum(cents) AS BIGINT) AS cents_sum, min(cents) AS cents_min, max(cents) AS cents_max
    FROM (
        SELECT event_type, CAST(floor(value * 100) AS BIGINT) AS cents FROM events WHERE event_id % 4 = 0
        UNION ALL SELECT event_type, CASE WHEN user_id % 2 = 0 THEN CAST(floor(value * 100) AS BIGINT) END FROM events WHERE event_id % 4 = 1
    ) GROUP BY event_type
    """,
)
def partial_aggregates(spark, sf):
    """Events in three versions, of which one is replaced and one dropped."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.floor(F.col("value") * 100).alias("cents"))
    store = PartialStore(spark, fresh_path(spark, "partials"), ["event_type"], ["cents"])
    for version in range(3):
        store.add(f"v{version}", events.where(F.col("event_id") % 4 == version))
    store.add("v1", events.where("event_id % 4 = 1").withColumn("cents", F.expr("CASE WHEN user_id % 2 = 0 THEN cents END")))
    store.drop("v2")
    return store.total().drop("cents_mean")
