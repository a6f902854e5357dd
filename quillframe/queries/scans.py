"""Sources: each query writes a given table in the format and reads it back."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators.relational import rows_in
from ..session import fresh_name, fresh_path
from ..sinks.tables import create_table_as, scan_table
from ..sources.files import (
    read_csv,
    read_json,
    read_libsvm,
    read_lines,
    read_parquet,
    read_token_lines,
    read_typed_delimited,
    sql_on_file,
)
from ..sources.values import empty_frame, from_values, range_step
from .registry import query, table


@query(
    "scan_csv",
    """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    """,
)
def scan_csv(spark, sf):
    path = fresh_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path)


@query("scan_text", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def scan_text(spark, sf):
    path = fresh_path(spark, "text")
    table(spark, sf, "documents").select("text").write.text(path)
    return read_lines(spark, path)


@query(
    "lines_to_tokens",
    """
    WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    SELECT value, CAST(len(string_split(value, ' ')) AS INTEGER) AS n_words,
           CAST(len(list_filter(string_split(value, ' '), lambda w: w = '')) AS INTEGER) AS n_blank,
           string_split(value, ' ')[1] AS first_word
    FROM lines
    """,
)
def lines_to_tokens(spark, sf):
    path = fresh_path(spark, "text")
    table(spark, sf, "documents").select("text").write.text(path)
    return read_token_lines(spark, path).select(
        "value",
        F.size("words").alias("n_words"),
        F.size(F.filter("words", lambda w: w == "")).alias("n_blank"),
        F.col("words")[0].alias("first_word"),
    )


@query(
    "scan_delimited_typed",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line, l_returnflag AS flag,
           l_linestatus AS status, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
           CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS VARCHAR) AS discount,
           CAST(l_tax AS VARCHAR) AS tax, concat(l_returnflag, l_linestatus) AS kind,
           CAST(l_partkey AS INTEGER) AS part, CAST(l_suppkey AS INTEGER) AS supplier,
           l_linenumber + 1 AS next_line
    FROM lineitem
    """,
)
def scan_delimited_typed(spark, sf):
    path = fresh_path(spark, "delimited")
    table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.concat("l_returnflag", "l_linestatus").alias("kind"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        (F.col("l_linenumber") + 1).alias("next_line"),
    ).write.option("header", True).csv(path)
    return read_typed_delimited(spark, path, (2, 6, 10, 11, 12))


@query("scan_json", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def scan_json(spark, sf):
    path = fresh_path(spark, "json")
    table(spark, sf, "part").write.json(path)
    return read_json(spark, path)


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def scan_parquet(spark, sf):
    orders = read_parquet(spark, f"{sf}/orders.parquet")
    return orders.where("o_totalprice > 100000").select("o_orderkey", "o_totalprice")


@query("scan_sql_on_file", "SELECT o_orderkey, o_orderpriority FROM orders")
def scan_sql_on_file(spark, sf):
    return sql_on_file(spark, f"{sf}/orders.parquet", "o_orderkey, o_orderpriority")


@query(
    "scan_merge_schema",
    """
    SELECT s_suppkey AS supplier, s_acctbal AS balance, NULL::BIGINT AS customer, 1 AS key FROM supplier
    UNION ALL
    SELECT NULL::BIGINT, c_acctbal, c_custkey, 2 FROM customer
    """,
)
def scan_merge_schema(spark, sf):
    path = fresh_path(spark, "merged")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("customer"))
    suppliers.write.parquet(f"{path}/key=1")
    customers.write.parquet(f"{path}/key=2")
    return read_parquet(spark, path, merge_schema=True).select("supplier", "balance", "customer", "key")


@query(
    "scan_libsvm",
    """
    SELECT CAST(label AS DOUBLE) AS label, CAST(len(embedding) AS INTEGER) AS n_features,
           CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last
    FROM embeddings
    """,
)
def scan_libsvm(spark, sf):
    path = fresh_path(spark, "libsvm")
    table(spark, sf, "embeddings").select(
        F.col("label").cast("double"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    ).write.format("libsvm").save(path)
    values = vector_to_array("features")
    return read_libsvm(spark, path, 64).select(
        "label", F.size(values).alias("n_features"), values[0].alias("first"), values[63].alias("last")
    )


@query("scan_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_table_query(spark, sf):
    name = fresh_name("scanned")
    create_table_as(table(spark, sf, "customer"), name)
    return scan_table(spark, name, "c_custkey", "c_name", "c_acctbal")


@query(
    "from_values",
    """
    SELECT o_orderkey, rank
    FROM orders
    JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) AS v(priority, rank)
      ON o_orderpriority = priority
    """,
)
def from_values_query(spark, sf):
    ranks = from_values(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)],
        "o_orderpriority string, rank int",
    )
    return table(spark, sf, "orders").join(F.broadcast(ranks), "o_orderpriority").select("o_orderkey", "rank")


@query("empty_frame", "SELECT s_suppkey, s_name FROM supplier")
def empty_frame_query(spark, sf):
    start = empty_frame(spark, "s_suppkey bigint, s_name string")
    return start.unionByName(table(spark, sf, "supplier").select("s_suppkey", "s_name"))


@query(
    "range_step",
    """
    SELECT bounds.id AS price_from, count(o_orderkey) AS n
    FROM (SELECT unnest(range(0, (SELECT CAST(max(o_totalprice) AS BIGINT) + 1 FROM orders), 25000)) AS id) AS bounds
    LEFT JOIN orders ON CAST(floor(o_totalprice / 25000) AS BIGINT) * 25000 = bounds.id
    GROUP BY bounds.id
    """,
)
def range_step_query(spark, sf):
    orders = table(spark, sf, "orders")
    top = orders.agg(F.max("o_totalprice")).first()[0]
    bounds = range_step(spark, 0, round(top) + 1, 25_000, 5).withColumnRenamed("id", "price_from")
    counted = orders.groupBy((F.floor(F.col("o_totalprice") / 25_000) * 25_000).alias("price_from")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return bounds.join(counted, "price_from", "left").select("price_from", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "filter_in_set",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def filter_in_set(spark, sf):
    members = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return rows_in(table(spark, sf, "orders"), members, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")
