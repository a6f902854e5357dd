"""Joins, aggregations, ordered limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as ops
from ..operators.partitions import explode_once
from ..operators.similarity import vector_top_k
from .registry import query, table


@query(
    "join_inner",
    """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def join_inner(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return ops.join_pairs(customers, orders, "c_custkey")


@query(
    "join_self",
    """
    WITH pairs AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS first, concat_ws(',', o_orderkey, o_custkey, o_orderstatus) AS line FROM orders
    )
    SELECT a.first, a.line, count(*) AS joined, CAST(sqrt(sum(CASE WHEN a.line = b.line THEN 1 ELSE 0 END)) AS BIGINT) AS copies
    FROM pairs a JOIN pairs b ON a.first = b.first GROUP BY ALL
    """,
)
def join_self(spark, sf):
    lines = table(spark, sf, "orders").select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus").alias("line"))
    return ops.join_self(lines.select(F.split("line", ",")[0].alias("first"), "line"), "first", "line")


@query(
    "row_count",
    "SELECT count(*) AS n FROM lineitem",
)
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "conditional_counts",
    """
    SELECT count(*) FILTER (WHERE contains(value, 'a')) AS with_a, count(*) FILTER (WHERE contains(value, 'b')) AS with_b
    FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)
    """,
)
def conditional_counts(spark, sf):
    lines = explode_once(table(spark, sf, "documents"), F.split("text", "\n"), "value")
    return ops.conditional_counts(
        lines, with_a=F.col("value").contains("a"), with_b=F.col("value").contains("b")
    )


@query(
    "group_count",
    "SELECT nullif(event_type, 'error') AS kind, count(*) AS count FROM events GROUP BY 1",
)
def group_count(spark, sf):
    events = table(spark, sf, "events").select(F.nullif("event_type", F.lit("error")).alias("kind"))
    return ops.group_count(events, "kind")


@query(
    "group_avg",
    """
    SELECT CAST(l_shipdate AS DATE) AS day,
           round(avg(CASE WHEN l_returnflag <> 'N' THEN l_quantity END), 4) AS avg_quantity,
           round(avg(l_linenumber), 4) AS avg_line
    FROM lineitem GROUP BY 1
    """,
)
def group_avg(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("day"),
        F.when(F.col("l_returnflag") == "N", "NA").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.col("l_linenumber").cast("string").alias("line"),
    )
    found = ops.group_average(lines, ["day"], ["quantity", "line"])
    return found.select("day", F.round("avg_quantity", 4).alias("avg_quantity"), F.round("avg_line", 4).alias("avg_line"))


@query("sum_by_key", "SELECT source, lang, CAST(sum(911) AS BIGINT) AS sum_one FROM documents GROUP BY source, lang")
def sum_by_key(spark, sf):
    pairs = table(spark, sf, "documents").select("source", "lang", F.lit(911).alias("one"))
    return ops.sum_by_key(pairs, ["source", "lang"], "one")


@query(
    "regex_grep_count",
    """
    SELECT match, count(*) AS n
    FROM (SELECT unnest(regexp_extract_all(html, 'ex[a-z.]+')) AS match FROM pages) GROUP BY match
    """,
)
def regex_grep_count(spark, sf):
    return ops.grep_counts(table(spark, sf, "pages"), "html", "ex[a-z.]+")


@query(
    "limit_or_all",
    """
    SELECT 'first' AS part, doc_id, n_chars FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100)
    UNION ALL SELECT 'tied', doc_id, n_chars FROM (SELECT * FROM documents ORDER BY lang, source, doc_id LIMIT 37)
    UNION ALL SELECT 'all', doc_id, n_chars FROM documents
    """,
)
def limit_or_all(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    parts = {"first": (100, "doc_id"), "tied": (37, "lang", "source", "doc_id"), "all": (0, "doc_id")}
    found = [ops.limit_rows(documents, n, *keys).select(F.lit(part).alias("part"), "doc_id", "n_chars") for part, (n, *keys) in parts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("rows_at_max", "SELECT event_id, value FROM events WHERE value = (SELECT max(value) FROM events)")
def rows_at_max(spark, sf):
    return ops.rows_at_max(table(spark, sf, "events").select("event_id", "value"), "value")


@query(
    "subtract_rows",
    """
    SELECT event_type, user_id FROM events
    WHERE (event_type, user_id) NOT IN (SELECT (event_type, user_id) FROM events WHERE value > 20)
    """,
)
def subtract_rows(spark, sf):
    events = table(spark, sf, "events")
    gone = events.where("value > 20").select("event_type", "user_id")
    return ops.subtract_rows(events.select("event_type", "user_id"), gone)


@query(
    "set_difference",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders",
)
def set_difference(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    return ops.set_difference(customers, table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")))


@query(
    "vector_top_k",
    """
    WITH target AS (SELECT CAST(embedding AS DOUBLE[]) AS target FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), target), 6) AS similarity
    FROM embeddings, target
    ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), target) DESC, vec_id LIMIT 40
    """,
)
def vector_top_k_query(spark, sf):
    vectors = table(spark, sf, "embeddings")
    target = vectors.where("vec_id = 0").first()["embedding"]
    found = vector_top_k(vectors, "vec_id", "embedding", target, 40)
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))
