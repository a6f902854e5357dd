"""Projections, scalar expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import VECTOR_PARTS, array_total, pick, zip_positions
from ..functions.tags import suffix_after_first
from ..functions.text import tokenize
from ..operators.udf import apply_partitions, apply_rows
from ..plans.topics import count_vectors, vocabulary
from ..session import fresh_path, stored
from .registry import query, table
from .text import WORDS_SQL, documents, words_of


@query("project", "SELECT o_orderkey, o_orderpriority FROM orders")
def project(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")


@query("project_arith", "SELECT c_name, nullif(c_nationkey, 0) + 1 AS next_nation FROM customer")
def project_arith(spark, sf):
    people = table(spark, sf, "customer").select("c_name", F.nullif("c_nationkey", F.lit(0)).alias("nation"))
    return people.select("c_name", (F.col("nation") + 1).alias("next_nation"))


@query(
    "add_drop_column",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
)
def add_drop_column(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.withColumn("net", net).drop("l_extendedprice", "l_discount")


@query(
    "nested_field",
    WORDS_SQL
    + """
    SELECT documents.doc_id, CAST(count(index) AS INTEGER) AS n_entries, coalesce(sum(value), 0) AS total
    FROM documents LEFT JOIN vectors ON documents.doc_id = vectors.doc_id GROUP BY documents.doc_id
    """,
)
def nested_field(spark, sf):
    path = fresh_path(spark, "nested")
    words = stored(words_of(spark, sf), "words")
    vocab = [r.word for r in vocabulary(words, 500).collect()]
    count_vectors(words, vocab, 3.0).select("doc_id", "features").write.parquet(path)
    parts = spark.read.schema(f"doc_id bigint, features {VECTOR_PARTS}").parquet(path)
    return parts.select(
        "doc_id",
        F.size(F.col("features.indices")).alias("n_entries"),
        array_total(F.col("features.values")).alias("total"),
    )


@query("line_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def line_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))


@query(
    "split_item",
    "SELECT page_id, split_part(url, '/', 3) AS host, nullif(split_part(url, '/', 5), '') AS leaf FROM pages",
)
def split_item(spark, sf):
    parts = F.split("url", "/")
    return table(spark, sf, "pages").select(
        "page_id", parts[2].alias("host"), F.nullif(F.try_element_at(parts, F.lit(5)), F.lit("")).alias("leaf")
    )


@query("prefix_string", "SELECT concat_ws(' ', 'Name:', c_name) AS name FROM customer")
def prefix_string(spark, sf):
    return table(spark, sf, "customer").select(F.concat_ws(" ", F.lit("Name:"), "c_name").alias("name"))


@query(
    "casts",
    """
    SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority,
           CAST(o_orderdate AS DATE) AS day, TRY_CAST(o_orderstatus AS INTEGER) AS status
    FROM orders
    """,
)
def casts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.split("o_orderpriority", "-")[0].cast("int").alias("priority"),
        F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.col("o_orderstatus").try_cast("int").alias("status"),
    )


@query(
    "suffix_after_first",
    "SELECT conv_id, turn, concat(conv_id, '_', replace(upper(role), 'S', 'Z')) AS suffix FROM conversations",
)
def suffix_after_first_query(spark, sf):
    name = F.concat_ws("_", F.lit("turn"), "conv_id", "role")
    named = table(spark, sf, "conversations").select("conv_id", "turn", name.alias("name"))
    suffix = F.replace(suffix_after_first("name"), F.lit("S"), F.lit("Z"))
    return named.select("conv_id", "turn", suffix.alias("suffix"))


@query("array_size", "SELECT vec_id, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n FROM embeddings")
def array_size(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).alias("n"))


@query(
    "array_sum",
    "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings",
)
def array_sum(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(array_total("embedding"), 6).alias("total"))


@query(
    "zip_arrays",
    """
    WITH split AS (
        SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda w: w <> '') AS words FROM documents
    ), rows AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos, words[1] AS first_word FROM split
    )
    SELECT word, CAST(length(word) AS INTEGER) AS n, count(*) AS times, CAST(sum(pos) AS BIGINT) AS places,
           count(*) FILTER (WHERE word = first_word) AS like_first
    FROM rows GROUP BY word
    """,
)
def zip_arrays(spark, sf):
    words = documents(spark, sf).select("doc_id", tokenize("text").alias("word"))
    first = F.when(F.size("word") > 0, pick(F.array(F.lit(0)), F.col("word"))[0])
    pairs = words.withColumn("n", F.transform("word", F.length)).withColumn("first_word", first)
    return zip_positions(pairs, "word", "n", ["doc_id", "first_word"]).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("times"),
        F.sum("pos").alias("places"),
        F.count_if(F.col("word") == F.col("first_word")).alias("like_first"),
    )


@query("filter_eq", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.where("o_orderstatus = \"F\"").select("o_orderkey", "o_totalprice")


@query("filter_ne", "SELECT p_partkey, p_brand FROM part WHERE p_type <> 'ECONOMY'")
def filter_ne(spark, sf):
    parts = table(spark, sf, "part")
    return parts.where(parts["p_type"] != "ECONOMY").select("p_partkey", "p_brand")


@query("filter_gt", "SELECT c_custkey, c_nationkey FROM customer WHERE nullif(c_nationkey, 24) > 12")
def filter_gt(spark, sf):
    people = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return people.where(F.nullif("c_nationkey", F.lit(24)) > 12)


@query("filter_range", "SELECT p_partkey, p_size FROM part WHERE p_size >= 13 AND p_size <= 19")
def filter_range(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size").between(13, 19)).select("p_partkey", "p_size")


@query(
    "filter_non_empty_array",
    """
    SELECT page_id, CAST(len(regexp_extract_all(html, 'href="[^"]*"')) AS INTEGER) AS n FROM pages
    WHERE len(regexp_extract_all(html, 'href="[^"]*"')) > 0
    """,
)
def filter_non_empty_array(spark, sf):
    links = F.regexp_extract_all("html", F.lit('href="[^"]*"'), F.lit(0))
    return table(spark, sf, "pages").select("page_id", F.size(links).alias("n")).where("n > 0")


@query("partition_udf", "SELECT concat('Name: ', c_name) AS name FROM customer")
def partition_udf(spark, sf):
    def prefix(frame):
        return frame.assign(name="Name: " + frame["c_name"])[["name"]]

    return apply_partitions(table(spark, sf, "customer").select("c_name"), prefix, "name string")


@query("row_udf", "SELECT doc_id, CAST(length(source) + length(lang) AS BIGINT) AS n FROM documents")
def row_udf(spark, sf):
    lengths = apply_rows(lambda a, b: a.str.len() + b.str.len(), "bigint")
    return table(spark, sf, "documents").select("doc_id", lengths("source", "lang").alias("n"))
