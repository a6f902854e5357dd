"""Sinks, catalog tables and stored versions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.arrays import array_total, to_array_column, to_vector_column
from ..functions.tags import is_tag, make_tag, name_tag, parse_tag
from ..plans.deltas import DeltaStore
from ..plans.versions import VersionStore, catalog_names, latest_versions, orphan_tables, sweep_orphans
from ..session import fresh_name, fresh_path
from ..sinks.files import write_parquet, write_text
from ..sinks.tables import create_empty_table, create_table_as, load_into_table, register_view, scan_table
from ..operators.relational import group_count, rename
from .registry import query, table

GIVEN = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@query("temp_view_sql", "SELECT c_name, c_acctbal FROM customer WHERE c_acctbal >= 1300 AND c_acctbal <= 5900")
def temp_view_sql(spark, sf):
    name = fresh_name("people")
    register_view(table(spark, sf, "customer"), name)
    return spark.sql(f"SELECT c_name, c_acctbal FROM {name} WHERE c_acctbal >= 1300 AND c_acctbal <= 5900")


@query("ctas", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def ctas(spark, sf):
    name = fresh_name("suppliers")
    create_table_as(table(spark, sf, "region"), name)
    create_table_as(table(spark, sf, "supplier"), name)
    return spark.sql(f"SELECT * FROM {name}")


def _versions(spark, sf):
    store = VersionStore(spark, fresh_path(spark, "store"))
    orders = table(spark, sf, "orders")
    for run_id, status in (("20230101T000000Z", "F"), ("20230201T000000Z", "O"), ("20230301T000000Z", "P")):
        store.archive(orders.where(F.col("o_orderstatus") == status), "orders", run_id, status=status)
    return store


@query(
    "archive_versions",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN '20230101T000000Z' WHEN 'O' THEN '20230201T000000Z'
                              ELSE '20230301T000000Z' END AS run_id,
           'orders' AS stage, count(*) AS row_count, concat('{"status": "', o_orderstatus, '"}') AS details
    FROM orders GROUP BY o_orderstatus
    """,
)
def archive_versions(spark, sf):
    return _versions(spark, sf).manifest().select("run_id", "stage", "row_count", "details")


@query(
    "restore_latest",
    """
    SELECT 'newest' AS version, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT 'named', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    """,
)
def restore_latest(spark, sf):
    store = _versions(spark, sf)
    newest = store.restore("orders").select(F.lit("newest").alias("version"), "o_orderkey", "o_totalprice")
    named = store.restore("orders", "20230101T000000Z")
    return newest.unionByName(named.select(F.lit("named").alias("version"), "o_orderkey", "o_totalprice"))


@query(
    "vector_array_round_trip",
    """
    SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[2] AS DOUBLE) AS second,
           round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
    FROM embeddings
    """,
)
def vector_array_round_trip(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    path = fresh_path(spark, "vectors")
    write_parquet(to_array_column(vectors), path)
    back = vector_to_array("features")
    return to_vector_column(spark.read.parquet(path)).select(
        "vec_id", F.size(back).alias("n"), back[1].alias("second"), F.round(array_total(back), 6).alias("total")
    )


@query("rename_columns", "SELECT l_orderkey, l_tax AS l_discount, l_discount AS l_tax FROM lineitem")
def rename_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_discount", "l_tax")
    return rename(lines, {"l_discount": "l_tax", "l_tax": "l_discount"})


@query("write_parquet_round_trip", "SELECT c_name, c_mktsegment FROM customer")
def write_parquet_round_trip(spark, sf):
    path = fresh_path(spark, "chosen")
    write_parquet(table(spark, sf, "customer"), path, ["c_custkey"])
    write_parquet(table(spark, sf, "customer"), path, ["c_name", "c_mktsegment"])
    return spark.read.parquet(path)


@query(
    "write_text",
    "SELECT concat_ws(',', user_id, count(*)) AS value FROM events GROUP BY user_id",
)
def write_text_query(spark, sf):
    path = fresh_path(spark, "text")
    counts = group_count(table(spark, sf, "events"), "user_id")
    write_text(counts.select(F.concat_ws(",", "user_id", "count").alias("value")), path)
    return spark.read.text(path)


@query("load_into_table", "SELECT p_partkey AS key, p_name AS value FROM part")
def load_into_table_query(spark, sf):
    path, name = fresh_path(spark, "loaded"), fresh_name("src")
    table(spark, sf, "part").select("p_partkey", "p_name").write.option("sep", "\x01").csv(path)
    create_empty_table(spark, name, "key BIGINT, value STRING")
    load_into_table(spark, path, name)
    return spark.sql(f"FROM {name} SELECT key, value")


@query(
    "list_tables",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS name, count(*) AS n, true AS is_temporary FROM {t}" for t in GIVEN),
)
def list_tables(spark, sf):
    prefix = fresh_name("given")
    for name in GIVEN:
        register_view(table(spark, sf, name), f"{prefix}_{name}")
    listed = catalog_names(spark).where(F.col("name").startswith(prefix))
    listed = listed.select(F.replace("name", F.lit(f"{prefix}_"), F.lit("")).alias("name"), "is_temporary")
    counts = None
    for name in GIVEN:
        one = scan_table(spark, f"{prefix}_{name}").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return listed.join(counts, "name").select("name", "n", "is_temporary")


def _version_names(spark, sf):
    """A table name per event: the event type with the event's time as version tag."""
    return table(spark, sf, "events").select(
        "event_id", "event_type", "ts", F.lower(F.concat_ws("_", "event_type", make_tag("ts"))).alias("name")
    )


@query(
    "latest_version",
    """
    SELECT event_type, upper(strftime(max(ts), '%Y%m%dT%H%M%SZ')) AS tag
    FROM events GROUP BY event_type
    """,
)
def latest_version(spark, sf):
    return latest_versions(_version_names(spark, sf), "event_type")


@query(
    "orphan_tables",
    """
    WITH tagged AS (SELECT event_type, value, strftime(ts, '%Y%m%dT%H%M%SZ') AS tag FROM events)
    SELECT lower(concat(event_type, '_', tag)) AS name FROM tagged
    WHERE tag NOT IN (SELECT tag FROM tagged WHERE value >= 10)
    """,
)
def orphan_tables_query(spark, sf):
    runs = table(spark, sf, "events").where("value >= 10").select(make_tag("ts").alias("run_id"))
    return orphan_tables(_version_names(spark, sf), runs)


@query(
    "sweep_orphans",
    """
    SELECT CASE l_returnflag WHEN 'A' THEN 'kept' ELSE 'dropped' END AS fate, l_returnflag, count(*) AS n
    FROM lineitem GROUP BY ALL
    """,
)
def sweep_orphans_query(spark, sf):
    # One version table per return flag; only the run of flag A is known.
    lines, base = table(spark, sf, "lineitem"), fresh_name("lines")
    tags = {"A": "20230101T000000Z", "N": "20230201T000000Z", "R": "20230301T000000Z"}
    stored, counts = {f: f"{base}_{tag}".lower() for f, tag in tags.items()}, None
    for flag, name in stored.items():
        create_table_as(lines.where(F.col("l_returnflag") == flag), name)
        one = scan_table(spark, name).agg(
            F.lit(name).alias("name"), F.lit(flag).alias("l_returnflag"), F.count(F.lit(1)).alias("n")
        )
        counts = one if counts is None else counts.unionByName(one)
    counted = fresh_path(spark, "counts")
    counts.write.parquet(counted)
    runs = spark.createDataFrame([(tags["A"],)], "run_id string")
    # Version tables of anyone else in this catalog count as known and stay.
    others = catalog_names(spark).where(~F.col("name").startswith(base)).select(name_tag("name").alias("run_id"))
    dropped = sweep_orphans(spark, runs.unionByName(others.where("run_id IS NOT NULL")), dry_run=False)
    return spark.read.parquet(counted).select(
        F.when(F.col("name").isin(dropped), "dropped").otherwise("kept").alias("fate"), "l_returnflag", "n"
    )


@query(
    "version_tags",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE strftime(ts, '%Y%m%dT%H%M%SZ') END AS tag,
           event_type <> 'error' AS valid,
           CASE WHEN event_type <> 'error' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS seconds
    FROM events
    """,
)
def version_tags(spark, sf):
    tagged = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(make_tag("ts")).alias("tag")
    )
    return tagged.select("event_id", "tag", is_tag("tag").alias("valid"), F.unix_timestamp(parse_tag("tag")).alias("seconds"))


@query(
    "delta_versions",
    """
    WITH second AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority
        FROM orders WHERE o_orderkey % 7 <> 0
    )
    SELECT 'second' AS version, * FROM second
    UNION ALL SELECT 'third', * FROM second WHERE o_orderpriority <> '1-URGENT'
    UNION ALL SELECT 'third', o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 7 = 0
    """,
)
def delta_versions(spark, sf):
    """Three versions of the orders, the later two stored as differences and restored by replay."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    raised = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    second = orders.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", raised)
    third = second.where("o_orderpriority <> '1-URGENT'").unionByName(orders.where("o_orderkey % 7 = 0"))
    store = DeltaStore(spark, fresh_path(spark, "delta-store"))
    for name, rows in (("first", orders), ("second", second), ("third", third)):
        store.archive(rows, "orders", name)
    restored = [store.restore("orders", name).select(F.lit(name).alias("version"), "*") for name in ("second", "third")]
    return restored[0].unionByName(restored[1])
