"""Joins, sets, limits and counts on small frames."""

import pytest
from pyspark.sql import functions as F

from quillframe.operators import relational as ops
from quillframe.operators.partitions import explode_once
from quillframe.operators.similarity import vector_top_k

from .conftest import values


def test_inner_join_multiplies(spark):
    left = spark.createDataFrame([("foo", 1), ("bar", 2), ("baz", 3)], "k string, a int")
    right = spark.createDataFrame([("foo", 4), ("bar", 5), ("bar", 6)], "k string, b int")
    assert values(ops.join_pairs(left, right, "k")) == [("bar", 2, 5), ("bar", 2, 6), ("foo", 1, 4)]


def test_self_join_counts_copies(spark):
    pairs = spark.createDataFrame([("a", "x")] * 3 + [("a", "y"), ("b", "z")], "k string, v string")
    found = {r.v: (r.copies, r.joined) for r in ops.join_self(pairs, "k", "v").collect()}
    assert found == {"x": (3, 12), "y": (1, 4), "z": (1, 1)}
    whole = ops.join_pairs(pairs, pairs.withColumnRenamed("v", "w"), "k")
    assert whole.count() == sum(joined for _, joined in found.values())


def test_subtract_keeps_other_duplicates(spark):
    lines = spark.createDataFrame([("h",), ("a",), ("a",), ("h",), (None,), (None,)], "value string")
    header = spark.createDataFrame([("h",)], "value string")
    assert values(ops.subtract_rows(lines, header)) == [("a",), ("a",), (None,), (None,)]
    nothing = spark.createDataFrame([(None,)], "value string")
    assert values(ops.subtract_rows(lines, nothing)) == [("a",), ("a",), ("h",), ("h",)]


def test_subtract_plan_has_no_nested_loop(spark):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("s"))
    plan = ops.subtract_rows(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_set_difference_is_distinct(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert values(ops.set_difference(left, spark.createDataFrame([("b",)], "v string"))) == [("a",), (None,)]


@pytest.mark.parametrize("n", [-1, 0, 1, 2, 3, 4, 5, 6, 7, 100])
def test_limit_is_exact_with_ties_and_nulls(spark, n):
    keys = [None, 1, 2, 2, 2, 5]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(3)
    got = sorted((r.k is not None, r.k or 0) for r in ops.limit_rows(df, n, "k").collect())
    want = sorted((k is not None, k or 0) for k in keys)
    assert got == (want if n <= 0 else want[:n])


def test_limit_does_not_depend_on_partitions(spark):
    df = spark.range(40).selectExpr("id % 3 AS k", "id", "concat('t', id) AS text")
    picks = [sorted(r.id for r in ops.limit_rows(df.repartition(n), 5, "k").collect()) for n in (3, 8)]
    assert picks[0] == picks[1] and len(picks[0]) == 5


def test_limit_on_only_nulls_and_no_rows(spark):
    nulls = spark.createDataFrame([(None,)] * 4, "k string")
    assert ops.limit_rows(nulls, 3, "k").count() == 3
    assert ops.limit_rows(nulls.limit(0), 3, "k").count() == 0


@pytest.mark.parametrize("n", [1, 40, 333, 700, 999, 1000, 1200])
def test_limit_by_ranges_takes_the_same_rows(spark, n):
    """A third of the rows are alike in every column; the cut falls before, within and behind them."""
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 500, id) AS k", "IF(id % 3 = 0, NULL, id) AS v").repartition(5)
    direct, ranges = ops.limit_rows(df, n, "k"), ops.limit_rows(df, n, "k", direct=0)
    assert values(ranges) == values(direct) and ranges.count() == min(n, 1000)
    assert ops.limit_rows(df.where("false"), n, "k", direct=0).count() == 0


def test_rows_at_max(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "t int, v string")
    assert values(ops.rows_at_max(df, "t")) == [(3, "b"), (3, "c")]


def test_group_average_skips_text(spark):
    df = spark.createDataFrame([("d1", "1"), ("d1", "NA"), ("d1", "3"), ("d2", "NA")], "day string, delay string")
    assert values(ops.group_average(df, ["day"], ["delay"])) == [("d1", 2.0), ("d2", None)]


def test_rows_in_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (None,)], "m int")
    assert values(ops.rows_in(df, members, "k", "m")) == [(1,), (1,)]


def test_conditional_counts_read_once(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("ab\na\nB\n")
    lines = spark.read.text(str(path))
    counted = ops.conditional_counts(lines, a=F.col("value").contains("a"), b=F.col("value").contains("b"))
    assert counted._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    assert values(counted) == [(2, 1)]


def test_grep(spark):
    df = spark.createDataFrame([("dfs.name dfs.data x",), ("dfs.name",), (None,)], "value string")
    assert [tuple(r) for r in ops.grep_counts(df, "value", "dfs[a-z.]+").collect()] == [("dfs.name", 2), ("dfs.data", 1)]


def test_swap_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ops.rename(df, {"a": "b", "b": "a"}).first().asDict() == {"b": 1, "a": 2}


def test_explode_evaluates_once(spark):
    df = spark.createDataFrame([("a b",), ("",)], "text string")
    words = explode_once(df, F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0)), "w")
    assert values(words) == [("a",), ("b",)]
    assert words._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_top_k(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "id int, v array<double>")
    found = vector_top_k(df, "id", "v", [2.0, 0.0], 5).collect()
    assert [r.id for r in found] == [1, 3, 2]
    assert found[1].similarity == pytest.approx(0.5**0.5)
