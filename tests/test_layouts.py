"""Bucketed and partitioned tables, the skip index and partial aggregates."""

import re

import pytest
from pyspark.sql import functions as F

from quillframe.plans.grep_index import GrepArchive, literals
from quillframe.plans.partials import PartialStore
from quillframe.session import fresh_name
from quillframe.sinks.layout import create_bucketed_table, join_bucketed, join_on_partition, write_by_value


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def content(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_bucketed_join(spark, no_broadcast, how):
    """A key with a third of the rows on one side, one hot on the other, nulls on both; the rest joins without an exchange."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 200)
    left = spark.range(3000).select(key.alias("k"), F.col("id").alias("a"))
    right = spark.range(600).select(F.when(F.col("id") < 200, F.col("id")).when(F.col("id") < 590, 11).alias("k"), F.col("id").alias("b"))
    one = create_bucketed_table(left, fresh_name("one"), "k", 8)
    two = create_bucketed_table(right, fresh_name("two"), "k", 8)
    assert one.hot == (7,) and two.hot == (11,)
    joined = join_bucketed(spark, one, two, how)
    assert content(joined) == content(left.join(right, "k", how))
    assert content(one.all_rows(spark)) == content(left)
    # Both sides of the bucketed rows alone: no exchange. The rest has its own.
    cold = spark.table(one.name).join(spark.table(two.name), "k", how)
    assert "Exchange" not in plan(cold) and "SortMergeJoin" in plan(cold)
    fresh = plan(join_bucketed(spark, one, two, how))
    assert fresh.count("Exchange hashpartitioning") == plan(spark.table(one.beside).join(spark.table(two.beside), "k")).count("Exchange hashpartitioning")


def test_bucketed_edges(spark):
    empty = spark.createDataFrame([], "k string, v int")
    table = create_bucketed_table(empty, fresh_name("empty"), "k", 4)
    other = create_bucketed_table(spark.createDataFrame([("x", 1), (None, 2)], "k string, w int"), fresh_name("other"), "k", 4)
    assert table.hot == () and join_bucketed(spark, table, other).count() == 0
    assert content(join_bucketed(spark, other, table, "left")) == ["Row(k='x', w=1, v=None)", "Row(k=None, w=2, v=None)"]
    with pytest.raises(ValueError):
        join_bucketed(spark, table, table)
    with pytest.raises(ValueError):
        join_bucketed(spark, table, other, "full")


def test_pruned_partitions(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "2020-01").otherwise(F.concat(F.lit("2020-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"))).alias("month"))
    write_by_value(rows, "month", f"{tmp_path}/fact", 12)
    spark.createDataFrame([(f"2020-{m:02d}", m) for m in range(1, 13)], "month string, number int").write.parquet(f"{tmp_path}/dim")
    fact, dim = spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/dim").where("number = 5")
    joined = join_on_partition(fact, dim, "month")
    assert "dynamicpruning" in plan(joined)
    assert joined.count() == rows.where("month = '2020-05'").count() > 0
    files = fact.select("month", F.col("_metadata.file_path").alias("f")).groupBy("month").agg(F.count_distinct("f").alias("n"))
    by_month = dict(files.collect())
    # The hot month is cut into several files, the others are not.
    assert by_month["2020-01"] >= 3 and by_month["2020-05"] <= 2
    joined = join_on_partition(fact, dim, "month").select("id", "number")
    joined.collect()
    scans, todo = [], [joined._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            scans.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    read = sorted(scan.metrics().apply("numFiles").value() for scan in scans)
    assert by_month["2020-05"] in read and sum(read) < sum(by_month.values())


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("needle", ["needle"]), ("nee+dle", ["nee", "dle"]), ("need?le.*end", ["nee", "end"]), (r"a\.bc\d+xyz", ["a.bc", "xyz"]), ("abc|def", []),
        ("(abc|def)ghi", ["ghi"]), ("(?i)abc", []), ("[a-z]{3}tail", ["tail"]), ("abc{2}", []), ("abcd{0,2}ef", ["abc"]), (r"[\]x]abc", ["abc"]), (r"\Qa.b\E", []),
        ("^line$", ["line"]), ("(a[)]b)cde", ["cde"]), ("x(?=abc)", []), ("", []), ("[[a]b]cde", []), ("abc*?def", ["def"]), (r"\p{L}abc", []),
    ],
)
def test_literals(pattern, want):
    assert literals(pattern) == want


def test_grep_archive(spark, tmp_path):
    """Counts equal the full scan; few files are read where the pattern has literals; files without an index are read."""
    texts = [f"line {i} " + ("needle number" if i in (5, 250) else "hay") + f" code-{i % 7}.x été \U0001f600\U0001f601!" for i in range(400)] + [None, "", "ab"]
    frame = spark.createDataFrame([(t,) for t in texts], "body string").repartitionByRange(20, "body")
    archive = GrepArchive(spark, f"{tmp_path}/a", bits=14)
    archive.add(frame, "body")
    for pattern in ("needle", "need[a-z]e n", "NEEDLE", "zebra", "hay|needle", r"code-3\.x", "été", "\U0001f600.?!", "^$", "ne+dle number", "(?i)NEEDLE", ".", "\U0001f600\U0001f601!"):
        row = archive.count(pattern).first()
        flags = re.I if pattern.startswith("(?i)") else 0
        assert row.n == sum(bool(re.search(pattern.replace("(?i)", ""), t, flags)) for t in texts if t is not None), pattern
        assert row.files_read <= row.files
    assert archive.count("needle").first().files_read <= 3 and archive.count("zebra").first().files_read == 0
    # A run that was lost before its index leaves files that are read, and indexed by the next.
    spark.createDataFrame([("a lost needle",)], "text string").write.mode("append").parquet(archive.rows)
    assert archive.count("needle").first().n == 3
    archive.add(spark.createDataFrame([("one more zebra",)], "body string"), "body")
    assert archive.count("needle").first().n == 3 and archive.count("zebra").first().n == 1
    assert archive.count("zebra").first().files_read == 1


def test_partials(spark, tmp_path):
    store = PartialStore(spark, f"{tmp_path}/p", ["k"], ["v"])
    frame = lambda rows: spark.createDataFrame(rows, "k string, v bigint")
    store.add("a", frame([("x", 1), ("x", None), (None, 5)]))
    store.add("b", frame([("x", 10), ("y", 2)]))
    assert content(store.total(["a"])) == content(spark.createDataFrame([("x", 2, 1, 1, 1, 1, 1.0), (None, 1, 1, 5, 5, 5, 5.0)], store.total(["a"]).schema))
    store.add("b", frame([("y", 3)]))
    assert {r.k: (r.n, r.v_sum) for r in store.total().collect()} == {"x": (2, 1), None: (1, 5), "y": (1, 3)}
    store.drop("a")
    assert {r.k: (r.n, r.v_sum, r.v_mean) for r in store.total().collect()} == {"y": (1, 3, 3.0)}
    # A folder that no manifest row names, as a lost run leaves it, does not count.
    frame([("z", 1)]).groupBy("k").agg(F.count("*").alias("n")).write.parquet(f"{tmp_path}/p/parts/lost")
    assert [r.k for r in store.total().collect()] == ["y"]
    with pytest.raises(KeyError):
        store.total(["a"])
