"""Sources and sinks on small files with known results."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quillframe.operators import relational as ops
from quillframe.operators.udf import apply_partitions, apply_rows
from quillframe.sinks.files import write_parquet, write_text
from quillframe.sinks.tables import create_empty_table, create_table_as, load_into_table, register_view, scan_table
from quillframe.sources import files, jdbc, values as made
from quillframe.session import fresh_name, shared_dir

from .conftest import values


def test_json(spark, people):
    df = files.read_json(spark, people)
    assert df.dtypes == [("age", "bigint"), ("name", "string")]
    assert values(df) == [(19, "Justin"), (30, "Andy"), (None, "Michael")]


def test_people_projections(spark, people):
    df = files.read_json(spark, people)
    assert values(df.select("name")) == [("Andy",), ("Justin",), ("Michael",)]
    assert values(df.select("name", F.col("age") + 1)) == [("Andy", 31), ("Justin", 20), ("Michael", None)]
    assert values(df.where(df.age > 21)) == [(30, "Andy")]
    assert values(ops.group_count(df, "age")) == [(19, 1), (30, 1), (None, 1)]
    register_view(df, "people_of_test")
    teenagers = spark.sql("SELECT name FROM people_of_test WHERE age >= 13 AND age <= 19")
    assert values(teenagers) == [("Justin",)]


def test_partition_function(spark, people):
    df = files.read_json(spark, people)
    named = apply_partitions(df, lambda p: ("Name: " + p["name"]).to_frame("name"), "name string")
    assert values(named) == [("Name: Andy",), ("Name: Justin",), ("Name: Michael",)]
    ages = apply_rows(lambda age: age * 2, "bigint")
    assert values(df.select(ages("age"))) == [(38,), (60,), (None,)]


def test_merged_schema(spark, tmp_path):
    made.from_values(spark, [(12.0, 19.0), (29.0, 23.0)], "single double, double double").write.parquet(f"{tmp_path}/t/key=1")
    made.from_values(spark, [(19.0, 23.0), (23.0, 18.0)], "double double, triple double").write.parquet(f"{tmp_path}/t/key=2")
    df = files.read_parquet(spark, f"{tmp_path}/t", merge_schema=True)
    assert sorted(df.dtypes) == [("double", "double"), ("key", "int"), ("single", "double"), ("triple", "double")]
    assert df.count() == 4


def test_range_and_empty(spark):
    rows = made.range_step(spark, 0, 4, 2, 5)
    assert values(rows) == [(0,), (2,)]
    assert rows.rdd.getNumPartitions() == 5
    empty = made.empty_frame(spark, "value string")
    assert empty.count() == 0 and empty.dtypes == [("value", "string")]


NAMES = (
    "member,born,land,town,joined,level,tariff,by_phone,by_mail,friends,invited,accepted"
)


def test_typed_delimited(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text(f"{NAMES}\nu1,1980,PL,Gdansk,2018,1,STANDARD,1.0,0.0,3,0,0\n{NAMES}\nu2,1990,GB,Leeds,2018,0,METAL,,,7,1,0\n")
    df = files.read_typed_delimited(spark, str(path), (2, 6, 10, 11, 12))
    assert [t for _, t in df.dtypes] == ["string", "int"] + ["string"] * 3 + ["int"] + ["string"] * 3 + ["int"] * 3
    assert [(r.member, r.born, r.friends) for r in df.orderBy("member").collect()] == [("u1", 1980, 3), ("u2", 1990, 7)]


def test_typed_delimited_bad_number(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\nx,1\ny,two\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_typed_delimited(spark, str(path), (2,)).collect()
    assert values(files.read_typed_delimited(spark, str(path), (2,), strict=False)) == [("x", 1), ("y", None)]


def test_token_lines_keep_blanks(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("a  b\nc\n")
    assert [r.words for r in files.read_token_lines(spark, str(path)).collect()] == [["a", "", "b"], ["c"]]


def test_csv_options(spark, tmp_path):
    path = tmp_path / "headlines.csv"
    path.write_text("publish_date;headline_text\n20030219;aba decides\n")
    inferred = files.read_csv(spark, str(path), sep=";")
    assert inferred.dtypes == [("publish_date", "int"), ("headline_text", "string")]
    assert files.read_csv(spark, str(path), sep=";", infer=False).dtypes[0] == ("publish_date", "string")
    assert files.read_csv(spark, str(path), sep=";", schema="d string, h string").columns == ["d", "h"]


def test_libsvm(spark, tmp_path):
    path = tmp_path / "points.txt"
    path.write_text("1.0 1:0.5 3:2.0\n0.0 2:1.0\n")
    assert [(r.label, r.features.toArray().tolist()) for r in files.read_libsvm(spark, str(path)).collect()] == [
        (1.0, [0.5, 0.0, 2.0]),
        (0.0, [0.0, 1.0, 0.0]),
    ]


def test_views_and_tables(spark):
    df = spark.range(3)
    name = fresh_name("numbers")
    register_view(df, name, replace=False)
    with pytest.raises(AnalysisException):
        register_view(df, name, replace=False)
    table = fresh_name("stored")
    create_table_as(spark.range(5), table)
    create_table_as(spark.range(2), table)
    assert scan_table(spark, table).count() == 2


def test_load_appends(spark, tmp_path):
    name = fresh_name("src")
    (tmp_path / "kv.txt").write_text("238\x01val_238\n86\x01val_86\n")
    create_empty_table(spark, name, "key INT, value STRING")
    create_empty_table(spark, name, "key INT, value STRING")
    for _ in range(2):
        load_into_table(spark, str(tmp_path / "kv.txt"), name)
    assert values(spark.table(name).distinct()) == [(238, "val_238"), (86, "val_86")]
    assert spark.table(name).count() == 4


def test_text_files(spark, tmp_path):
    lines = spark.range(100).select(F.col("id").cast("string").alias("value")).repartition(8)
    for partitions in (None, 1):
        path = f"{tmp_path}/out{partitions}"
        for _ in range(2):
            write_text(lines, path, partitions)
        found = spark.read.text(path)
        assert found.count() == 100 and (len(found.inputFiles()) == 1) == (partitions == 1)


def test_chosen_columns(spark, tmp_path):
    df = made.from_values(spark, [(1, "a", None)], "id int, name string, color string")
    write_parquet(df, f"{tmp_path}/u", ["name", "color"])
    assert files.sql_on_file(spark, f"{tmp_path}/u").columns == ["name", "color"]


class _Recorder:
    def __init__(self):
        self.calls = []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))


class _Session:
    def __init__(self):
        self.read = _Recorder()
        self.write = _Recorder()


def test_jdbc_options():
    # No database is started here, so only what is handed to Spark is checked.
    session = _Session()
    jdbc.read_jdbc(session, "jdbc:x", "t", user="u", password="p", column="id", lower=0, upper=100, partitions=8)
    (_, kwargs), = session.read.calls
    assert (kwargs["column"], kwargs["numPartitions"], kwargs["properties"]["user"]) == ("id", 8, "u")
    jdbc.write_jdbc(session, "jdbc:x", "t", user="u", password="p", mode="append")
    (_, kwargs), = session.write.calls
    assert kwargs["mode"] == "append" and kwargs["properties"]["numPartitions"] == "32"
    with pytest.raises(ValueError, match="lower"):
        jdbc.read_jdbc(session, "jdbc:x", "t", user="u", password="p", column="id")


def test_shared_dir_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_filters_and_columns_reach_the_scan(spark):
    from quillframe.queries import QUERIES

    plan = QUERIES["scan_parquet"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
