"""Text steps."""

import pyarrow as pa
import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from quillframe.functions import arrays, text
from quillframe.functions.porter import stem
from quillframe.functions.stopwords import STOP_WORDS
from quillframe.functions import tags
from quillframe.plans.topics import annotate


@pytest.mark.parametrize(
    "word, root",
    [
        # The examples of the published algorithm, followed through all steps.
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("feed", "feed"),
        ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"),
        ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"),
        ("vietnamization", "vietnam"), ("operator", "oper"), ("hopefulness", "hope"), ("sensibiliti", "sensibl"),
        ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"), ("goodness", "good"),
        ("revival", "reviv"), ("replacement", "replac"), ("adoption", "adopt"), ("bowdlerize", "bowdler"),
        ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controlling", "control"), ("roll", "roll"),
        ("generalizations", "gener"), ("oscillators", "oscil"), ("toy", "toi"), ("is", "is"), ("", ""),
    ],
)
def test_stem(word, root):
    assert stem(word) == root


def test_stop_words_are_sparks(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_steps(spark):
    df = spark.createDataFrame([(1, "  The\tCats' \n RUNNING, running!  "), (2, ""), (3, None)], "id int, headline_text string")
    rows = {r.id: r for r in annotate(df).collect()}
    assert rows[1].document == "The Cats' RUNNING, running!"
    assert rows[1].token == ["the", "cats", "running", "running"] == rows[1].normalized
    assert rows[1].cleanTokens == ["cats", "running", "running"]
    assert rows[1].stem == ["cat", "run", "run"] == rows[1].tokens
    assert rows[2].tokens == [] and rows[3].tokens is None
    assert annotate(df, stems=False).where("id = 1").first().tokens == ["cats", "running", "running"]


def test_blank_separated_tokens(spark):
    df = spark.createDataFrame([("Don't stop -- well-known cats!",)], "headline_text string")
    row = annotate(df, token_pattern=text.NOT_BLANK).first()
    assert row.token == ["don't", "stop", "--", "well-known", "cats!"]
    assert row.normalized == ["dont", "stop", "wellknown", "cats"]
    assert row.tokens == ["dont", "stop", "wellknown", "cat"]


def test_normalize_and_stop_case(spark):
    df = spark.createDataFrame([(["don't", "!!", "The", "déjà-vu", "x1"],)], "t array<string>")
    assert df.select(text.normalize("t")).first()[0] == ["dont", "The", "déjàvu", "x"]
    assert df.select(text.remove_stop_words("t")).first()[0] == ["!!", "déjà-vu", "x1"]


def test_stems_keep_place_over_batches(spark):
    words = ["cats", "running", "x", None]
    df = spark.range(1000).select("id", F.slice(F.array(*[F.lit(w) for w in words]), 1, (F.col("id") % 5).cast("int")).alias("t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for r in df.select("id", text.stem_tokens("t").alias("s")).collect():
            assert r.s == ["cat", "run", "x", None][: r.id % 5]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_used_steps_are_computed(spark, tmp_path):
    spark.createDataFrame([(1, "a text", "unused")], "id int, text string, untouched string").write.parquet(f"{tmp_path}/t")
    plan = annotate(spark.read.parquet(f"{tmp_path}/t"), "text").select("id", "cleanTokens")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "stem_tokens" not in shown and "untouched" not in shown and "Exchange" not in shown


def test_array_helpers(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 3.0]), (2, [])], "id int, f1 array<double>")
    vectors = arrays.to_vector_column(df)
    assert "f1" not in vectors.columns
    rows = vectors.select("id", arrays.vector_total("features").alias("t"), arrays.row_maximum("features").alias("m"), arrays.entries("features").alias("e"))
    first, second = rows.orderBy("id").collect()
    assert (first.t, first.m, [tuple(e) for e in first.e]) == (4.0, 3.0, [(0, 1.0), (2, 3.0)])
    assert (second.t, second.m, second.e) == (0.0, None, [])
    assert arrays.to_array_column(vectors).orderBy("id").first().f1 == [1.0, 0.0, 3.0]


def test_tags(spark):
    df = spark.createDataFrame([("20230520T101112Z",), ("x",), ("20231345T101112Z",), (None,)], "tag string")
    rows = df.select(tags.is_tag("tag").alias("ok"), F.unix_timestamp(tags.parse_tag("tag")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(True, 1684577472), (False, None), (True, None), (False, None)]
    names = spark.createDataFrame([("stage1_20230520t101112z",), ("my_table",), ("plain",), ("a_b_20230520t101112z",)], "name string")
    assert [r[0] for r in names.select(tags.name_tag("name")).collect()] == ["20230520T101112Z", None, None, "20230520T101112Z"]
    assert [r[0] for r in names.select(tags.suffix_after_first("name")).collect()] == ["20230520T101112Z", "TABLE", "PLAIN", "B_20230520T101112Z"]


def test_tag_time_does_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("20230312T023000Z",)], "tag string")
        assert df.select(F.unix_timestamp(tags.parse_tag("tag"))).first()[0] == 1678588200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sparse_vectors_stay_sparse(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.sql import functions as F

    from quillframe.functions.arrays import entries, row_maximum, to_parts_column, vector_total

    vectors = [Vectors.sparse(5, [1, 3], [2.0, -1.0]), Vectors.dense([0.0, 4.0, 0.0]), Vectors.sparse(3, [], []), Vectors.sparse(2, [0, 1], [-3.0, -2.0]), Vectors.sparse(2, [0], [-3.0]), Vectors.dense([])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], ["i", "v"])
    rows = df.select("i", row_maximum("v").alias("top"), vector_total("v").alias("total"), entries("v").alias("e")).orderBy("i").collect()
    assert [r.top for r in rows] == [2.0, 4.0, 0.0, -2.0, 0.0, None]
    assert [r.total for r in rows] == [1.0, 4.0, 0.0, -5.0, -3.0, 0.0]
    assert [[tuple(p) for p in r.e] for r in rows] == [[(1, 2.0), (3, -1.0)], [(1, 4.0)], [], [(0, -3.0), (1, -2.0)], [(0, -3.0)], []]
    parts = to_parts_column(df, "v", "p").orderBy("i").select(F.col("p.size"), F.col("p.indices"), F.col("p.values")).collect()
    assert [tuple(p) for p in parts[:2]] == [(5, [1, 3], [2.0, -1.0]), (3, [1], [4.0])]


def test_stems_are_cut_into_slices_and_forgotten(monkeypatch):
    monkeypatch.setattr(text, "_SLICE", 3)
    monkeypatch.setattr(text, "_SEEN_LIMIT", 4)
    monkeypatch.setattr(text, "_SEEN", {})
    words = ["cats", None, "running", "cats", *(f"dogs{chr(97 + i)}s" for i in range(20)), "agreed"]
    for column in (pa.array(words), pa.array([*words, "x"]).slice(0, len(words))):
        assert text._stems(column).to_pylist() == [stem(w) for w in words]
        # However many words there are, no more are remembered.
        assert len(text._SEEN) <= 4
    assert text._stems(pa.array([], pa.string())).to_pylist() == []


def test_words_without_a_listed_ending_take_no_step(monkeypatch):
    from quillframe.functions import porter

    calls = []
    monkeypatch.setattr(porter, "_plural", lambda word: calls.append(word) or word)
    assert [porter.stem(w) for w in ("garten", "haut", "zah", "schön", "tag")] == ["garten", "haut", "zah", "schön", "tag"]
    assert not calls
    # Every listed ending is still looked at.
    for ending in (*porter.STEP_2, *porter.STEP_3, *porter.STEP_4, "s", "eed", "ed", "ing", "y", "e", "ll"):
        porter.stem("xx" + ending)
    assert len(calls) == len(porter.STEP_2) + len(porter.STEP_3) + len(porter.STEP_4) + 7


def test_frequent_words_stay_remembered(monkeypatch):
    from quillframe.functions import porter, text

    for name in ("_SEEN", "_SEEN_BEFORE"):
        monkeypatch.setattr(text, name, {})
    monkeypatch.setattr(text, "_SEEN_LIMIT", 6)
    calls = []
    real = porter.stem
    monkeypatch.setattr(porter, "stem", lambda word: calls.append(word) or real(word))
    for i in range(20):
        found = text._stems(pa.array(["running", f"rare{i}s", None, "running"]))
        assert found.to_pylist() == ["run", f"rare{i}", None, "run"]
        assert len(text._SEEN) + len(text._SEEN_BEFORE) <= 6
    assert calls.count("running") == 1
