"""Count vectors, topics, word vectors and the staged run."""

import random
import uuid

import pytest

from quillframe.functions.arrays import vector_total
from quillframe.operators.partitions import spread
from quillframe.operators.relational import limit_rows, sum_of_row_maxima
from quillframe.operators.udf import config_sweep
from quillframe.plans import jobs, word_vectors
from quillframe.plans.topics import (
    TopicSettings,
    annotate,
    count_vector_stage,
    count_vectors,
    documents_with_topic,
    fit_topics,
    vocabulary,
)
from quillframe.plans.versions import VersionStore
from quillframe.plans.word_vectors import fit_word_vectors, synonyms, word_vector
from quillframe.session import shared_dir

ROWS = [(1, ["a", "a", "a", "b"]), (2, ["b", "b", "b", "c"]), (3, ["c"]), (4, [])]
SETTINGS = TopicSettings(topics=2, iterations=5)


@pytest.fixture
def tokens(spark):
    return spark.createDataFrame(ROWS, "id int, tokens array<string>")


def test_vocabulary_order(tokens):
    assert [tuple(r) for r in vocabulary(tokens, 10).collect()] == [("b", 4), ("a", 3), ("c", 2)]
    assert [r.word for r in vocabulary(tokens, 1).collect()] == ["b"]


def test_count_vectors_threshold(tokens):
    found = {r.id: r.features.toArray().tolist() for r in count_vectors(tokens, ["b", "a", "c"], 3.0).collect()}
    assert found == {1: [0, 3, 0], 2: [3, 0, 0], 3: [0, 0, 0], 4: [0, 0, 0]}
    share = {r.id: r.features.toArray().tolist() for r in count_vectors(tokens, ["b", "a", "c"], 0.5).collect()}
    assert share[1] == [0, 3, 0] and share[3] == [0, 0, 1]


def test_row_maxima(spark, tokens):
    assert sum_of_row_maxima(count_vectors(tokens, ["b", "a", "c"], 3.0)).first()[0] == 6.0
    none = count_vectors(tokens.limit(0), ["b"], 3.0)
    assert sum_of_row_maxima(none).first()[0] == 0.0


def test_gate(spark, tokens):
    assert count_vector_stage(tokens, TopicSettings(min_tf=9.0), "id") is None
    assert count_vector_stage(tokens.limit(0), SETTINGS, "id") is None
    assert count_vector_stage(tokens.where("id = 4"), SETTINGS, "id") is None


def test_document_limit(tokens):
    stage = count_vector_stage(tokens, TopicSettings(documents=1), "id")
    assert stage.vocabulary == ["a", "b"] and stage.vectors.count() == 1
    stage.release()


def test_document_limit_reaches_the_scan(spark, tmp_path):
    spark.range(50).selectExpr("id", "concat('word', id) AS text").write.parquet(f"{tmp_path}/t")
    done = annotate(spread(spark.read.parquet(f"{tmp_path}/t")), "text").select("id", "tokens")
    limited = limit_rows(done, 7, "id")
    plan = limited._jdf.queryExecution().executedPlan().toString()
    # Text steps come after the filter, so no other text is read into them.
    assert plan.index("stem_tokens") < plan.index("Filter") < plan.index("FileScan")
    assert limited.count() == 7


@pytest.mark.parametrize("optimizer", ["online", "em"])
def test_topic_hits(tokens, optimizer):
    settings = TopicSettings(topics=2, iterations=5, optimizer=optimizer)
    stage = count_vector_stage(tokens, settings, "id")
    model = fit_topics(stage, settings)
    scored = model.distribution(stage.vectors)
    totals = {r.id: r.t for r in scored.select("id", vector_total("topicDistribution").alias("t")).collect()}
    assert totals[1] == pytest.approx(1) and totals[2] == pytest.approx(1) and totals[3] == totals[4] == 0
    assert documents_with_topic(scored).count() == 2
    bounds = model.bounds(stage.vectors).first()
    assert bounds.counted_words == 6
    if optimizer == "online":
        assert bounds.log_likelihood < 0
        assert bounds.log_perplexity == pytest.approx(model.model.logPerplexity(stage.vectors))
    assert model.words().groupBy("topic").count().count() == 2
    assert {"a", "b"} <= {r.word for r in model.words(3).collect()} <= {"a", "b", "c"}
    assert model.matrix().count() == 6
    stage.release()


def test_same_seed_same_topics(tokens):
    def terms():
        stage = count_vector_stage(tokens, SETTINGS, "id")
        found = [tuple(r) for r in fit_topics(stage, SETTINGS).words(3).orderBy("topic", "rank").collect()]
        stage.release()
        return found

    assert terms() == terms()


def test_sweep_over_topics(tokens):
    from pyspark.ml.clustering import LDA

    stage = count_vector_stage(tokens, SETTINGS, "id")
    held_out = stage.vectors.where("id = 2")
    found = config_sweep(
        stage.vectors, LDA(maxIter=3, seed=1), [{"k": 2}, {"k": 3}], lambda m: m.logPerplexity(held_out), "k int"
    )
    assert sorted(r.k for r in found.collect()) == [2, 3]
    assert all(r.measure > 0 for r in found.collect())
    stage.release()


def test_word_vectors(spark):
    df = spark.createDataFrame([(["china", "russia", "korea"] * 4,), (["rare", "china"],)] * 3, "tokens array<string>")
    model = fit_word_vectors(df, size=8, min_count=5, partitions=2)
    assert {r.word for r in model.getVectors().collect()} == {"china", "russia", "korea"}
    assert [r.word for r in word_vector(model, "china").collect()] == ["china"]
    assert {r.word for r in synonyms(model, "china", 2).collect()} == {"russia", "korea"}


def test_word_vectors_repeat_in_one_partition(spark):
    # Over several tasks the order in which shuffled rows arrive is not fixed.
    df = spark.createDataFrame([(["a"] * 9 + ["b"] * 7 + ["c"] * 5,)] * 3, "tokens array<string>").coalesce(1)

    def near():
        model = fit_word_vectors(df, size=8, min_count=5, partitions=1)
        return [tuple(r) for r in synonyms(model, "a", 2).collect()]

    assert near() == near()


HEADLINES = [
    (20030219, "cats cats cats chasing cat toys"),
    (20030220, "rain rain rain rains in the town"),
    (20030221, "quiet day"),
]


def test_staged_run_and_resume(spark, tmp_path):
    df = spark.createDataFrame(HEADLINES, "publish_date int, headline_text string")
    store = VersionStore(spark, f"{tmp_path}/store")
    with pytest.raises(jobs.StageError):
        jobs.cv1(store, SETTINGS)
    run = jobs.raw0(store, df, key="publish_date", text="headline_text", run_id="20230101T000000Z", keep_steps=True)
    assert {"document", "token", "normalized", "cleanTokens", "stem", "tokens"} <= set(store.restore("stage0").columns)
    with pytest.raises(jobs.StageError):
        jobs.lda2(store)
    # A new store object knows the run only from the files.
    store = VersionStore(spark, f"{tmp_path}/store")
    assert jobs.cv1(store, SETTINGS) == run
    assert jobs.lda2(store) == run
    model, scored = jobs.restore_topics(store)
    assert documents_with_topic(scored).count() == 2
    assert model.settings == SETTINGS and "cat" in model.vocabulary
    assert store.details("transformed")["log_likelihood"] < 0
    assert model.words().count() == 4


def test_staged_run_without_hits(spark, tmp_path):
    df = spark.createDataFrame(HEADLINES[2:], "publish_date int, headline_text string")
    store = VersionStore(spark, f"{tmp_path}/store")
    rows = jobs.run_all(store, df, SETTINGS, key="publish_date", text="headline_text").collect()
    assert [(r.stage, r.row_count, r.hits) for r in rows] == [("stage0", 1, None)]
    assert store.entry("stage1") is None


def test_all_documents_by_default(spark):
    df = spark.range(10_500).selectExpr("id", "array('cat', 'cat', 'cat', 'dog') AS tokens")
    stage = count_vector_stage(df, TopicSettings(), "id")
    assert stage.vectors.count() == 10_500
    stage.release()


def test_words_are_counted_before_they_are_stemmed(spark):
    from quillframe.plans.topics import stem_vocabulary, vocabulary

    df = spark.createDataFrame([("cats running cat run",), ("dogs runs cat",)], "text string")
    once = stem_vocabulary(annotate(df, "text", stems=False), 3)
    assert once.collect() == vocabulary(annotate(df, "text"), 3).collect()
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan[plan.index("Generate") :]


def test_job_line(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("publish_date,headline_text\n" + "\n".join(f"{d},{t}" for d, t in HEADLINES))
    base = ["--store", f"{tmp_path}/store"]
    jobs.main(["raw0", *base, "--input", f"{tmp_path}/in.csv"])
    jobs.main(["count-vectors", *base])
    jobs.main(["LDA2", *base, "--topics", "2", "--iterations", "3"])
    jobs.main(["dbclean", *base])
    store = VersionStore(spark, f"{tmp_path}/store")
    assert store.entry("transformed").row_count == 3
    # What is not given is kept from the run; a named run is gone on with.
    run = "20230101T000000Z"
    jobs.main(["raw0", *base, "--input", f"{tmp_path}/in.csv", "--schema", "publish_date INT, headline_text STRING", "--run-id", run])
    jobs.main(["raw0", *base, "--input", f"{tmp_path}/in.csv"])
    jobs.main(["cv1", *base, "--run-id", run, "--topics", "2", "--iterations", "3", "--seed", "9"])
    jobs.main(["lda2", *base, "--run-id", run, "--terms", "4"])
    settings = store.details("transformed", run)["settings"]
    assert (settings["topics"], settings["iterations"], settings["seed"], settings["terms"]) == (2, 3, 9, 4)
    assert capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.main(["unknown", *base])


def _themes():
    rng = random.Random(3)
    themes = [[f"{t}{i}" for i in range(12)] for t in "abcde"]
    return [([rng.choice(theme) if rng.random() < 0.8 else f"z{rng.randrange(30)}" for _ in range(rng.randint(0, 40))],) for theme in themes for _ in range(300)]


def test_word_vectors_in_blocks(spark, monkeypatch):
    # No task holds all words, and the same partitions give the same vectors; Spark's own fit does neither.
    monkeypatch.setattr(word_vectors, "BLOCK_WORDS", 40)
    monkeypatch.setattr(word_vectors, "COUNTED_WORDS", 1000)
    rows = _themes() + [(None,), ([],), (["a0", None, "b1"],), (["rare", "a1"],)]
    df = spark.createDataFrame(rows, "tokens array<string>").repartition(3)
    df.write.parquet(path := f"{shared_dir(spark)}/themes-{uuid.uuid4().hex}")
    df = spark.read.parquet(path)
    model = fit_word_vectors(df, size=16, iterations=3)
    found = {r.word: r.vector.toArray().tolist() for r in model.getVectors().collect()}
    assert len(found) == model.getVectors().count() == 90 and "rare" not in found
    again = fit_word_vectors(df, size=16, iterations=3)
    assert {r.word: r.vector.toArray().tolist() for r in again.getVectors().collect()} == found
    near = [r.word for word in ("a3", "d1") for r in synonyms(model, word, 6).collect()]
    assert sum(w[0] == t for w, t in zip(near, "a" * 6 + "d" * 6)) >= 10


def test_every_block_is_in_one_cell_a_round():
    for blocks in (1, 2, 5, 8):
        met = set()
        for turn in range(word_vectors._rounds(blocks)):
            cells = word_vectors._cells(blocks, turn)
            for cell in set(cells):
                members = [b for b in range(blocks) if cells[b] == cell]
                assert len(members) <= 2
                if word_vectors._round_of(members[0], members[-1], blocks) == turn:
                    met.add((members[0], members[-1]))
        assert met == {(i, j) for i in range(blocks) for j in range(i, blocks)}


def test_pairs_are_weighed_by_distance(spark):
    texts = spark.createDataFrame([(["a", "x", "b", "a"],)], "tokens array<string>")
    places = spark.createDataFrame([("a", 0, 0), ("b", 0, 1)], "word string, block int, at int")
    rows = spark.read.parquet(word_vectors._stored_pairs(texts, places, 1, 2)).collect()
    # Without x, b stands beside the first a, and both a are two words apart.
    assert [(list(r.l), list(r.r), list(r.w)) for r in rows] == [([0, 0], [0, 1], [1, 4])]
