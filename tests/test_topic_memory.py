"""What the count vector stage holds while it runs and for the passes to come."""

import tempfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.ml.clustering import LDA
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from quillframe import session
from quillframe.operators.udf import config_sweep
from quillframe.plans.topics import TopicSettings, count_vector_stage, fit_topics
from quillframe.session import small_batches


@pytest.fixture
def tokens(spark):
    return spark.range(300).select(F.col("id"), F.array_repeat(F.concat(F.lit("w"), F.col("id") % 7), 5).alias("tokens"))


def held(spark):
    return [(i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()]


def test_vectors_are_kept_on_disk_without_the_tokens(spark, tokens):
    before = len(held(spark))
    stage = count_vector_stage(tokens, TopicSettings(iterations=2), "id")
    assert stage.vectors.columns == ["id", "features"] and stage.counted.columns == ["id", "tokens", "features"]
    assert stage.vectors.storageLevel.useDisk and not stage.vectors.storageLevel.useMemory
    assert stage.vectors.count() == 300 and sorted(stage.counted.drop("tokens").collect()) == sorted(stage.vectors.collect())
    now = held(spark)[before:]
    assert now and all(memory == 0 for memory, _ in now) and sum(disk for _, disk in now) > 0
    assert fit_topics(stage, TopicSettings(iterations=2)).distribution(stage.vectors).count() == 300
    levels = []

    def measure(model):
        levels.extend(held(spark)[before:])
        return 1.0

    from pyspark import StorageLevel

    config_sweep(stage.vectors.select("features"), LDA(maxIter=1, seed=1), [{"k": 2}], measure, "k int", level=StorageLevel.DISK_ONLY)
    assert levels and all(memory == 0 for memory, _ in levels)
    stage.release()


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(session, "BATCH_BYTES", 1 << 16)
    folder = tempfile.mkdtemp()

    @F.arrow_udf(ArrayType(StringType()))
    def seen(words: pa.Array) -> pa.Array:
        Path(tempfile.mktemp(dir=folder)).write_text(str(words.nbytes))
        return words

    texts = spark.range(0, 2000, numPartitions=2).select("id", seen(F.array_repeat(F.lit("word"), 500)).alias("tokens"))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    stage = count_vector_stage(texts, TopicSettings(), "id")
    assert stage.vectors.count() == 2000
    stage.release()
    sizes = [int(p.read_text()) for p in Path(folder).iterdir()]
    assert sizes and max(sizes) < 1 << 18
    assert spark.conf.get(name) == before
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert spark.conf.get(name) == before
