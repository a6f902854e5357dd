"""Concurrent fits, and versions stored as differences."""

import time

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from quillframe.operators.sweep import concurrent_sweep
from quillframe.plans.deltas import DeltaStore
from quillframe.plans.versions import VersionStore


def test_concurrent_fits_are_the_same(spark):
    rows = spark.range(3000).select(array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double"))).alias("features"), F.sqrt("id").alias("label"))
    configs = [{"regParam": r, "elasticNetParam": e} for r in (0.0, 0.1, 1.0) for e in (0.0, 0.5)]
    got = []
    for workers in (1, 4):
        start = time.perf_counter()
        found = concurrent_sweep(rows, LinearRegression(), configs, lambda m: m.summary.rootMeanSquaredError, "regParam double, elasticNetParam double", workers=workers)
        got.append(found.collect())
        print(f"{workers} at a time: {time.perf_counter() - start:.1f} s")
    one, many = got
    assert [(r.regParam, r.elasticNetParam) for r in many] == [(c["regParam"], c["elasticNetParam"]) for c in configs]
    assert [r.measure for r in many] == pytest.approx([r.measure for r in one]) and not any(r.error for r in many)


def test_failed_fits_are_named(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "x double").select(array_to_vector(F.array("x")).alias("features"))

    def measure(model):
        if model.getK() == 3:
            raise RuntimeError("no measure")
        return 1.0

    got = concurrent_sweep(rows, KMeans(seed=1), [{"k": 2}, {"k": 3}, {"k": 2}], measure, "k int", workers=2).collect()
    assert [r.measure for r in got] == [1.0, None, 1.0] and "RuntimeError: no measure" in got[1].error
    with pytest.raises(ValueError):
        concurrent_sweep(rows, KMeans(), [{"seed": 1}], measure, "k int")


def content(df):
    return sorted(map(repr, df.collect()))


def test_every_version_is_restored(spark, tmp_path):
    store, full = DeltaStore(spark, f"{tmp_path}/d", compact_after=3), VersionStore(spark, f"{tmp_path}/f")
    kind = "id bigint, text string, tags array<string>"
    base = [(i, f"t{i}", ["x", None]) for i in range(50)] + [(1, None, None)] * 3 + [(None, "", [])]
    versions = [
        base,
        base,  # nothing changed
        base[5:] + [(99, "new", None)] * 2,
        base[5:] + [(99, "new", None)] + base[:1] + [(1, None, None)],  # copies go, rows come back
        [],
        base[:3],
        base[:3] + [(None, None, None)],
    ]
    for n, rows in enumerate(versions):
        frame = spark.createDataFrame(rows, kind)
        assert store.archive(frame, "s", f"r{n}") == full.archive(frame, "s", f"r{n}")
    for n, rows in enumerate(versions):
        assert content(store.restore("s", f"r{n}")) == content(full.restore("s", f"r{n}")), n
        assert store.entry("s", f"r{n}").row_count == len(rows)
    assert content(store.restore("s")) == content(full.restore("s"))
    assert [len(store.chain("s", f"r{n}")) for n in range(7)] == [1, 2, 3, 4, 1, 2, 3]
    # Unchanged rows are not written again.
    assert spark.read.parquet(f"{store.entry('s', 'r1').path}/added").count() == 0
    assert spark.read.parquet(f"{store.entry('s', 'r2').path}/added").count() == 1
    # Other columns make a full copy.
    store.archive(spark.createDataFrame([(1,)], "id bigint"), "s", "r7")
    assert len(store.chain("s")) == 1 and store.leftovers() == []
    with pytest.raises(LookupError):
        store.restore("s", "missing")


def test_a_crash_before_the_manifest_loses_nothing(spark, tmp_path, monkeypatch):
    store = DeltaStore(spark, f"{tmp_path}/d")
    store.archive(spark.range(10), "s", "r0")
    store.archive(spark.range(9), "s", "r1")
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.archive(spark.range(5), "s", "r2")
    assert content(store.restore("s")) == content(spark.range(9)) and len(store.leftovers()) == 1
    store.archive(spark.range(5), "s", "r2")
    assert content(store.restore("s")) == content(spark.range(5)) and content(store.restore("s", "r0")) == content(spark.range(10))
