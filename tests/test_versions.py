"""Stored versions and clean-up of old tables."""

import pytest

from quillframe.plans.versions import (
    VersionStore,
    catalog_names,
    catalogs,
    databases,
    latest_versions,
    orphan_tables,
    sweep_orphans,
    table_exists,
)
from quillframe.plans.jobs import dbclean
from quillframe.session import fresh_name
from quillframe.sinks.tables import create_table_as


def test_first_run_has_no_version(spark, tmp_path):
    store = VersionStore(spark, f"{tmp_path}/none")
    assert store.manifest().count() == 0 and store.entry("s") is None and store.latest_run() is None
    with pytest.raises(LookupError):
        store.restore("s")


def test_versions(spark, tmp_path):
    store = VersionStore(spark, f"{tmp_path}/store")
    store.archive(spark.range(3), "s", "20230101T000000Z", note="first")
    store.archive(spark.range(5), "s", "20230201T000000Z")
    store.archive(spark.range(7), "other", "20230301T000000Z")
    assert store.restore("s").count() == 5
    assert store.restore("s", "20230101T000000Z").count() == 3
    assert store.details("s", "20230101T000000Z") == {"note": "first"}
    assert store.entry("s").row_count == 5
    store.current("s", "s_now")
    assert spark.sql("SELECT count(*) FROM s_now").first()[0] == 5
    with pytest.raises(LookupError):
        store.restore("s", "20990101T000000Z")


def test_failed_write_is_not_current(spark, tmp_path):
    store = VersionStore(spark, f"{tmp_path}/store")
    store.archive(spark.range(3), "s", "20230101T000000Z")
    with pytest.raises(Exception):
        store.archive(spark.range(3).selectExpr("raise_error('stop') AS id"), "s", "20230201T000000Z")
    assert store.entry("s").run_id == "20230101T000000Z"


def test_failed_rewrite_keeps_the_old_version(spark, tmp_path):
    store = VersionStore(spark, f"{tmp_path}/store")
    tag = "20230101T000000Z"
    store.archive(spark.range(3), "s", tag)
    with pytest.raises(Exception):
        store.archive(spark.range(3).selectExpr("raise_error('stop') AS id"), "s", tag)
    assert store.restore("s", tag).count() == 3
    store.archive(spark.range(5), "s", tag)
    paths = [r.path for r in store.manifest().collect()]
    assert sorted(spark.read.parquet(p).count() for p in paths) == [3, 5] and store.restore("s", tag).count() == 5
    left = store.leftovers()
    assert len(left) == 1 and left[0] in dbclean(spark, store)
    assert left[0] in dbclean(spark, store, "delete") and store.leftovers() == []
    assert store.restore("s", tag).count() == 5
    with pytest.raises(LookupError):
        VersionStore(spark, f"{tmp_path}/none").leftovers()


def test_orphans(spark):
    names = spark.createDataFrame(
        [("stage0_20230101t000000z",), ("stage1_20230101t000000z",), ("stage0_20230201t000000z",), ("my_table",), ("plain",)], "name string"
    )
    runs = spark.createDataFrame([("20230201T000000Z",), ("not a tag",), (None,)], "run_id string")
    assert sorted(r.name for r in orphan_tables(names, runs).collect()) == ["stage0_20230101t000000z", "stage1_20230101t000000z"]
    assert orphan_tables(names.where("name = 'my_table'"), runs).count() == 0
    assert latest_versions(names, prefix="stage0").first().tag == "20230201T000000Z"
    assert latest_versions(names, prefix="nothing").first().tag is None


def test_sweep(spark, tmp_path):
    base = fresh_name("swept")
    for tag in ("20230101T000000Z", "20230201T000000Z"):
        create_table_as(spark.range(1), f"{base}_{tag}")
    store = VersionStore(spark, f"{tmp_path}/store")
    store.archive(spark.range(1), "s", "20230201T000000Z")
    old, new = f"{base}_20230101t000000z", f"{base}_20230201t000000z"
    assert old in dbclean(spark, store) and table_exists(spark, old)
    assert old in dbclean(spark, store, "Delete") and not table_exists(spark, old)
    assert table_exists(spark, new)
    left = {r.name for r in catalog_names(spark).collect()}
    assert new in left and old not in left
    assert sweep_orphans(spark, store.manifest()) == []


def test_listings(spark):
    assert "default" in {r[0] for r in databases(spark).collect()}
    assert "spark_catalog" in {r[0] for r in catalogs(spark).collect()}
