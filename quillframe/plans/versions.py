"""Stored stage tables with one version per run, and clean-up of old tables.

Every attempt writes a folder of its own and then one manifest row that names
it. A version exists only once its manifest row does, so a failed write is never
the current one, and no write touches the files of a version that exists.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import is_tag, name_tag, new_tag, number_tag, tag_number

MANIFEST = "run_id string, stage string, path string, row_count bigint, details string, written_at timestamp"


class VersionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def attempt(self, stage: str, run_id: str) -> str:
        """A folder for one attempt to write a version."""
        return f"{self.root}/{stage}/run_id={run_id}/{uuid.uuid4().hex}"

    def leftovers(self) -> list[str]:
        """Folders of attempts that no manifest row names; refused without a manifest."""
        rows = self.manifest().select("path", "details").collect()
        if not rows:
            raise LookupError(f"{self.root} has no manifest, so nothing tells what is left over")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(conf)
        known = {r.path for r in rows} | {json.loads(r.details).get("model") for r in rows}
        known = {files.makeQualified(jvm.org.apache.hadoop.fs.Path(p)).toString() for p in known if p}
        there = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, "*/run_id=*/*")) or []
        found = [s.getPath() for s in there if s.isDirectory() and re.fullmatch("[0-9a-f]{32}", s.getPath().getName())]
        return sorted(p.toString() for p in found if p.toString() not in known)

    def sweep(self, *, dry_run: bool = True) -> list[str]:
        """Name the leftover folders; without ``dry_run`` remove them."""
        found = self.leftovers()
        if not dry_run:
            jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
            for name in found:
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(conf).delete(path, True)
        return found

    def archive(self, df: DataFrame, stage: str, run_id: str | None = None, **details) -> str:
        """Write a frame as the version ``run_id`` of a stage and return the run id."""
        run_id = run_id or new_tag()
        path = self.attempt(stage, run_id)
        df.write.mode("errorifexists").parquet(path)
        row = (
            run_id,
            stage,
            path,
            self.spark.read.parquet(path).count(),  # from the file footers
            json.dumps(details, sort_keys=True),
            dt.datetime.now(dt.timezone.utc),
        )
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(
            f"{self.root}/manifest"
        )
        return run_id

    def entry(self, stage: str, run_id: str | None = None):
        """Newest manifest row of a stage, or of one run of it; None if there is none."""
        rows = self.manifest().where(F.col("stage") == stage)
        if run_id is not None:
            rows = rows.where(F.col("run_id") == run_id)
        return rows.orderBy(F.desc("written_at"), F.desc("run_id")).limit(1).first()

    def latest_run(self):
        """Manifest row written last, whatever its stage."""
        return self.manifest().orderBy(F.desc("written_at"), F.desc("run_id")).limit(1).first()

    def restore(self, stage: str, run_id: str | None = None) -> DataFrame:
        """A named version of a stage, by default the newest."""
        found = self.entry(stage, run_id)
        if found is None:
            raise LookupError(f"no version of {stage}" + (f" from run {run_id}" if run_id else ""))
        return self.spark.read.parquet(found.path)

    def details(self, stage: str, run_id: str | None = None) -> dict:
        found = self.entry(stage, run_id)
        return json.loads(found.details) if found else {}

    def current(self, stage: str, view: str | None = None) -> None:
        """Make the newest version of a stage readable by name in SQL."""
        self.restore(stage).createOrReplaceTempView(view or stage)


def catalog_names(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the tables and views of a database as data."""
    listing = spark.sql("SHOW TABLES" + (f" IN {database}" if database else ""))
    return listing.select(F.col("tableName").alias("name"), F.col("isTemporary").alias("is_temporary"))


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def latest_versions(names: DataFrame, *keys: str, prefix: str | None = None) -> DataFrame:
    """Newest version tag among table names, optionally per key column."""
    if prefix is not None:
        names = names.where(F.col("name").startswith(prefix + "_"))
    # Compared as numbers, because Spark hash-aggregates those and sorts for texts.
    newest = names.groupBy(*keys).agg(F.max(tag_number(name_tag("name"))).alias("newest"))
    return newest.select(*keys, number_tag("newest").alias("tag"))


def orphan_tables(names: DataFrame, runs: DataFrame) -> DataFrame:
    """Names of version tables whose tag belongs to no run in ``runs.run_id``."""
    tagged = names.select("name", name_tag("name").alias("run_id")).where("run_id IS NOT NULL")
    known = runs.select("run_id").where(is_tag("run_id"))
    return tagged.join(known, "run_id", "left_anti").select("name")


def sweep_orphans(spark: SparkSession, runs: DataFrame, *, dry_run: bool = True) -> list[str]:
    """Drop the orphaned version tables of the catalog; a dry run only names them."""
    tables = catalog_names(spark).where(~F.col("is_temporary"))
    orphans = sorted(row.name for row in orphan_tables(tables, runs).toLocalIterator())
    if not dry_run:
        for name in orphans:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    return orphans
