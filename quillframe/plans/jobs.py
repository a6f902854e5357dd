"""Topic jobs by name: raw0, cv1, lda2 and dbclean.

Each job needs the one before it: the newest run in the store must have
reached that stage. ``python -m quillframe.plans.jobs <job> [options]`` runs one.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import asdict, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import new_tag
from ..operators.partitions import spread
from ..sources.files import read_csv
from .topics import (
    CountStage,
    TopicModel,
    TopicSettings,
    annotate,
    count_vector_stage,
    documents_with_topic,
    fit_topics,
    load_model,
)
from .versions import VersionStore, sweep_orphans

RAW, COUNTED, SCORED = "stage0", "stage1", "transformed"


class StageError(RuntimeError):
    """A job was asked for before the stage it builds on."""


def _require(store: VersionStore, stage: str, run_id: str | None):
    found = store.entry(stage, run_id) if run_id else store.latest_run()
    if found is None or found.stage != stage:
        have = found.stage if found else "nothing"
        raise StageError(f"needs a run that stands at {stage}, found {have}")
    return found


def raw0(
    store: VersionStore,
    df: DataFrame,
    *,
    key: str,
    text: str,
    run_id: str | None = None,
    keep_steps: bool = False,
) -> str:
    """Text to words. ``keep_steps`` also stores the column of every text step."""
    done = annotate(spread(df), text)
    kept = done if keep_steps else done.select(key, "tokens")
    return store.archive(kept, RAW, run_id or new_tag(), key=key, text=text)


def cv1(store: VersionStore, settings: TopicSettings, *, run_id: str | None = None) -> str | None:
    """Words to count vectors; None, and nothing stored, if all vectors are empty."""
    found = _require(store, RAW, run_id)
    key = store.details(RAW, found.run_id)["key"]
    words = store.restore(RAW, found.run_id)
    stage = count_vector_stage(words, settings, key, store_tokens=False)
    if stage is None:
        return None
    try:
        return store.archive(
            stage.counted,
            COUNTED,
            found.run_id,
            key=key,
            vocabulary=stage.vocabulary,
            row_maxima=stage.row_maxima,
            settings=asdict(settings),
        )
    finally:
        stage.release()


def lda2(store: VersionStore, settings: TopicSettings | None = None, *, run_id: str | None = None) -> str:
    """Count vectors to topics: stores the model, its bounds and the scored documents."""
    found = _require(store, COUNTED, run_id)
    details = store.details(COUNTED, found.run_id)
    settings = settings or TopicSettings(**details["settings"])
    rows = store.restore(COUNTED, found.run_id)
    # The passes of the fit need the vectors only.
    vectors = rows.select("features").persist(StorageLevel.DISK_ONLY)
    try:
        fitted = fit_topics(CountStage(vectors, details["vocabulary"], details["row_maxima"]), settings)
        path = store.attempt("model", found.run_id)
        fitted.model.write().save(path)
        likelihood, perplexity, counted = fitted.bounds(vectors).first()
        return store.archive(
            fitted.distribution(rows),
            SCORED,
            found.run_id,
            key=details["key"],
            vocabulary=details["vocabulary"],
            settings=asdict(settings),
            model=path,
            log_likelihood=likelihood,
            log_perplexity=perplexity,
            counted_words=counted,
        )
    finally:
        vectors.unpersist()


def restore_topics(store: VersionStore, run_id: str | None = None) -> tuple[TopicModel, DataFrame]:
    """Model and scored documents of a finished run, by default the newest."""
    details = store.details(SCORED, run_id)
    if not details:
        raise LookupError("no finished topic run")
    settings = TopicSettings(**details["settings"])
    model = TopicModel(load_model(details["model"], settings.optimizer), details["vocabulary"], settings)
    return model, store.restore(SCORED, run_id)


def run_all(
    store: VersionStore, df: DataFrame, settings: TopicSettings, *, key: str, text: str, run_id: str | None = None
) -> DataFrame:
    """All jobs in turn; one row per stored stage with its rows and topic hits."""
    run_id = raw0(store, df, key=key, text=text, run_id=run_id)
    if cv1(store, settings, run_id=run_id) is not None:
        lda2(store, run_id=run_id)
    stages = store.manifest().where(F.col("run_id") == run_id).select("stage", "row_count")
    if store.entry(SCORED, run_id) is None:
        return stages.withColumn("hits", F.lit(None).cast("bigint"))
    hits = documents_with_topic(store.restore(SCORED, run_id)).count()
    return stages.withColumn("hits", F.when(F.col("stage") == SCORED, F.lit(hits).cast("bigint")))


def dbclean(spark: SparkSession, store: VersionStore, word: str = "") -> list[str]:
    """Name the version tables no run knows and the folders of failed attempts; remove them when ``word`` is delete.

    A store without a manifest has no run to compare with, so there only tables are looked at.
    """
    dry_run = word.lower() != "delete"
    tables = sweep_orphans(spark, store.manifest(), dry_run=dry_run)
    return tables + (store.sweep(dry_run=dry_run) if store.latest_run() else [])


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillframe")
    parser.add_argument("job", type=str.lower, choices=["raw0", "stage0", "cv1", "count-vectors", "lda2", "dbclean"])
    parser.add_argument("word", nargs="?", default="", help="'delete' lets dbclean drop tables")
    parser.add_argument("--store", required=True, help="folder of the stage tables")
    parser.add_argument("--input", help="delimited text file with a header")
    parser.add_argument("--key", default="publish_date")
    parser.add_argument("--text", default="headline_text")
    parser.add_argument("--schema", help="columns of the input; without it the key is an integer and all else text")
    parser.add_argument("--run-id", help="the run to go on with, by default the newest; for raw0 the new run's name")
    # What is not given comes from the run's stored settings, or else from the class.
    kinds = {"vocabulary_size": int, "min_tf": float, "documents": int, "topics": int, "iterations": int, "terms": int, "optimizer": str, "subsampling": float, "seed": int}
    for name, kind in kinds.items():
        parser.add_argument("--" + name.replace("_", "-"), type=kind)
    args = parser.parse_args(argv)
    given = {name: value for name in kinds if (value := getattr(args, name)) is not None}
    spark = SparkSession.builder.appName(f"quillframe {args.job}").getOrCreate()
    store = VersionStore(spark, args.store)
    if args.job in ("raw0", "stage0"):
        if not args.input:
            parser.error("raw0 needs --input")
        lines = read_csv(spark, args.input, schema=args.schema) if args.schema else spark.read.csv(args.input, header=True)
        lines = lines if args.schema else lines.withColumn(args.key, F.col(args.key).cast("bigint"))
        print(raw0(store, lines, key=args.key, text=args.text, run_id=args.run_id))
    elif args.job in ("cv1", "count-vectors"):
        print(cv1(store, TopicSettings(**given), run_id=args.run_id) or "all vectors are empty")
    elif args.job == "lda2":
        newest = store.details(COUNTED, args.run_id)
        base = TopicSettings(**newest["settings"]) if newest else TopicSettings()
        print(lda2(store, replace(base, **given), run_id=args.run_id))
    else:
        print("\n".join(dbclean(spark, store, args.word)))


if __name__ == "__main__":
    main()
