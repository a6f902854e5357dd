"""The corpus pipeline: documents to a tokenized training corpus in five stages.

Every stage is written as Parquet to the shared folder and reread as the next
one's documents. ``documents`` has doc_id, text, lang, source and n_chars; the
first four stages return these columns, the last one the tokens. Other columns
are left out at the first stage.

Nulls, ties and repeated rows, stage by stage: a null text is scored, split and
tokenized as an empty one and kept where the stage keeps an empty text; rows
with a null id are kept or dropped by their own text in every stage, and are no near-duplicate of anything.
Rows that share an id are one document to line dedup and near-duplicate search, and
rows of their own to the other stages. Empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm.bpe_automaton import encode
from quillframe.llm.importance import Resampler
from quillframe.llm.line_runs import dedupe_lines
from quillframe.llm.near_dedup import DedupSettings, near_duplicates
from quillframe.llm.phrase_index import contamination
from quillframe.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = Resampler(docs, labels, (F.col("quality") == 1) & (F.col("toxic") == 0))
    return model.weighed(docs).where(model.kept()).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated long lines; those of which nothing but blanks is left go."""
    rows = dedupe_lines(docs.select(*COLUMNS))
    left = (F.col("n_dropped") == 0) | (F.btrim("text", F.lit(" \t\n\r\x0b\x0c")) != "")
    return rows.where(left).withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 80 % of their five-word shingles in common: the one with the smallest id."""
    found = near_duplicates(docs, settings=DedupSettings(shingle=5, percent=80))
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item.

    Rows are told apart by a number written beside them, never by doc_id: a contaminated
    row takes no row along that has the same id or, like it, none.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")
    found = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row")
    gone = found.where("contaminated").select(F.col("doc_id").alias("_row"))
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the packed ids and the digest of the decoded text."""
    rows = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("near_dedup", near), ("decontamination", clean), ("bpe_encoding", tokens)]

#: No SQL: the stages hash, sample and tokenize. The tests run a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
