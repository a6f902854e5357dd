"""Topic model and word vectors.

The fits are random, so the SQL gives what any right fit must show: which
documents get a topic, sums, sizes and the looked-up words.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.arrays import vector_total
from ..functions.text import tokenize
from ..operators.partitions import explode_once, spread
from ..operators.udf import config_sweep
from ..plans import jobs
from ..plans.topics import TopicSettings, count_vector_stage, fit_topics
from ..plans.versions import VersionStore
from ..plans.word_vectors import fit_word_vectors, synonyms
from ..session import fresh_path, stored
from .registry import query, table
from .text import WORDS_SQL, words_of

SETTINGS = TopicSettings()


@contextmanager
def _topics(spark, sf):
    stage = count_vector_stage(words_of(spark, sf), SETTINGS, "doc_id")
    if stage is None:
        raise ValueError("no document has a vocabulary word often enough")
    try:
        yield stage, fit_topics(stage, SETTINGS)
    finally:
        stage.release()


@query(
    "topic_hits",
    WORDS_SQL + "SELECT count(DISTINCT doc_id) AS hits, (SELECT count(*) FROM documents) AS documents FROM vectors",
)
def topic_hits(spark, sf):
    with _topics(spark, sf) as (stage, model):
        scored = model.distribution(stage.vectors)
        hit = vector_total("topicDistribution") > 0
        return stored(scored.agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("documents")), "hits")


@query(
    "topic_bounds",
    WORDS_SQL
    + """
    SELECT sum(value) AS counted_words, sum(value) AS words_by_perplexity, sum(value) > 0 AS negative FROM vectors
    """,
)
def topic_bounds(spark, sf):
    # Spark's own perplexity is the likelihood per word, so it gives back the word count.
    with _topics(spark, sf) as (stage, model):
        per_word = model.model.logPerplexity(stage.vectors)
        return model.bounds(stage.vectors).select(
            "counted_words",
            F.round(-F.col("log_likelihood") / per_word).alias("words_by_perplexity"),
            (F.col("log_likelihood") < 0).alias("negative"),
        )


@query(
    "topic_terms",
    WORDS_SQL
    + """
    SELECT CAST(topic AS INTEGER) AS topic, CAST(least(5, n) AS INTEGER) AS n_terms, CAST(least(5, n) AS INTEGER) AS n_known
    FROM (SELECT unnest(range(5)) AS topic), (SELECT count(*) AS n FROM vocab)
    """,
)
def topic_terms(spark, sf):
    with _topics(spark, sf) as (stage, model):
        known = F.filter("termIndices", lambda i: (i >= 0) & (i < len(stage.vocabulary)))
        return model.terms().select(
            "topic", F.size("termIndices").alias("n_terms"), F.size(F.array_distinct(known)).alias("n_known")
        )


@query(
    "topic_words",
    WORDS_SQL + "SELECT CAST(topic AS INTEGER) AS topic, index AS term, stem AS word FROM vocab, (SELECT unnest(range(5)) AS topic)",
)
def topic_words(spark, sf):
    with _topics(spark, sf) as (stage, model):
        return model.words(len(stage.vocabulary)).select("topic", "term", "word")


@query(
    "topic_distribution",
    WORDS_SQL
    + """
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM vectors) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS total FROM documents
    """,
)
def topic_distribution(spark, sf):
    with _topics(spark, sf) as (stage, model):
        scored = model.distribution(stage.vectors)
        return stored(scored.select("doc_id", F.round(vector_total("topicDistribution"), 6).alias("total")), "scored")


@query(
    "topics_matrix",
    WORDS_SQL
    + """
    SELECT CAST(topic AS INTEGER) AS topic, count(*) AS n_words, count(DISTINCT stem) AS n_agree, 1.0::DOUBLE AS share
    FROM vocab, (SELECT unnest(range(5)) AS topic) GROUP BY topic
    """,
)
def topics_matrix(spark, sf):
    # The weights are the fitted matrix divided by its topic's sum; here the matrix is read beside them.
    with _topics(spark, sf) as (stage, model):
        fitted = model.model.topicsMatrix().toArray()
        shares = (fitted / fitted.sum(axis=0)).T.tolist()
        rows = spark.createDataFrame(list(enumerate(shares)), "topic int, shares array<double>")
        both = model.matrix().join(rows, "topic")
        agree = F.abs(F.col("weight") - F.element_at("shares", F.col("term") + 1)) < 1e-9
        return both.groupBy("topic").agg(
            F.count(F.lit(1)).alias("n_words"), F.count_if(agree).alias("n_agree"), F.round(F.sum("weight"), 6).alias("share")
        )


@query(
    "staged_topic_run",
    WORDS_SQL
    + """
    SELECT stage, n AS row_count, CASE WHEN stage = 'transformed' THEN (SELECT count(DISTINCT doc_id) FROM vectors) END AS hits
    FROM (SELECT count(*) AS n FROM documents), (SELECT unnest(['stage0', 'stage1', 'transformed']) AS stage)
    """,
)
def staged_topic_run(spark, sf):
    store = VersionStore(spark, fresh_path(spark, "runs"))
    return jobs.run_all(store, table(spark, sf, "documents"), SETTINGS, key="doc_id", text="text")


@query(
    "topic_sweep",
    WORDS_SQL
    + """
    SELECT CAST(k AS INTEGER) AS k, sum(value) FILTER (WHERE doc_id % 5 <> 0) AS fitted_words,
           sum(value) FILTER (WHERE doc_id % 5 = 0) AS held_out_words, TRUE AS positive
    FROM vectors, (SELECT unnest([2, 5, 10]) AS k) GROUP BY k
    """,
)
def topic_sweep(spark, sf):
    # Perplexity of a fifth of the documents under models of the others.
    stage = count_vector_stage(words_of(spark, sf), SETTINGS, "doc_id")
    held_out, fitted = stage.vectors.where("doc_id % 5 = 0"), stage.vectors.where("doc_id % 5 <> 0")
    words = [df.agg(F.sum(vector_total("features"))).first()[0] for df in (fitted, held_out)]
    estimator = LDA(maxIter=SETTINGS.iterations, seed=SETTINGS.seed, subsamplingRate=1.0)
    found = config_sweep(fitted.select("features"), estimator, [{"k": k} for k in (2, 5, 10)], lambda m: m.logPerplexity(held_out), "k int", level=StorageLevel.DISK_ONLY)
    stage.release()
    return found.select("k", F.lit(words[0]).alias("fitted_words"), F.lit(words[1]).alias("held_out_words"), (F.col("measure") > 0).alias("positive"))


def _plain_words(spark, sf):
    words = spread(table(spark, sf, "documents").select("text")).select(tokenize("text").alias("tokens"))
    return stored(words, "plain-words")


_FREQUENT_SQL = r"""
WITH words AS (
    SELECT word, count(*) AS n
    FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda w: w <> '')) AS word FROM documents)
    GROUP BY word HAVING count(*) >= 5
)
"""


@query("word_vectors", _FREQUENT_SQL + "SELECT word, 100 AS n_dimensions FROM words")
def word_vectors(spark, sf):
    model = fit_word_vectors(_plain_words(spark, sf))
    return model.getVectors().select("word", F.size(vector_to_array("vector")).alias("n_dimensions"))


@query(
    "synonyms",
    _FREQUENT_SQL
    + """
    SELECT (SELECT word FROM words ORDER BY n DESC, word LIMIT 1) AS target,
           least(40, count(*) - 1) AS n, least(40, count(*) - 1) AS n_known, least(40, count(*) - 1) AS n_in_bounds
    FROM words
    """,
)
def synonyms_query(spark, sf):
    tokens = _plain_words(spark, sf)
    counts = explode_once(tokens, "tokens", "word").groupBy("word").count()
    target = counts.orderBy(F.desc("count"), "word").first()["word"]
    model = fit_word_vectors(tokens)
    near = synonyms(model, target, 40).where(F.col("word") != target)
    known = near.join(model.getVectors().select("word"), "word")
    return known.agg(
        F.lit(target).alias("target"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("word").alias("n_known"),
        F.count_if(F.abs("similarity") <= 1.000001).alias("n_in_bounds"),
    )
