"""From text to topics.

Four steps: text to words, words to count vectors, vectors to topics, topics to
words and scores. Words and vectors are made row by row without a shuffle; the
only shuffle before the fit is the word count, which is combined map-side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as words
from ..functions.arrays import vector_total
from ..operators.partitions import explode_once
from ..operators.relational import limit_rows, sum_of_row_maxima
from ..session import small_batches, stored


@dataclass(frozen=True)
class TopicSettings:
    vocabulary_size: int = 500
    # At least this often in a document; below 1 it is a share of the document's words.
    min_tf: float = 3.0
    # Documents to use, in key order; not positive means all.
    documents: int = 0
    topics: int = 5
    iterations: int = 10
    # Terms to list per topic; by default as many as there are topics.
    terms: int | None = None
    optimizer: str = "online"
    # Share of the documents that an iteration of the online optimizer reads.
    subsampling: float = 1.0
    seed: int = 42

    @property
    def terms_per_topic(self) -> int:
        return self.terms or self.topics


def annotate(
    df: DataFrame, text: str = "headline_text", *, stems: bool = True, token_pattern: str = words.LETTERS
) -> DataFrame:
    """Add a column per text step; ``tokens`` is the final array of words.

    ``token_pattern=NOT_BLANK`` keeps words such as don't in one piece (dont).
    Spark computes only the columns that are used later.
    """
    # Runs of letters have nothing left to take out.
    normalized = F.col("token") if token_pattern == words.LETTERS else words.normalize("token")
    out = (
        df.withColumn("document", words.shrink(text))
        .withColumn("token", words.tokenize(text, token_pattern))
        .withColumn("normalized", normalized)
        .withColumn("cleanTokens", words.remove_stop_words("normalized", lowered=True))
    )
    if stems:
        out = out.withColumn("stem", words.stem_tokens("cleanTokens"))
    return out.withColumn("tokens", F.col("stem" if stems else "cleanTokens"))


def vocabulary(df: DataFrame, size: int, tokens: str = "tokens") -> DataFrame:
    """The ``size`` most frequent words; equal counts go by the word."""
    counts = explode_once(df, tokens, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(size)


def stem_vocabulary(df: DataFrame, size: int, tokens: str = "cleanTokens") -> DataFrame:
    """The ``size`` most frequent stems of unstemmed words.

    Words are counted before they are stemmed, so Python sees each distinct word once.
    """
    counts = explode_once(df, tokens, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    stems = counts.groupBy(words.stem_word("word").alias("word")).agg(F.sum("n").alias("n"))
    return stems.orderBy(F.desc("n"), "word").limit(size)


def count_vectorizer(vocab: list[str], min_tf: float) -> CountVectorizerModel:
    model = CountVectorizerModel.from_vocabulary(vocab, inputCol="tokens", outputCol="features")
    return model.setMinTF(min_tf)


def count_vectors(df: DataFrame, vocab: list[str], min_tf: float) -> DataFrame:
    """Add ``features``; the vocabulary is not affected by ``min_tf``."""
    return count_vectorizer(vocab, min_tf).transform(df)


@dataclass
class CountStage:
    """Count vectors by key, stored for the passes to come, and the words of their entries.

    ``counted`` has the tokens beside them; it is read from where the tokens lie.
    """

    vectors: DataFrame
    vocabulary: list[str]
    row_maxima: float
    counted: DataFrame | None = None

    def release(self) -> None:
        self.vectors.unpersist()


def count_vector_stage(
    df: DataFrame, settings: TopicSettings, key: str, *, store_tokens: bool = True
) -> CountStage | None:
    """Vocabulary and count vectors of the first documents by ``key``.

    ``df`` has ``tokens``; they are read twice, so they are written to the
    shared folder unless they already come from a stored table
    (``store_tokens=False``). Returns None when all vectors are empty.
    The vectors are kept on the executors' disks without the tokens, so no memory fills up with the input.
    """
    chosen = limit_rows(df.select(key, "tokens"), settings.documents, key)
    if store_tokens:
        with small_batches(df.sparkSession):
            chosen = stored(chosen, "tokens")
    vocab = [row.word for row in vocabulary(chosen, settings.vocabulary_size).collect()]
    if not vocab:
        return None
    counted = count_vectors(chosen, vocab, settings.min_tf)
    vectors = counted.select(key, "features").persist(StorageLevel.DISK_ONLY)
    total = sum_of_row_maxima(vectors).first()["total"]
    if total > 0:
        return CountStage(vectors, vocab, total, counted)
    vectors.unpersist()
    return None


@dataclass
class TopicModel:
    model: LDAModel
    vocabulary: list[str]
    settings: TopicSettings = field(default_factory=TopicSettings)

    def bounds(self, vectors: DataFrame) -> DataFrame:
        """Log-likelihood and log-perplexity over ``vectors``.

        The perplexity is minus the likelihood per counted word, so the
        costly likelihood pass runs once.
        """
        counted = vectors.agg(F.coalesce(F.sum(vector_total("features")), F.lit(0.0))).first()[0]
        likelihood = self.model.logLikelihood(vectors)
        perplexity = -likelihood / counted if counted else None
        return vectors.sparkSession.createDataFrame(
            [(likelihood, perplexity, counted)],
            "log_likelihood double, log_perplexity double, counted_words double",
        )

    def terms(self, n: int | None = None) -> DataFrame:
        """Top terms per topic as (topic, termIndices, termWeights)."""
        return self.model.describeTopics(n or self.settings.terms_per_topic)

    def words(self, n: int | None = None) -> DataFrame:
        """Top terms per topic as rows (topic, rank, term, word, score)."""
        exploded = self.terms(n).select(
            "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "pair")
        )
        rows = exploded.select(
            "topic", "rank", F.col("pair.termIndices").alias("term"), F.col("pair.termWeights").alias("score")
        )
        return rows.join(self._words(rows), "term").select("topic", "rank", "term", "word", "score")

    def _words(self, rows: DataFrame) -> DataFrame:
        return rows.sparkSession.createDataFrame(list(enumerate(self.vocabulary)), "term int, word string")

    def matrix(self) -> DataFrame:
        """Every (topic, term, word, weight); the weights of a topic add up to one.

        One row per topic comes from the model and is exploded by the tasks.
        """
        size = len(self.vocabulary)
        weights = F.map_from_arrays("termIndices", "termWeights")
        rows = self.terms(size).select("topic", weights.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("term"))
        # Terms that a topic does not list weigh nothing in it.
        rows = rows.select("topic", "term", F.coalesce(F.try_element_at("w", F.col("term")), F.lit(0.0)).alias("weight"))
        return rows.join(self._words(rows), "term").select("topic", "term", "word", "weight")

    def distribution(self, vectors: DataFrame) -> DataFrame:
        """Add ``topicDistribution``; it is all zero for an empty vector."""
        return self.model.transform(vectors)


def fit_topics(stage: CountStage, settings: TopicSettings) -> TopicModel:
    lda = LDA(
        k=settings.topics,
        maxIter=settings.iterations,
        seed=settings.seed,
        optimizer=settings.optimizer,
        subsamplingRate=settings.subsampling,
        featuresCol="features",
    )
    return TopicModel(lda.fit(stage.vectors), stage.vocabulary, settings)


def documents_with_topic(scored: DataFrame) -> DataFrame:
    """Rows that got a topic: their topic distribution does not sum to zero."""
    return scored.where(vector_total("topicDistribution") > 0)


def load_model(path: str, optimizer: str) -> LDAModel:
    return (LocalLDAModel if optimizer == "online" else DistributedLDAModel).load(path)
