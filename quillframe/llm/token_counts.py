"""Token counts through a cache keyed by content and tokenizer digests.

The cache is a Parquet folder of (content_digest, tokenizer_digest, n_tokens).
A call digests every text, joins the digests to the cache, encodes each missing
text once however many rows carry it, appends the new counts and joins them back.
Nothing in the cache is ever changed, so a job that fails half-way leaves either
the old cache or the old cache with complete new files; a text counted twice by
two jobs at once has the same count twice and is read once.

Null texts count as empty. Columns that clash with the results are replaced.
Rows are kept as they are: repeated rows stay, a null id stays null.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import arrow_bounded, renamed, slices

CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens bigint"

#: The split pattern of the byte-level vocabularies, in a form with possessive runs.
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Letters, digits and blanks below this code point are classed alike by every Unicode version in use.
STABLE_BELOW = 0x250


@functools.lru_cache(maxsize=4)
def _counter(path: str, ranks: str | None):
    """A function from a list of texts to their counts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    import tokenizers

    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def count(texts):
        return [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    if ranks is None:
        return count
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=table, special_tokens={})
    unusual = re.compile(
        "|".join([f"[^\\x00-{chr(STABLE_BELOW - 1)}]", *(re.escape(t.content) for t in library.get_added_tokens_decoder().values())])
    )

    def count_mixed(texts):
        out = [None if unusual.search(t) else len(fast.encode_ordinary(t)) for t in texts]
        rest = iter(count([t for t, n in zip(texts, out) if n is None]))
        return [next(rest) if n is None else n for n in out]

    return count_mixed


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + version.encode()).hexdigest()


def read_cache(spark, path: str) -> DataFrame:
    """The cache, empty if the folder does not exist yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(df: DataFrame, cache: str, tokenizer: str, ranks: str | None = None, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` to every row.

    ``tokenizer`` is a path every executor has. ``ranks`` may name the same
    vocabulary as byte ranks: texts of long-established characters without
    special strings are then counted from the ranks, which is several times
    faster and gives the same counts; all other texts go to the library.
    """
    spark = df.sparkSession
    arrow_bounded(spark)
    kind = tokenizer_digest(tokenizer)
    full = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    known = read_cache(spark, cache).where(F.col("tokenizer_digest") == kind).select("content_digest")
    texts = df.select(F.sha2(full, 256).alias("content_digest"), full.alias("text"))
    # Copies meet inside each task first, so a text shared by a third of the rows moves once per task.
    misses = texts.join(known, "content_digest", "left_anti").groupBy("content_digest").agg(F.first("text").alias("text"))

    def encode(batches):
        count = _counter(tokenizer, ranks)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("content_digest"), pa.array([kind] * part.num_rows), pa.array(count(part.column("text").to_pylist()), pa.int64())],
                    ["content_digest", "tokenizer_digest", "n_tokens"],
                )

    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("tokenizer_digest") == kind).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    # Written first, so that the join reads plain tables and the rows of a hot text can be split.
    counts = stored(counts, "token-counts")
    rows = df.withColumns({"content_digest": F.sha2(full, 256), "n_bytes": F.octet_length(full).cast("bigint")})
    return renamed(rows, ["n_tokens"]).join(counts, "content_digest", "left")
