"""Positional inverted index in document shards, and exact phrase and proximity search in it.

A shard holds the documents that one task reads in a row, up to a set number of
text bytes (a longer document is a shard of its own). Its postings are one row
per term: the positions of the term in the shard, where every document starts
one free position after the last, so that no phrase can cross two documents.
Phrases therefore match within a shard and nothing but postings of query terms
moves. Search anchors every phrase window at its rarest term in the shard and
intersects the offset-adjusted lists outwards from there, so a window costs as
much as its rarest word.

Null and empty texts have no words. Ids may repeat or be null: every row is a
document of its own, known by (shard, row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import arrow_bounded

SHARD_BYTES = 16 << 20
#: Queries of one pass; more are searched in blocks of this many bytes.
QUERY_BYTES = 16 << 20

#: Letters and digits of ASCII and every byte of other characters make words; A-Z are lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

DOCS_SCHEMA = "shard bigint, row int, start bigint, n_words bigint, doc_id bigint"
POSTINGS_SCHEMA = "shard bigint, term binary, n bigint, deltas binary"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@dataclass(frozen=True)
class PhraseIndex:
    """The written index: one row per document and one per term and shard."""

    docs: DataFrame
    postings: DataFrame


def _shard(rows: list[tuple[int | None, list[bytes]]], shard: int, terms: frozenset[bytes] | None):
    """(docs batch, postings batch) of one shard."""
    lengths = np.array([len(w) for _, w in rows], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    ids: dict[bytes, int] = {}
    if terms is None:
        flat = np.fromiter((ids.setdefault(w, len(ids)) for _, ws in rows for w in ws), np.int64, int(lengths.sum()))
    else:
        ids = {t: i for i, t in enumerate(sorted(terms))}
        flat = np.fromiter((ids.get(w, -1) for _, ws in rows for w in ws), np.int64, int(lengths.sum()))
    at = np.arange(len(flat)) + np.repeat(np.arange(len(rows)), lengths)
    if terms is not None:
        at, flat = at[flat >= 0], flat[flat >= 0]
    order = np.argsort(flat, kind="stable")
    at, flat = at[order], flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    deltas = np.diff(at, prepend=0)
    deltas[first] = at[first]
    ends = np.concatenate([first, [len(flat)]])
    names = list(ids)
    binary = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), pa.py_buffer(deltas.astype(np.uint32).tobytes())])
    n = len(rows)
    docs = pa.RecordBatch.from_arrays(
        [pa.array([shard] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(starts), pa.array(lengths), pa.array([i for i, _ in rows], pa.int64())],
        ["shard", "row", "start", "n_words", "doc_id"],
    )
    postings = pa.RecordBatch.from_arrays(
        [pa.array([shard] * len(first), pa.int64()), pa.array([names[i] for i in flat[first]], pa.binary()), pa.array(np.diff(ends)), binary],
        ["shard", "term", "n", "deltas"],
    )
    return docs, postings


def build(df: DataFrame, id_col: str = "doc_id", text: str = "text", terms: frozenset[bytes] | None = None, shard_bytes: int = SHARD_BYTES) -> PhraseIndex:
    """Write the index of all documents to the shared folder.

    ``terms`` keeps postings of the stated terms only, for an index that will
    answer a known query set; without it every word is indexed.
    """
    spark = df.sparkSession
    arrow_bounded(spark)
    path = fresh_path(spark, "phrase-index")
    schema = f"{DOCS_SCHEMA}, term binary, n bigint, deltas binary"
    names = [part.split()[0] for part in schema.split(", ")]

    def blank(batch, n):
        return pa.RecordBatch.from_arrays([batch.column(c) if c in batch.schema.names else pa.nulls(n, t) for c, t in zip(names, types)], names)

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]

    def cut(batches) -> Iterator[pa.RecordBatch]:
        part, block, held, rows = TaskContext.get().partitionId(), 0, 0, []

        def close():
            docs, postings = _shard(rows, (part << 24) + block, terms)
            yield blank(docs, docs.num_rows)
            for i in range(0, postings.num_rows, 20_000):
                piece = postings.slice(i, 20_000)
                yield blank(piece, piece.num_rows)

        for batch in batches:
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                size = len(value.as_buffer()) if value.is_valid else 0
                if rows and held + size > shard_bytes:
                    yield from close()
                    block, held, rows = block + 1, 0, []
                rows.append((key, words(value.as_py())))
                held += size
        if rows:
            yield from close()

    source = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # Each run of rows of a task is a shard, so the scan is not shuffled.
    source.mapInArrow(cut, schema).withColumn("kind", F.when(F.col("term").isNull(), "docs").otherwise("postings")).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    # Read twice, so that the two parts can be joined; an empty index has neither folder.
    docs, postings = (spark.read.schema(f"{schema}, kind string").parquet(path).where(F.col("kind") == kind) for kind in ("docs", "postings"))
    return PhraseIndex(docs.select("shard", "row", "start", "n_words", "doc_id"), postings.select("shard", "term", "n", "deltas"))


def _windows(phrase: list[bytes], size: int, counts) -> set[int]:
    """For each window of the phrase the place of its rarest term; the windows without a missing term only."""
    rarity = [counts(w) for w in phrase]
    size = min(size, len(phrase))
    found = set()
    for s in range(len(phrase) - size + 1):
        part = rarity[s : s + size]
        if min(part) > 0:
            found.add(s + part.index(min(part)))
    return found


def _inside(values: np.ndarray, postings: np.ndarray) -> np.ndarray:
    place = np.searchsorted(postings, values)
    place[place == len(postings)] = 0
    return postings[place] == values


def _exact(phrase, size, postings) -> Iterator[tuple[int, int]]:
    """(first, last) positions of the longest stretches that consist of matched windows."""
    size = min(size, len(phrase))
    found = set()
    for a in sorted(_windows(phrase, size, lambda w: len(postings.get(w, ())))):
        here = postings[phrase[a]]
        left, right = np.zeros(len(here), np.int64), np.zeros(len(here), np.int64)
        for reach, step in ((left, -1), (right, 1)):
            alive = np.arange(len(here))
            for d in range(1, size):
                p = a + step * d
                if not 0 <= p < len(phrase) or not len(alive) or phrase[p] not in postings:
                    break
                alive = alive[_inside(here[alive] + step * d, postings[phrase[p]])]
                reach[alive] = d
        for i in np.flatnonzero(left + right + 1 >= size):
            # Stretches around several anchors of one alignment are joined below.
            found.add((int(here[i]) - a, int(here[i] - left[i]), int(here[i] + right[i])))
    held = None
    for start, first, last in sorted(found):
        if held and held[0] == start and first <= held[2] + 1:
            held = (start, held[1], max(last, held[2]))
            continue
        if held:
            yield held[1:]
        held = (start, first, last)
    if held:
        yield held[1:]


def _near(phrase, slop, postings, begin) -> Iterator[tuple[int, int]]:
    """(first, last) around an occurrence of the rarest term with every other term at most ``slop`` words away in its document."""
    terms = sorted(set(phrase), key=lambda w: (len(postings.get(w, ())), w))
    if any(w not in postings for w in terms):
        return
    here = postings[terms[0]]
    low, high = here.copy(), here.copy()
    alive = np.ones(len(here), bool)
    # What lies in the neighbouring document is out of reach, however close.
    document = np.searchsorted(begin, here, "right") - 1
    least = np.maximum(begin[document], here - slop)
    most = np.minimum(np.append(begin[1:], np.iinfo(np.int64).max)[document] - 1, here + slop)
    for w in terms[1:]:
        other = postings[w]
        place = np.searchsorted(other, here)
        before = np.where(place > 0, other[np.maximum(place - 1, 0)], -1)
        after = np.where(place < len(other), other[np.minimum(place, len(other) - 1)], np.iinfo(np.int64).max)
        behind, ahead = before >= least, after <= most
        closest = np.where(behind & (~ahead | (here - before <= after - here)), before, np.where(ahead, after, here))
        alive &= behind | ahead
        low, high = np.minimum(low, closest), np.maximum(high, closest)
    for i in np.flatnonzero(alive):
        yield int(low[i]), int(high[i])


MATCH_SCHEMA = "shard bigint, row int, item string, first bigint, last bigint"


def search(index: PhraseIndex, phrases: dict[str, list[bytes]], window: int, slop: int | None = None) -> DataFrame:
    """(shard, row, item, first, last): word places in a document that a window of the item matches.

    Without ``slop`` a match is ``window`` consecutive words of the item (all of
    a shorter item) in the same order. With it, it is every word of the item
    within ``slop`` words of its rarest word; the closest occurrences are taken.
    """
    spark: SparkSession = index.postings.sparkSession
    blocks: list[dict[str, list[bytes]]] = [{}]
    held = 0
    for item, phrase in phrases.items():
        if held > QUERY_BYTES:
            blocks.append({})
            held = 0
        if phrase:
            blocks[-1][item] = phrase
            held += sum(map(len, phrase))
    found = None
    for block in blocks:
        part = _search_block(spark, index, block, window, slop)
        found = part if found is None else found.unionAll(part)
    return found


def _search_block(spark, index, block, window, slop):
    terms = spark.createDataFrame([(bytearray(t),) for t in sorted({w for p in block.values() for w in p})] or [], "term binary")
    asked = index.postings.join(terms, "term", "left_semi").select("shard", "term", "deltas")
    # Each shard's documents travel with its postings, so that places are turned into words of a document at once.
    starts = index.docs.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("start", "row"))).alias("s"))
    starts = starts.select("shard", F.col("s.start").alias("starts"))

    def match(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        postings = {bytes(t): np.cumsum(np.frombuffer(d, np.uint32), dtype=np.int64) for t, d in zip(left["term"], left["deltas"])}
        begin = np.asarray(right["starts"].iloc[0], np.int64) if len(right) else np.zeros(1, np.int64)
        rows = set()
        for item, phrase in block.items():
            for first, last in _exact(phrase, window, postings) if slop is None else _near(phrase, slop, postings, begin):
                row = int(np.searchsorted(begin, first, "right")) - 1
                if slop is not None and row != int(np.searchsorted(begin, last, "right")) - 1:
                    continue
                rows.add((key[0], row, item, first - int(begin[row]), last - int(begin[row])))
        return pd.DataFrame(sorted(rows), columns=["shard", "row", "item", "first", "last"])

    return asked.groupBy("shard").cogroup(starts.groupBy("shard")).applyInPandas(match, MATCH_SCHEMA)


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, items (sorted distinct ids as strings), contaminated.

    Benchmark items are read to the driver in full: a test set is a stated query
    set of bounded size; ``search`` sends it out in blocks of at most 16 MB. Null item ids
    are read as an empty string. Items of several rows match if any of them does.
    """
    phrases: dict[str, list[bytes]] = {}
    owner: dict[str, str] = {}
    for n, r in enumerate(benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{item_text}`").alias("t")).toLocalIterator()):
        phrases[f"{n}"] = words(r.t)
        owner[f"{n}"] = r.i
    index = build(df, id_col, text, frozenset(w for p in phrases.values() for w in p))
    names = df.sparkSession.createDataFrame(list(owner.items()), "item string, item_id string")
    matches = search(index, phrases, window).join(names, "item")
    # Overlapping stretches of a document are counted once: add up what each adds past the end of those before it.
    union = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n"),
            F.greatest(acc["end"], s["last"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    hits = matches.groupBy("shard", "row").agg(F.collect_set(F.struct("first", "last")).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))
    hits = hits.select("shard", "row", union.alias("n_hit"), "items")
    return index.docs.join(hits, ["shard", "row"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        "shard",
        "row",
    )
