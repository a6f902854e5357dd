"""Word vectors and nearest words.

Skip-gram with negative sampling, trained in blocks of words, so that neither the driver nor
a task holds the vocabulary. Words are dealt to blocks by hash. Pairs of words within a window
are counted a chunk of texts at a time, each with the weight that a window of random
width gives its distance, and packed by cells of two blocks. A pass trains the
cells in rounds: in a round every block is in one cell, so its cells are trained side by side and no
two tasks change the same vector. A cell's task holds the vectors of its two blocks and reads its pairs as a stream;
words that did not stand there are drawn from the same two blocks by their count to the power 0.75.
"""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.similarity import vector_top_k
from ..session import fresh_path, stored
from .cooccurrence import _chunks, _narrow, _wide, frequent_words

# Python workers get these functions with the task, as those of the text steps.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words a block holds on average at most; two blocks of 100 dimensions take 80 MB in a task.
BLOCK_WORDS = 49_152
#: Smaller blocks are not made only to have more cells in a round.
LEAST_WORDS = 1024
#: Words of texts whose pairs are counted at a time.
COUNTED_WORDS = 1 << 17
#: Pairs of a cell that are put in random order at a time.
MIXED = 1 << 18
#: Pairs a step takes, words drawn for it, and what these weigh against a pair.
STEP_PAIRS, DRAWN, NEGATIVE = 1024, 32, 5.0
RATE = 0.1
#: Changes of one word in a step that are added side by side with those of other words.
LAYERS = 8
#: Bytes of rows that a task gets from Spark at a time.
BATCH_BYTES = 16 << 20

_STATE = "block int, words array<string>, n binary, m binary"
_PAIRS = "round int, i int, j int, seq bigint, size int, l binary, r binary, w binary"


@dataclass
class WordVectors:
    """``vectors`` (word, vector as an array)."""

    vectors: DataFrame

    def getVectors(self) -> DataFrame:  # noqa: N802 - named as in Spark's model
        return self.vectors.select("word", array_to_vector("vector").alias("vector"))

    def findSynonyms(self, word: str, num: int) -> DataFrame:  # noqa: N802
        """The ``num`` words nearest to ``word`` by cosine, without the word itself."""
        found = self.vectors.where(F.col("word") == word).first()
        if found is None:
            raise ValueError(f"{word} is not in the vocabulary")
        return vector_top_k(self.vectors.where(F.col("word") != word), "word", "vector", found["vector"], num)


def fit_word_vectors(
    df: DataFrame,
    tokens: str = "tokens",
    *,
    size: int = 100,
    min_count: int = 5,
    iterations: int = 1,
    partitions: int = 8,
    seed: int = 42,
    window: int = 5,
) -> WordVectors:
    """Skip-gram vectors of all words that occur at least ``min_count`` times.

    Other words are taken out before the windows are laid, as Spark's Word2Vec does.
    ``partitions`` cells are trained at a time, more if the vocabulary is large, the same on
    every cluster, so the vectors depend on the frame's partitions only. The frame is read more than once: give it as a stored table.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    counts = stored(frequent_words(df, tokens, min_count), "vector-vocabulary")
    n_words = counts.count()
    if not n_words:
        return WordVectors(spark.createDataFrame([], "word string, vector array<float>"))
    blocks = max(-(-n_words // BLOCK_WORDS), min(2 * partitions, n_words // LEAST_WORDS), 1)
    place = F.row_number().over(Window.partitionBy("block").orderBy("word")) - 1
    places = stored(counts.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)).cast("int")).withColumn("at", place), "vector-places")
    pairs = _stored_pairs(df.select(F.col(f"`{tokens}`").alias("tokens")), places, blocks, window)
    state = _written(spark, _initial(places, size, seed), "vector-state")
    for epoch in range(iterations):
        for turn in range(_rounds(blocks)):
            cells = spark.read.schema(_PAIRS).parquet(pairs).where(F.col("round") == turn)
            trained = _written(spark, _train(spark.read.schema(_STATE).parquet(state), cells, blocks, turn, size, window, [seed, epoch]), "vector-state")
            _removed(spark, state)
            state = trained
    _removed(spark, pairs)
    return WordVectors(_spelled(spark.read.schema(_STATE).parquet(state), size))


def word_vector(model: WordVectors, word: str) -> DataFrame:
    return model.getVectors().where(F.col("word") == word)


def synonyms(model: WordVectors, word: str, n: int) -> DataFrame:
    """The ``n`` words nearest to ``word`` by cosine, without the word itself."""
    return model.findSynonyms(word, n).select("word", "similarity").orderBy(F.desc("similarity"))


def _written(spark: SparkSession, df: DataFrame, label: str) -> str:
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return path


def _removed(spark: SparkSession, folder: str) -> None:
    """Take away a folder this fit has written and needs no more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _rounds(blocks: int) -> int:
    """One round of the blocks with themselves, then those in which each meets one other."""
    return 1 if blocks == 1 else blocks + blocks % 2


def _round_of(i, j, blocks: int):
    """The round of cells of blocks i <= j: 0 on the diagonal, else by the circle method of tournaments."""
    last = blocks + blocks % 2 - 1
    meet = np.where(j == last, 2 * i, i + j) % max(last, 1)
    return np.where(i == j, 0, 1 + meet)


def _cells(blocks: int, turn: int) -> list[int]:
    """Number of the cell that each block is in; a block without a partner is alone in one."""
    i, j = np.triu_indices(blocks)
    here = _round_of(i, j, blocks) == turn
    cell, found = {}, 0
    for a, b in zip(i[here].tolist(), j[here].tolist()):
        cell[a] = cell[b] = found
        found += 1
    for block in range(blocks):
        if block not in cell:
            cell[block] = found
            found += 1
    return [cell[b] for b in range(blocks)]


def _stored_pairs(rows: DataFrame, places: DataFrame, blocks: int, window: int) -> str:
    """Folder of the weighted pairs, by round: ``l`` and ``r`` are places in the blocks ``i`` <= ``j``, each pair in one direction."""
    spark = rows.sparkSession
    chunks = stored(_chunks(rows).withColumn("chunk", F.monotonically_increasing_id()), "vector-chunks")
    word = chunks.select("chunk", F.posexplode("words").alias("code", "word"))
    known = word.join(places.select("word", "block", "at"), "word").groupBy("chunk").agg(F.collect_list(F.struct("code", "block", "at")).alias("known"))
    ready = chunks.select("chunk", "codes", "sizes").join(known, "chunk").select("codes", "sizes", "known")

    def count(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                codes, sizes = (np.frombuffer(batch.column(c)[k].as_py(), np.int32) for c in ("codes", "sizes"))
                known = batch.column("known")[k].values
                code, block, at = (known.field(c).to_numpy().astype(np.int64) for c in range(3))
                order = np.lexsort((at, block))
                code, block, at = code[order], block[order], at[order]
                number = np.full(max(int(codes.max(initial=0)), int(code.max(initial=0))) + 2, -1, np.int64)
                number[code] = np.arange(len(code))
                words, owner = number[codes], np.repeat(np.arange(len(sizes)), sizes)
                kept = words >= 0
                words, owner = words[kept], owner[kept]
                for start in range(0, len(words), COUNTED_WORDS):
                    # The next words stand beside the last of this part.
                    end = min(len(words), start + COUNTED_WORDS)
                    yield from _counted(words[start : end + window], owner[start : end + window], end - start, block, at, blocks, window)

    path = fresh_path(spark, "vector-pairs")
    ready.mapInArrow(count, _PAIRS).write.partitionBy("round").parquet(path)
    return path


def _counted(words, owner, many, block, at, blocks, window):
    """The pairs whose first word is one of the first ``many``, with their weights added up, a row a cell."""
    found, bits = [], window.bit_length()
    for d in range(1, window + 1):
        n = min(many, len(words) - d)
        if n > 0:
            same = owner[:n] == owner[d : d + n]
            a, b = words[:n][same], words[d : d + n][same]
            found.append(((np.minimum(a, b) * len(at) + np.maximum(a, b)) << bits) + (window + 1 - d))
    keys = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
    if not len(keys):
        return
    weight, keys = keys & ((1 << bits) - 1), keys >> bits
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    weight, keys = np.add.reduceat(weight, first), keys[first]
    low, high = keys // len(at), keys % len(at)
    # Short numbers are sorted by their digits.
    cell = (block[low] * blocks + block[high]).astype(np.min_scalar_type(blocks * blocks))
    by = np.argsort(cell, kind="stable")
    low, high, weight, cell = at[low[by]], at[high[by]], weight[by], cell[by]
    seq = zlib.crc32(words.tobytes())
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    for begin, end in zip(first, np.r_[first[1:], len(cell)]):
        i, j = divmod(int(cell[begin]), blocks)
        packed = [pa.array([_narrow(v[begin:end])], pa.binary()) for v in (low, high, weight)]
        numbers = [pa.array([int(v)], t) for v, t in ((_round_of(np.int64(i), np.int64(j), blocks), pa.int32()), (i, pa.int32()), (j, pa.int32()), (seq, pa.int64()), (end - begin, pa.int32()))]
        yield pa.RecordBatch.from_arrays([*numbers, *packed], ["round", "i", "j", "seq", "size", "l", "r", "w"])


def _packed_state(block: int, words: pa.Array, n: bytes, parts) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    m = b"".join(p.tobytes() for p in parts)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), lists, pa.array([n], pa.binary()), pa.array([m], pa.binary())], ["block", "words", "n", "m"])


def _parts(m: bytes, n_words: int, size: int) -> list[np.ndarray]:
    """Vectors of the words, vectors of the words beside them, and the squares of either's changes."""
    flat = np.frombuffer(m, np.float32).copy()
    one = n_words * size
    return [flat[:one].reshape(-1, size), flat[one : 2 * one].reshape(-1, size), flat[2 * one : 2 * one + n_words], flat[2 * one + n_words :]]


def _initial(places: DataFrame, size: int, seed: int) -> DataFrame:
    """A row a block: its words, their counts and the vectors to start from, which depend on block and seed only."""

    def draw(key, group):
        group = group.sort_by("at")
        block, words = key[0].as_py(), pc.cast(group.column("word").combine_chunks(), pa.string())
        start = (np.random.default_rng([seed, block]).random((len(words), size), np.float32) - np.float32(0.5)) / size
        parts = [start, np.zeros_like(start), np.zeros(2 * len(words), np.float32)]
        return pa.Table.from_batches([_packed_state(block, words, group.column("n").to_numpy().astype(np.int64).tobytes(), parts)])

    return places.groupBy("block").applyInArrow(draw, _STATE)


def _train(state: DataFrame, pairs: DataFrame, blocks: int, turn: int, size: int, window: int, seed: list[int]) -> DataFrame:
    """The blocks' rows after one round."""
    cells = _cells(blocks, turn)
    cell_of = F.array(*[F.lit(c) for c in cells])
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("words", "array<string>"), ("n", "binary"), ("m", "binary"))]
    rows = state.select(
        F.get(cell_of, F.col("block")).alias("cell"), F.lit(0).alias("kind"), F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).cast("bigint").alias("seq"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("size", "int"), ("l", "binary"), ("r", "binary"), ("w", "binary"))], "words", "n", "m",
    )
    more = pairs.select(F.get(cell_of, F.col("i")).alias("cell"), F.lit(1).alias("kind"), "i", "j", "seq", "size", "l", "r", "w", *empty)
    ordered = rows.unionByName(more).repartitionById(max(cells) + 1, "cell").sortWithinPartitions("kind", "i", "j", "seq", "size")

    def train(batches):
        held, cell, waiting, step = {}, None, [], 0

        def learn():
            l, r, w = (np.concatenate(some) for some in zip(*waiting))
            rng = np.random.default_rng([*seed, turn, *cell, step])
            _learn(held[cell[0]], held[cell[1]], l, r, w.astype(np.float32) / np.float32(window), rng)
            waiting.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                key = row["i"].as_py(), row["j"].as_py()
                if row["kind"].as_py() == 0:
                    words, n = row["words"].values, row["n"].as_py()
                    held[key[0]] = words, n, _parts(row["m"].as_buffer(), len(words), size)
                    continue
                if waiting and (key != cell or sum(len(some[0]) for some in waiting) >= MIXED):
                    learn()
                    step += 1
                cell = key
                waiting.append([_wide(row[c].as_py(), row["size"].as_py()) for c in "lrw"])
        if waiting:
            learn()
        for block in sorted(held):
            words, n, parts = held[block]
            yield _packed_state(block, words, n, parts)

    return ordered.mapInArrow(train, _STATE)


def _learn(left, right, l, r, w, rng) -> None:
    """Steps over some pairs in random order, in both directions."""
    order = rng.permutation(len(l))
    (_, n, left), (_, m, right) = left, right
    left_chance, right_chance = (np.cumsum(np.frombuffer(c, np.int64) ** 0.75) for c in (n, m))
    for start in range(0, len(order), STEP_PAIRS):
        some = order[start : start + STEP_PAIRS]
        l_some, r_some, weight = l[some], r[some], w[some]
        for of, beside, chance, a, b in ((left, right, right_chance, l_some, r_some), (right, left, left_chance, r_some, l_some)):
            drawn = np.searchsorted(chance, rng.random(DRAWN) * chance[-1], "right").clip(max=len(chance) - 1)
            x, y, z = of[0].take(a, axis=0), beside[1].take(b, axis=0), beside[1][drawn]
            near = (weight / (1 + np.exp(np.clip(np.einsum("ij,ij->i", x, y), -30, 30))))[:, None]
            far = x @ z.T
            np.exp(np.clip(np.negative(far, out=far), -30, 30, out=far), out=far)
            far += 1
            np.divide(-(weight * np.float32(NEGATIVE / DRAWN))[:, None], far, out=far)
            to_y = np.empty((len(a) + DRAWN, x.shape[1]), np.float32)
            np.multiply(near, x, out=to_y[: len(a)])
            np.matmul(far.T, x, out=to_y[len(a) :])
            y *= near
            y += far @ z
            _ascend(of[0], of[2], a, y)
            _ascend(beside[1], beside[3], np.r_[b, drawn], to_y)


def _ascend(vectors, squares, rows, change) -> None:
    """Add the changes of each vector; a vector's steps shrink with the changes it has had."""
    at, total = _summed(rows, change)
    squares[at] += np.einsum("ij,ij->i", total, total) / total.shape[1]
    total *= (np.float32(RATE) / np.sqrt(squares[at] + np.float32(1e-12)))[:, None]
    vectors[at] += total


def _summed(rows, change) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sums of their changes, added one after the other.

    All rows' second changes are added at once, then all third ones, and so on; the few rows with many changes are summed each by itself.
    """
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    many = np.diff(np.r_[first, len(rows)])
    by = np.argsort(-many, kind="stable")
    first, many = first[by], many[by]
    total = change.take(order[first], axis=0)
    # So many rows have more than k changes.
    more = np.searchsorted(-many, -np.arange(LAYERS + 1), "left")
    for k in range(1, LAYERS):
        if more[k] == more[LAYERS]:
            break
        total[more[LAYERS] : more[k]] += change.take(order[first[more[LAYERS] : more[k]] + k], axis=0)
    for g, (a, n) in enumerate(zip(first[: more[LAYERS]].tolist(), many[: more[LAYERS]].tolist())):
        np.add.reduce(change.take(order[a : a + n], axis=0), axis=0, out=total[g])
    return rows[first], total


def _spelled(state: DataFrame, size: int) -> DataFrame:
    def spell(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column("words")[k].values
                vectors = _parts(batch.column("m")[k].as_buffer(), len(words), size)[0]
                for a in range(0, len(words), 8192):
                    some = vectors[a : a + 8192]
                    lists = pa.ListArray.from_arrays(np.arange(0, some.size + 1, size, dtype=np.int32), pa.array(some.ravel()))
                    yield pa.RecordBatch.from_arrays([words.slice(a, 8192), lists], ["word", "vector"])

    return stored(state.mapInArrow(spell, "word string, vector array<float>"), "word-vectors")
