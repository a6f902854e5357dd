"""Phrase collocations: frequent phrases counted by broadcast double-array tries of Apriori-safe candidates.

The texts are split into pieces and words once and written as numbered words with a
dictionary per block of texts; words' hashes are made anew at each reading, since they are
larger than the numbers. Then, for phrases of two, three and four words:

1. Candidates. Every place whose two shorter phrases can be frequent adds one to the bucket
   its phrase's hash falls in. Only phrases of buckets with at least ``min_count`` can be
   frequent; those buckets are one bit each of a bitmap of fixed size, which is also the
   next length's filter. Phrases at places the bitmap lets pass are listed once each, and
   stay candidates if both shorter phrases are frequent by their exact counts. All filters
   let too much pass, never too little, so no frequent phrase is lost at any table size.
2. Counting. The candidates are cut into blocks of bounded bytes. A block becomes a double-array
   trie, which is broadcast. A task follows the trie for all places of its texts at
   once, one word deeper a step, counts the places by the state they end in, and
   the tasks' counts are summed.

A phrase belongs to its language; a null language is ``und``. Null and empty texts have
no words. Repeated rows and ids count each time. Ties are broken by count, then phrase.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import arrow_bounded, slices, stored_wide

#: Piece ends become "." (itself one), tabs blanks; the other characters that Python's bytes split at are piece ends.
PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"." * 9 + b" ")
#: Bits of a length's bitmap: 8 MB whatever the tables hold.
BITMAP_BITS = 26
BUCKET_BITS = 40
#: Buckets are sent and added up by ranges of the same first bits; a task sends or adds up so many at a time.
RANGE_BITS = 12
BUCKETS = 1 << 20
#: Listed phrases are sent by ranges of their hashes' first bits; a task holds so many bytes of them before it sends them or drops the repeated ones.
PHRASE_RANGE_BITS = 8
LISTED_BYTES = 24 << 20
#: Bytes of a language's text in a block. A task holds so much as Python objects, and numbered words of so many blocks until they are full.
BLOCK_BYTES = 2 << 20
HELD_BLOCKS = 4
#: Bytes of a word that are hashed for all words at once; longer words are hashed one by one.
SHORT_WORD = 64
#: Bytes of candidate phrases in one trie.
TRIE_BYTES = 32 << 20
#: Phrases whose counts a task sends as one packed row.
COUNTED = 4096
#: Places of a trie's array that are looked at for free ones at a time.
SEARCHED = 256
ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PhraseSettings:
    """Phrases of 2 to ``longest`` words found ``min_count`` times; one is dropped inside a longer one with ``covered`` percent of its count."""

    longest: int = 4
    min_count: int = 30
    scale: int = 2_000_000
    covered: int = 80
    top: int = 2000


CORPUS = "lang string, words array<string>, counts array<bigint>, codes binary"


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """A hash of each word and its language: all words together, a byte a step."""
    words = words.cast(pa.string())
    if not len(words):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    starts, lengths = offsets[:-1], np.diff(offsets)
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.full(len(words), seed, np.uint64)
    left = np.flatnonzero(lengths <= SHORT_WORD)
    for j in range(SHORT_WORD):
        left = left[lengths[left] > j]
        if not len(left):
            break
        hashes[left] = (hashes[left] ^ letters[starts[left] + j]) * ODD
    for i in np.flatnonzero(lengths > SHORT_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(letters[starts[i] : offsets[i + 1]].tobytes(), seed)
    return (hashes ^ (hashes >> np.uint64(32))) * ODD


def corpus(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Blocks of texts of one language: their words, how often each occurs, and all places as numbers of words, 0 between pieces."""
    arrow_bounded(df.sparkSession)
    rows = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def number(batches):
        held: dict[str, list[pa.DictionaryArray]] = {}
        sizes: dict[str, int] = {}
        total = 0
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                places: dict[str, list[bytes]] = {}
                for name, value in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    tokens = places.setdefault(name, [b"."])
                    value = value.encode()
                    tokens += value.lower().translate(PIECES).replace(b".", b" . ").split()
                    tokens.append(b".")
                    sizes[name] = sizes.get(name, 0) + len(value) + 1
                    total += len(value) + 1
                del part
                for name, tokens in places.items():
                    held.setdefault(name, []).append(pa.array(tokens, pa.binary()).dictionary_encode())
                del places
                for name in list(held):
                    if sizes[name] >= BLOCK_BYTES or total >= HELD_BLOCKS * BLOCK_BYTES:
                        total -= sizes.pop(name)
                        yield _block_row(name, held.pop(name))
        for name in list(held):
            yield _block_row(name, held.pop(name))

    return stored_wide(rows.mapInArrow(number, CORPUS), "phrase-corpus")


def _block_row(lang: str, held: list[pa.DictionaryArray]) -> pa.RecordBatch:
    """A block's row. Words are numbered by how often they occur, after the piece end, so that most numbers are small."""
    coded = pa.chunked_array(held).unify_dictionaries()
    words = coded.chunk(0).dictionary
    codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks])
    counts = np.bincount(codes, minlength=len(words))
    order = np.r_[0, np.argsort(-counts[1:], kind="stable") + 1]
    number = np.empty(len(order), np.min_scalar_type(len(order)))
    number[order] = np.arange(len(order))
    one = np.array([0, len(words)], np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.ListArray.from_arrays(one, words.take(pa.array(order)).cast(pa.string())), pa.ListArray.from_arrays(one, pa.array(counts[order], pa.int64())), pa.array([_planes(number[codes])], pa.binary())],
        ["lang", "words", "counts", "codes"],
    )


def _planes(codes: np.ndarray) -> bytes:
    """All numbers' first bytes, then all their second bytes and so on, which compress better than numbers."""
    return codes.view(np.uint8).reshape(len(codes), -1).T.tobytes()


def _numbers(data: bytes, length: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, length)
    return np.ascontiguousarray(planes.T).view(f"u{len(planes)}").ravel().astype(np.int32)


def _blocks(batches):
    """(language, words, number of every place) of each block of texts."""
    for batch in batches:
        for i in range(batch.num_rows):
            length = int(batch.column("counts")[i].values.to_numpy().sum())
            yield batch.column("lang")[i].as_py(), batch.column("words")[i].values, _numbers(batch.column("codes")[i].as_py(), length)


def _hashed_blocks(batches):
    """The same with the hash of every place."""
    for lang, words, codes in _blocks(batches):
        yield lang, words, _word_hashes(lang, words)[codes], codes


def _phrase_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on."""
    n = len(word) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    found = word[:n].copy()
    for j in range(1, size):
        found = (found ^ (found >> np.uint64(29))) * ODD + word[j : j + n]
    return (found ^ (found >> np.uint64(32))) * ODD


def _possible(hashes: np.ndarray, codes: np.ndarray, size: int, bitmap: np.ndarray) -> np.ndarray:
    """Places of ``size`` words inside one piece whose two shorter phrases the bitmap lets pass."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    words = codes > 0
    ok = words[:n].copy()
    for j in range(1, size):
        ok &= words[j : j + n]
    at = np.flatnonzero(ok)
    passing = _in_bitmap(bitmap, _phrase_hashes(hashes, size - 1))
    return at[passing[at] & passing[at + 1]]


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(spark: SparkSession, buckets: DataFrame):
    """Broadcast bitmap of the buckets in column ``bucket``; at most 2^(BITMAP_BITS - 6) rows of 64 bits come to the driver."""
    slots = buckets.select(F.shiftright("bucket", BUCKET_BITS - BITMAP_BITS).alias("slot"))
    bits = slots.selectExpr("shiftright(slot, 6) AS at", "shiftleft(1L, CAST(slot % 64 AS INT)) AS bit").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bitmap[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bitmap)


def word_bitmap(words: DataFrame):
    """Bitmap of frequent words (lang, phrase)."""

    def bucket(batches):
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                own = batch.column("phrase").filter(pc.equal(batch.column("lang"), lang))
                hashes = _phrase_hashes(_word_hashes(lang, own), 1)
                yield pa.RecordBatch.from_arrays([pa.array((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))], ["bucket"])

    return _bitmap(words.sparkSession, words.select("lang", "phrase").mapInArrow(bucket, "bucket bigint"))


def bucket_bitmap(texts: DataFrame, size: int, shorter, min_count: int):
    """Bitmap of the buckets that hold at least ``min_count`` places with a possible phrase of ``size`` words."""

    low_bits = BUCKET_BITS - RANGE_BITS

    def count(batches):
        found, held = [], 0
        for _, _, hashes, codes in _hashed_blocks(batches):
            at = _possible(hashes, codes, size, shorter.value)
            found.append(np.unique(_phrase_hashes(hashes, size)[at] >> np.uint64(64 - BUCKET_BITS), return_counts=True))
            held += len(found[-1][0])
            if held >= BUCKETS:
                yield _bucket_rows(*_summed(found), low_bits)
                found, held = [], 0
        if held:
            yield _bucket_rows(*_summed(found), low_bits)

    def enough(first, found):
        offsets, n = _summed(found)
        return pa.RecordBatch.from_arrays([pa.array((first << low_bits) + offsets[n >= min_count].astype(np.int64))], ["bucket"])

    def add(batches):
        first, found, held, merged = None, [], 0, 0
        for batch in batches:
            for at, length, offsets, counts in zip(*(batch.column(c).to_pylist() for c in ("first", "size", "offsets", "counts"))):
                if at != first and found:
                    yield enough(first, found)
                    found, held, merged = [], 0, 0
                first = at
                found.append((_offsets(offsets, length), _unpacked(counts, length)))
                held += length
                if held > max(2 * merged, BUCKETS):
                    found = [_summed(found)]
                    held = merged = len(found[0][0])
        if found:
            yield enough(first, found)

    packed = texts.select("lang", "words", "counts", "codes").mapInArrow(count, "first bigint, size int, offsets binary, counts binary")
    return _bitmap(texts.sparkSession, packed.repartition("first").sortWithinPartitions("first").mapInArrow(add, "bucket bigint"))


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if len(found) == 1:
        return found[0]
    keys = np.concatenate([k for k, _ in found])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(np.concatenate([n for _, n in found])[order], first)


def _bucket_rows(buckets: np.ndarray, n: np.ndarray, low_bits: int) -> pa.RecordBatch:
    """Buckets in order as a row a range: the steps from one to the next, and their counts, in as few bytes as the largest needs."""
    first, offsets = (buckets >> np.uint64(low_bits)).astype(np.int64), (buckets & np.uint64((1 << low_bits) - 1)).astype(np.int64)
    begins = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
    ends = np.r_[begins[1:], len(first)]
    steps = [_steps(offsets[a:b]) for a, b in zip(begins, ends)]
    counts = [_packed(n[a:b]) for a, b in zip(begins, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(first[begins]), pa.array((ends - begins).astype(np.int32)), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())],
        ["first", "size", "offsets", "counts"],
    )


def _steps(offsets: np.ndarray) -> bytes:
    steps = np.diff(offsets, prepend=0).astype("<u4")
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    return steps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _offsets(data: bytes, length: int) -> np.ndarray:
    steps = np.zeros((length, 4), np.uint8)
    steps[:, : len(data) // length] = np.frombuffer(data, np.uint8).reshape(length, -1)
    return np.cumsum(steps.view("<u4").ravel(), dtype=np.int64)


def candidates(texts: DataFrame, size: int, shorter, passing, frequent: DataFrame) -> DataFrame:
    """(lang, phrase) of all phrases that can be frequent: their bucket is, and their two shorter phrases are by count."""

    def listed(batches):
        held, size_held = {}, 0
        for lang, words, hashes, codes in _hashed_blocks(batches):
            at = _possible(hashes, codes, size, shorter.value)
            at = at[_in_bitmap(passing.value, _phrase_hashes(hashes, size)[at])]
            number = codes[at].astype(np.int64)
            for j in range(1, size):
                # Numbered anew after each word, so that the product never overflows.
                _, number = np.unique(number * len(words) + codes[at + j], return_inverse=True)
            _, first = np.unique(number, return_index=True)
            parts = [words.take(pa.array(codes[at[first] + j])) for j in range(size)]
            held.setdefault(lang, []).append(pc.binary_join_element_wise(*parts, " "))
            size_held += held[lang][-1].nbytes
            if size_held >= LISTED_BYTES:
                yield from (_phrase_rows(k, _distinct(v)) for k, v in held.items())
                held, size_held = {}, 0
        yield from (_phrase_rows(k, _distinct(v)) for k, v in held.items())

    def add(batches):
        key, found, held, merged = None, [], 0, 0
        for batch in batches:
            for lang, at, length, phrases in zip(*(batch.column(c).to_pylist() for c in ("lang", "first", "size", "phrases"))):
                if key != (lang, at) and found:
                    yield _named(key[0], _distinct(found))
                    found, held, merged = [], 0, 0
                key = lang, at
                found.append(_phrases(phrases, length))
                held += found[-1].nbytes
                if held > max(2 * merged, LISTED_BYTES):
                    found = [_distinct(found)]
                    held = merged = found[0].nbytes
        if found:
            yield _named(key[0], _distinct(found))

    packed = texts.select("lang", "words", "counts", "codes").mapInArrow(listed, "lang string, first int, size int, phrases binary")
    found = packed.repartition("lang", "first").sortWithinPartitions("lang", "first").mapInArrow(add, "lang string, phrase string")
    split = F.split("phrase", " ")
    known = frequent.select("lang", F.col("phrase").alias("part"))
    for start in (1, 2):
        found = found.withColumn("part", F.array_join(F.slice(split, start, size - 1), " ")).join(known, ["lang", "part"], "left_semi").drop("part")
    return stored(found, "phrase-candidates")


def _distinct(phrases: list[pa.Array]) -> pa.Array:
    return pc.unique(pa.chunked_array(phrases, pa.string()))


def _named(lang: str, phrases: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(phrases)), phrases], ["lang", "phrase"])


def _phrase_rows(lang: str, phrases: pa.Array) -> pa.RecordBatch:
    """Phrases of a language as a row a range of hashes: in order, which share their beginnings, a line each, compressed."""
    phrases = phrases.take(pc.sort_indices(phrases))
    first = (_word_hashes(lang, phrases) >> np.uint64(64 - PHRASE_RANGE_BITS)).astype(np.int32)
    order = np.argsort(first, kind="stable")
    begins = np.flatnonzero(np.diff(first[order], prepend=-1))
    lines = pc.binary_join(pa.ListArray.from_arrays(np.r_[begins, len(first)].astype(np.int32), phrases.take(pa.array(order))), "\n").cast(pa.binary())
    zstd = pa.Codec("zstd")
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang), len(begins)), pa.array(first[order][begins]), pc.binary_length(lines), pa.array([zstd.compress(r.as_buffer(), asbytes=True) for r in lines], pa.binary())],
        ["lang", "first", "size", "phrases"],
    )


def _phrases(data: bytes, length: int) -> pa.Array:
    lines = pa.Codec("zstd").decompress(data, decompressed_size=length, asbytes=True)
    return pc.split_pattern(pa.array([lines], pa.binary()).cast(pa.string()), "\n").flatten()


class DoubleArrayTrie:
    """Phrases of ``size`` words as a double array; state 0 is the root.

    A word is a letter of two digits, numbered from 1 over all languages' alphabets, each
    digit at most the root of the number of letters. So the children of a state lie close together,
    and the array grows with the phrases and not with the phrases times the letters.
    """

    def __init__(self, phrases: pa.Table | list[tuple[str, str]], size: int):
        """``phrases`` are rows of language and phrase; a table stays in Arrow and numpy arrays."""
        self.size = size
        if not isinstance(phrases, pa.Table):
            phrases = pa.table([pa.array([p[i] for p in phrases], pa.string()) for i in (0, 1)], ["lang", "phrase"])
        phrases = phrases.sort_by([("lang", "ascending"), ("phrase", "ascending")]).combine_chunks()
        self.langs, self.phrases = (pa.concat_arrays([pa.array([], pa.string()), *phrases.column(c).chunks]) for c in ("lang", "phrase"))
        langs = self.langs.dictionary_encode()
        words = pc.split_pattern(self.phrases, " ").flatten().dictionary_encode()
        many = max(1, len(words.dictionary))
        pairs = np.repeat(langs.indices.to_numpy().astype(np.int64), size) * many + words.indices.to_numpy()
        pairs, numbers = np.unique(pairs, return_inverse=True)
        paths = numbers.astype(np.int64).reshape(len(self.phrases), size) + 1
        self.alphabet: dict[str, tuple[pa.Array, np.ndarray]] = {}
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(pairs // many == code)
            self.alphabet[lang] = words.dictionary.take(pa.array(pairs[own] % many)), np.r_[0, own + 1]
        self.digits = isqrt(max(0, len(pairs) - 1)) + 1
        self._build(np.stack([(paths - 1) // self.digits + 1, (paths - 1) % self.digits + 1], axis=2).reshape(len(paths), 2 * size))

    def _build(self, paths: np.ndarray) -> None:
        most = self.digits
        used, room = most, 4 * most + SEARCHED
        base, check = np.zeros(room, np.int32), np.full(room, -1, np.int32)
        state = np.zeros(len(paths), np.int64)
        for depth in range(paths.shape[1]):
            # Children of every parent: distinct pairs of parent state and digit.
            keys, child_of = np.unique(state * (most + 1) + paths[:, depth], return_inverse=True)
            parents, digits = keys // (most + 1), keys % (most + 1)
            begins = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]][: len(keys)])
            widths = np.diff(np.r_[begins, len(keys)])
            offsets = np.zeros(len(begins), np.int64)
            # Parents with most children first; those with one child then fill the gaps.
            wide = np.flatnonzero(widths > 1) if depth else np.arange(len(begins))
            hint = most + 1
            for g in wide[np.argsort(-widths[wide], kind="stable")].tolist():
                own = digits[begins[g] : begins[g] + widths[g]]
                if used + 2 * most + SEARCHED >= len(check):
                    base, check = np.r_[base, np.zeros(len(base), np.int32)], np.r_[check, np.full(len(check), -1, np.int32)]
                if depth:
                    while hint < used and np.count_nonzero(check[hint : hint + SEARCHED] == -1) < SEARCHED // 16:
                        hint += SEARCHED
                    offsets[g] = self._fit(check, own, hint, used, most)
                check[offsets[g] + own] = parents[begins[g]]
                used = max(used, int(offsets[g] + own[-1]))
            single = np.flatnonzero(widths == 1) if depth else begins[:0]
            free = np.flatnonzero(check[most + 1 : used + 1] == -1)[: len(single)] + most + 1
            free = np.r_[free, used + 1 + np.arange(len(single) - len(free))]
            used = max(used, int(free[-1]) if len(free) else 0)
            if used >= len(check):
                more = used + 2 * most + SEARCHED - len(check)
                base, check = np.r_[base, np.zeros(more, np.int32)], np.r_[check, np.full(more, -1, np.int32)]
            offsets[single] = free - digits[begins[single]]
            check[free] = parents[begins[single]]
            base[parents[begins]] = offsets
            state = (np.repeat(offsets, widths) + digits)[child_of]
        # Room for the largest digit beyond any base, so that a step never leaves the array.
        room = used + most + 1
        pad = lambda a, v: np.r_[a[:room], np.full(max(0, room - len(a)), v, np.int32)]
        self.base, self.check = pad(base, 0), pad(check, -1)
        self.accept = np.full(room, -1, np.int32)
        self.accept[state] = np.arange(len(paths))

    @staticmethod
    def _fit(check: np.ndarray, digits: np.ndarray, hint: int, used: int, most: int) -> int:
        """A base at which all children's places are free: some free places at the hint and near the end are tried, then those after the last taken one."""
        tail = max(hint, used - 2 * most)
        free = np.r_[np.flatnonzero(check[hint : hint + SEARCHED] == -1)[:64] + hint, np.flatnonzero(check[tail : used + 1] == -1)[:64] + tail]
        tried = free[free <= used] - digits[0]
        fits = (check[tried[:, None] + digits] == -1).all(axis=1)
        return int(tried[fits.argmax()]) if fits.any() else used + 1 - int(digits[0])

    def count(self, lang: str, words: pa.Array, codes: np.ndarray) -> np.ndarray:
        """How often each phrase occurs: all places go down the trie together, a word a step."""
        n = len(codes) - self.size + 1
        if lang not in self.alphabet or n <= 0:
            return np.zeros(len(self.phrases), np.int64)
        own, numbers = self.alphabet[lang]
        letter = numbers[pc.fill_null(pc.index_in(words, own), -1).to_numpy() + 1]
        letter[0] = 0
        places = letter[codes] - 1
        at = np.flatnonzero(places[:n] >= 0)
        state = np.zeros(len(at), np.int64)
        for j in range(self.size):
            known = places[at + j] >= 0
            at, state = at[known], state[known]
            for digit_of in (np.floor_divide, np.remainder):
                onward = self.base[state] + digit_of(places[at + j], self.digits) + 1
                alive = self.check[onward] == state
                at, state = at[alive], onward[alive]
        return np.bincount(self.accept[state], minlength=len(self.phrases))


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(data: bytes, length: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // length}").astype(np.int64)


def count_phrases(texts: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, n) of the candidates that occur, a trie of bounded size at a time."""
    spark = texts.sparkSession
    weighed = found.withColumn("bytes", F.octet_length("phrase") + F.octet_length("lang") + 16)
    total, rows = weighed.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-total // TRIE_BYTES))
    block = lambda: F.pmod(F.xxhash64("lang", "phrase"), F.lit(blocks))
    while blocks < rows and weighed.groupBy(block().alias("b")).agg(F.sum("bytes").alias("s")).agg(F.max("s")).first()[0] > 2 * TRIE_BYTES:
        blocks *= 2
    counted = None
    for i in range(blocks if rows else 0):
        trie = spark.sparkContext.broadcast(DoubleArrayTrie(found.where(block() == i).select("lang", "phrase").toArrow(), size))

        def count(batches, trie=trie):
            own, totals = trie.value, None
            for lang, words, codes in _blocks(batches):
                more = own.count(lang, words, codes)
                totals = more if totals is None else totals + more
            if totals is not None and totals.any():
                starts = [s for s in range(0, len(totals), COUNTED) if totals[s : s + COUNTED].any()]
                yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array([_packed(totals[s : s + COUNTED]) for s in starts], pa.binary())], ["start", "counts"])

        def add(batches, trie=trie):
            # At most the counts of one trie, however many tasks sent theirs.
            own, totals = trie.value, {}
            for batch in batches:
                for start, counts in zip(batch.column("start").to_pylist(), batch.column("counts").to_pylist()):
                    more = _unpacked(counts, min(COUNTED, len(own.phrases) - start))
                    totals[start] = totals[start] + more if start in totals else more
            for start, counts in totals.items():
                seen = np.flatnonzero(counts)
                at = pa.array(seen + start)
                yield pa.RecordBatch.from_arrays([own.langs.take(at), own.phrases.take(at), pa.array(counts[seen])], ["lang", "phrase", "n"])

        shards = texts.select("lang", "words", "counts", "codes").mapInArrow(count, "start bigint, counts binary")
        part = stored(shards.repartition("start").mapInArrow(add, "lang string, phrase string, n bigint"), "phrase-counts")
        trie.destroy()
        counted = part if counted is None else counted.unionByName(part)
    return counted if counted is not None else spark.createDataFrame([], "lang string, phrase string, n bigint")


def frequent_phrases(texts: DataFrame, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """(lang, phrase, size, n) of all words and phrases found at least ``min_count`` times."""
    words = word_counts(texts).where(F.col("n") >= settings.min_count)
    words = stored(words.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "n"), "phrase-words")
    shorter = word_bitmap(words)
    level = found = words
    for size in range(2, settings.longest + 1):
        passing = bucket_bitmap(texts, size, shorter, settings.min_count)
        counted = count_phrases(texts, candidates(texts, size, shorter, passing, level), size)
        level = stored(counted.where(F.col("n") >= settings.min_count).select("lang", "phrase", F.lit(size).alias("size"), "n"), "phrase-level")
        found = found.unionByName(level)
        shorter.destroy()
        shorter = passing
    return found


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words; at most one row a word and block of texts is shuffled."""
    each = texts.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).where(F.col("w.words") != ".")
    return each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n"))


def _whole(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(texts: DataFrame, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases left, scored by their weakest cut."""
    counted = stored(frequent_phrases(texts, settings), "phrase-frequent")
    phrases = counted.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    side = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = cuts.select("lang", "phrase", "a", "cut", side(F.lit(1), F.col("cut")).alias("left"), side(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"))
    count_of = lambda part, name: counted.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    cuts = cuts.join(count_of("left", "l"), ["lang", "left"]).join(count_of("right", "r"), ["lang", "right"])
    # Decimals: products of counts may pass 64 bits, the quotient does not.
    cuts = cuts.withColumns({"top": _whole("a") * settings.scale, "sum": _whole("l") + _whole("r")}).withColumn("score", F.expr("top div sum"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda length: F.transform(F.sequence(F.lit(1), F.col("size") - length + 1), lambda start: F.array_join(F.slice("words", start, length), " ")),
        )
    )
    covering = phrases.where("size > 2").select("lang", "n", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = scored.join(covering, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _whole("longer") < settings.covered * _whole("a")))
    return left.select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def top_phrases(df: DataFrame, text: str = "text", lang: str = "lang", settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases; n is the number of all its words.

    Each task keeps its own best phrases of a language before they meet, so a
    language with nearly all phrases sends ``top`` rows a task.
    """
    texts = corpus(df, text, lang)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = collocations(texts, settings).withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= settings.top)
    # The piece end is word 0 of every block.
    total = texts.select("lang", (F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, c: s + c) - F.get("counts", F.lit(0))).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
