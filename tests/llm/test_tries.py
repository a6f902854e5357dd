"""Bounds and packing of the phrase counts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quillframe.llm import phrase_mining


@pytest.mark.parametrize("size, words", [(2, 20_000), (3, 5_000)])
def test_array_grows_with_phrases(size, words):
    rng = random.Random(size)
    # Few first words have most of the followers, over the whole alphabet.
    word = lambda: f"w{int(words * rng.random() ** 4)}"
    phrases = sorted({("en", " ".join(word() for _ in range(size))) for _ in range(40_000)})
    trie = phrase_mining.DoubleArrayTrie(phrases, size)
    assert len(trie.base) < 2 * size * len(phrases) + 10 * trie.digits
    every = [phrases[i][1].split(" ") for i in rng.sample(range(len(phrases)), 500)]
    names = [".", *sorted({w for p in every for w in p})]
    codes = np.array([n for p in every for n in (*(names.index(w) for w in p), 0)], np.int32)
    got = trie.count("en", pa.array(names), codes)
    asked = {" ".join(p) for p in every}
    assert got.tolist() == [int(p in asked) for _, p in phrases]


@pytest.mark.parametrize("most", [0, 1, 255, 256, 70_000, 1 << 33])
def test_packed_counts(most):
    counts = np.array([0, 1, most, 7], np.int64)
    assert phrase_mining._unpacked(phrase_mining._packed(counts), 4).tolist() == counts.tolist()


def test_no_phrases():
    trie = phrase_mining.DoubleArrayTrie([], 2)
    assert trie.count("en", pa.array(["."]), np.zeros(5, np.int32)).tolist() == []


def test_buckets_are_packed_by_ranges(spark, monkeypatch):
    from quillframe.llm import phrase_mining as p

    rng = np.random.default_rng(5)
    found = [np.unique(rng.integers(0, 1 << p.BUCKET_BITS, n, np.uint64) >> np.uint64(shift), return_counts=True) for n, shift in ((5000, 0), (3000, 28), (1, 0))]
    want = {}
    for keys, counts in found:
        for k, n in zip(keys.tolist(), counts.tolist()):
            want[k] = want.get(k, 0) + n
    low = p.BUCKET_BITS - p.RANGE_BITS
    keys, counts = p._summed(found)
    assert dict(zip(keys.tolist(), counts.tolist())) == want
    rows = p._bucket_rows(keys, counts, low)
    got = {}
    for first, size, offsets, n in zip(*(rows.column(c).to_pylist() for c in rows.schema.names)):
        got |= dict(zip(((first << low) + p._offsets(offsets, size)).tolist(), p._unpacked(n, size).tolist()))
    assert got == want
    # A step between buckets takes at most four bytes; a row of two whole numbers a bucket took sixteen.
    many = p._bucket_rows(*np.unique(rng.integers(0, 1 << p.BUCKET_BITS, 1 << 20, np.uint64), return_counts=True), low)
    assert many.nbytes < 5 * (1 << 20)

    # The same bitmap however few buckets are held at a time.
    df = spark.createDataFrame([("de", f"a{i % 7} b{i % 5} c{i % 3}, a{i % 7} b{i % 5}") for i in range(400)], "lang string, text string").repartition(3)

    def bitmap():
        texts = p.corpus(df)
        words = p.word_counts(texts).where("n >= 30").withColumnRenamed("word", "phrase")
        return p.bucket_bitmap(texts, 2, p.word_bitmap(words), 12).value

    whole = bitmap()
    monkeypatch.setattr(p, "BUCKETS", 2)
    assert whole.any() and np.array_equal(whole, bitmap())


@pytest.mark.parametrize("vocabulary", [50, 3000, 90_000])
def test_numbered_texts_are_small(spark, tmp_path, vocabulary, monkeypatch):
    from pathlib import Path

    rng = np.random.default_rng(vocabulary)
    made = [[f"Word{n}é" for n in np.minimum(rng.zipf(1.3, 400), vocabulary)] for _ in range(600)]
    texts = [" ".join(words) + "." for words in made] + ["", None]
    if vocabulary == 50:
        monkeypatch.setattr(phrase_mining, "BLOCK_BYTES", 20_000)  # many blocks, and some languages written before others
    df = spark.createDataFrame([(["de", "en", "fr", None][i % 4], t) for i, t in enumerate(texts)], "lang string, text string").coalesce(2)
    stored = phrase_mining.corpus(df)
    total = sum(len(words) for words in made)
    written = sum(Path(f.removeprefix("file:")).stat().st_size for f in stored.inputFiles())
    # Four bytes a place and eight bytes a word of a block for its hash went to disk.
    assert written < 3 * total
    want = {}
    for i, words in enumerate(made):
        for w in words:
            key = (["de", "en", "fr", "und"][i % 4], w.replace("W", "w"))
            want[key] = want.get(key, 0) + 1
    assert {(r.lang, r.word): r.n for r in phrase_mining.word_counts(stored).collect()} == want
    placed = {}
    for lang, words, codes in phrase_mining._blocks(stored.toArrow().to_batches()):
        assert words[0].as_py() == "." and codes[0] == 0
        names = words.to_pylist()
        placed.setdefault(lang, []).extend(" ".join(names[c] for c in codes).split(" . "))
    tokens = lambda parts: sorted(p for p in (p.strip(" .") for p in parts) if p)
    for k, lang in enumerate(("de", "en", "fr", "und")):
        assert tokens(placed[lang]) == sorted(" ".join(words).replace("W", "w") for words in made[k::4])


def test_word_hashes_depend_on_word_and_language():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 7, 63, 64, 65, 200]))) for _ in range(3000)})
    every = phrase_mining._word_hashes("en", pa.array(words))
    assert len(set(every.tolist())) == len(words)
    assert not set(every.tolist()) & set(phrase_mining._word_hashes("de", pa.array(words)).tolist())
    part = rng.sample(range(len(words)), 200)
    assert phrase_mining._word_hashes("en", pa.array([words[i] for i in part])).tolist() == every[part].tolist()
    assert phrase_mining._word_hashes("en", pa.array(words).slice(100, 50)).tolist() == every[100:150].tolist()
    assert len(phrase_mining._word_hashes("en", pa.array([], pa.string()))) == 0


def test_listed_phrases_are_packed_by_ranges(spark, monkeypatch):
    p = phrase_mining
    rng = random.Random(7)
    phrases = sorted({f"word{int(3000 * rng.random() ** 3)} é{int(3000 * rng.random() ** 3)}" for _ in range(60_000)})
    rng.shuffle(phrases)
    rows = p._phrase_rows("en", pa.array(phrases))
    ranges = [p._phrases(data, size).to_pylist() for data, size in zip(rows.column("phrases").to_pylist(), rows.column("size").to_pylist())]
    assert sorted(x for part in ranges for x in part) == sorted(phrases) and len(ranges) == 1 << p.PHRASE_RANGE_BITS
    assert rows.nbytes < sum(len(x.encode()) for x in phrases) / 2
    # Any task deals a phrase to the same range.
    again = p._phrase_rows("en", pa.array(ranges[5]))
    assert again.column("first").to_pylist() == [rows.column("first")[5].as_py()]
    assert p._phrase_rows("en", pa.array([], pa.string())).num_rows == 0

    # The same phrases once each however few are held at a time, and as many rows as ranges leave a task.
    monkeypatch.setattr(p, "BLOCK_BYTES", 2000)
    texts = [(["de", None][i % 2], f"a{i % 7} b{i % 5} c{i % 3}, a{i % 7} b{i % 5} {rng.choice('xyz')}{i}") for i in range(400)]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)

    def listed(size):
        numbered = p.corpus(df)
        words = p.word_counts(numbered).where("n >= 12").withColumnRenamed("word", "phrase")
        shorter = p.word_bitmap(words)
        passing = p.bucket_bitmap(numbered, size, shorter, 3)
        return sorted(map(tuple, p.candidates(numbered, size, shorter, passing, words).collect()))

    whole = listed(2)
    want = {}
    for lang, text in texts:
        for piece in text.split(","):
            words = piece.split()
            for pair in zip(words, words[1:]):
                key = (lang or "und", " ".join(pair))
                want[key] = want.get(key, 0) + 1
    frequent = {k for k, n in want.items() if n >= 3}
    assert frequent and frequent <= set(whole) and len(whole) == len(set(whole))
    monkeypatch.setattr(p, "LISTED_BYTES", 2)
    assert listed(2) == whole
