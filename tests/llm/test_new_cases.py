"""Runs, mixing and collocations: nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillframe.llm import mixing, periodic_runs, phrase_mining

from . import brute


def test_runs_of_small_alphabets():
    rng = random.Random(1)
    for _ in range(300):
        length, exponent = rng.choice([2, 4, 6, 9]), rng.choice([2, 3, 4])
        docs = []
        for _ in range(rng.randint(0, 4)):
            words = [str(rng.randrange(rng.randint(1, 4))) for _ in range(rng.randint(0, 40))]
            p = rng.randint(1, 6)
            docs.append([words[i % p] if i > len(words) // 4 else w for i, w in enumerate(words)])
        found, _ = periodic_runs._texts([" ".join(d) for d in docs], length, exponent)
        assert [[(r["start"], r["length"], r["period"]) for r in f] for f in found] == [brute.runs(d, length, exponent) for d in docs]


def test_runs_frame(spark):
    long = "tick tock " * 20_000 + "end"
    texts = [(1, "a b a b a b a b\x0bc"), (2, None), (3, ""), (None, "x x x x x x"), (1, "a b a b a b a b\x0bc"), (4, long), (5, "É é É é É é É é")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("RUNS", F.lit(1)).withColumn("start", F.lit("old"))
    got = sorted(((r.doc_id or 0, r.collapsed, len(r.runs), r.start) for r in periodic_runs.find_runs(docs).collect()))
    assert got == [(0, "x", 1, "old"), (1, "a b c", 1, "old"), (1, "a b c", 1, "old"), (2, "", 0, "old"), (3, "", 0, "old"), (4, "tick tock end", 1, "old"), (5, "É é", 1, "old")]
    assert periodic_runs.find_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_exponent=1)


def filled(sizes, weights, budget, limit):
    """Targets by raising the level until the budget is out: halving."""
    low, high = 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(limit * s, level * w) for s, w in zip(sizes, weights)) < budget else (low, level)
    return [min(limit * s, level * w) for s, w in zip(sizes, weights)]


def test_mix(spark):
    rng = random.Random(2)
    docs = [(i, "w " * rng.choice([1, 5, 40, 900]), rng.choice(["hot"] * 9 + ["b", "c", "é", None])) for i in range(800)]
    docs += [(950, "w w w", "b"), (950, "w w w", "b"), (None, "w", "b"), (900, None, "c"), (901, "", "zero"), (902, "w " * 50_000, "c")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("Taken", F.lit("old")).withColumn("row", F.lit("old"))
    rows = mixing.mix(frame).collect()
    assert len(rows) == len(docs) and all(0 <= r.taken <= 2 * r.size for r in rows)
    total = sum(r.size for r in rows)
    assert sum(r.taken for r in rows) == total * 3 // 2
    by_id = {d[0]: d[2] for d in docs}
    names = sorted({d[2] for d in docs}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len((d[1] or "").split()) for d in docs if d[2] == n) for n in names]
    want = dict(zip(names, filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * total, 2)))
    taken = Counter()
    for r in rows:
        taken[by_id[r.doc_id]] += r.taken
        assert r.target == pytest.approx(want[by_id[r.doc_id]], rel=1e-9)
    for name in names:
        assert abs(taken[name] - want[name]) <= 0.003 * want[name] + 2
    again = mixing.mix(frame.repartition(7, "text")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mixing.mix(frame.where("false")).count() == 0
    assert [r.target for r in mixing.mix(frame.where("doc_id IN (900, 901)")).collect()] == [0.0, 0.0]


def plain_phrases(docs, settings):
    counts = Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(brute.UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, settings.longest + 1):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= settings.min_count}
    longer = Counter()
    for (lang, words), n in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(n, longer[lang, words[i : i + k]])
    out = []
    for (lang, words), a in often.items():
        if 100 * longer[lang, words] >= settings.covered * a and (lang, words) in longer:
            continue
        cuts = [(settings.scale * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], score))
    out.sort(key=lambda r: (r[0], -r[5], -r[2], r[1].encode()))
    rank, ranked = Counter(), []
    for r in out:
        rank[r[0]] += 1
        if rank[r[0]] <= settings.top:
            ranked.append((r[0], rank[r[0]], *r[1:5], sum(n for (lang, w), n in counts.items() if lang == r[0] and len(w) == 1), r[5]))
    return ranked


def test_phrases(spark, monkeypatch):
    rng = random.Random(3)
    docs = [("en", " ".join(rng.choice("abcde") + rng.choice(" ,\t\n.\x1c") for _ in range(60))) for _ in range(60)]
    docs += [(None, "New York is new york. NEW YORK!"), ("und", "new york"), ("e n", "a b a b a b"), ("de", None), ("de", ""), ("en", "é " * 30_000)]
    docs += docs[:3]
    frame = spark.createDataFrame(docs, "lang string, text string").withColumn("Rank", F.lit("old")).withColumn("words", F.lit("old")).repartition(3)
    settings = phrase_mining.PhraseSettings(min_count=3, top=40)
    want = plain_phrases(docs, settings)
    assert len(want) > 40
    got = lambda: sorted(map(tuple, phrase_mining.top_phrases(frame, settings=settings).collect()))
    assert got() == sorted(want)
    monkeypatch.setattr(phrase_mining, "TRIE_BYTES", 500)  # many tries
    assert got() == sorted(want)
    assert phrase_mining.top_phrases(frame.where("false")).count() == 0


def test_trie_is_exact():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    phrases = sorted({(rng.choice(["en", "de"]), " ".join(rng.choice(words) for _ in range(3))) for _ in range(3000)})
    trie = phrase_mining.DoubleArrayTrie(phrases, 3)
    codes = np.array([rng.randrange(41) for _ in range(5000)], np.int32)
    got = trie.count("en", pa.array([".", *words]), codes)
    names = [None, *words]
    seen = Counter(" ".join(names[c] for c in codes[i : i + 3]) for i in range(4998) if codes[i : i + 3].all())
    assert got.tolist() == [seen[p] if lang == "en" else 0 for lang, p in phrases]


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def stage_rows(spark, name, docs, folder="/root/testdata/sf0.001"):
    import corpus_pipeline as p

    return sorted(((r.doc_id or -1, (r.text or "")[:30]) for r in dict(p.STAGES)[name](spark, docs, folder).collect()))


def test_decontamination_drops_rows_not_ids(spark):
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    texts = [(None, item), (None, "clean one"), (7, item), (7, "clean two"), (8, None), (9, ""), (None, None)]
    docs = spark.createDataFrame([(*t, "en", None, None) for t in texts], DOCS)
    assert stage_rows(spark, "decontamination", docs) == [(-1, ""), (-1, "clean one"), (7, "clean two"), (8, ""), (9, "")]


@pytest.mark.parametrize("name", ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "bpe_encoding"])
def test_stages_take_any_rows(spark, name):
    import corpus_pipeline as p

    stage = dict(p.STAGES)[name]
    texts = [(None, "one two"), (None, None), (5, "x y z"), (5, "x y z"), (6, "long " * 40_000), (7, ""), (7, "other words here")]
    docs = spark.createDataFrame([(*t, None, None, None) for t in texts], DOCS).withColumn("kept", F.lit("old")).withColumn("_row", F.lit("old"))
    rows = stage(spark, docs, "/root/testdata/sf0.001")
    if name == "bpe_encoding":
        assert rows.count() == len(texts)
    else:
        assert rows.columns == p.COLUMNS
        assert name == "quality_classifier" or rows.where("text LIKE 'long%'").count() == 1
    assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0


def test_proximity_stays_inside_documents(spark):
    from quillframe.llm import phrase_index

    rng = random.Random(5)
    docs = ["w", "rare a a w"] + [" ".join(rng.choice("abcdw") for _ in range(rng.randint(0, 6))) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").coalesce(1)
    index = phrase_index.build(frame)
    for phrase in (["rare", "w"], ["a", "b"], ["c", "d", "w"]):
        for slop in (1, 3):
            found = {r.row for r in phrase_index.search(index, {"q": [w.encode() for w in phrase]}, 10, slop).collect()}
            counts = Counter(w for d in docs for w in d.split())
            rare = min(phrase, key=lambda w: (counts[w], w))
            want = set()
            for i, d in enumerate(docs):
                words = d.split()
                for at in [k for k, w in enumerate(words) if w == rare]:
                    if all(w in words[max(0, at - slop) : at + slop + 1] for w in phrase):
                        want.add(i)
            assert found == want


def test_archives_of_large_pages(spark, monkeypatch):
    from quillframe.llm import warc_index
    from quillframe.session import fresh_path

    monkeypatch.setattr(warc_index, "CHUNK", 1000)
    pages = [(i, f"http://h{i}.org?q={i}", "é" * (i * 700)) for i in range(9)] + [(20, "http://big.org/", "b" * 3_000_000), (21, "http://big.org/", "b" * 3_000_000)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("first", F.lit("old")).coalesce(1)
    for limit in (500_000, 0):
        monkeypatch.setattr(warc_index, "REPEATED_PAYLOADS", limit)
        got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc_index.archive_and_read(frame).collect()}
        assert got == {k: (len(h.encode()), "revisit" if k == 21 else "response", 20 if k == 21 else None) for k, _, h in pages}
    path = fresh_path(spark, "warc")
    warc_index.write_archives(frame, path, "page_id", "url", "html")
    asked = spark.createDataFrame([(f"http://nothing{i}.org/",) for i in range(5000)] + [("http://h3.org?q=3",)], "url string")
    assert [r.page_id for r in warc_index.lookup(warc_index.build_index(spark, path), asked).collect()] == [3]
    assert warc_index.url_key("http://h3.org?q=3") == "org,h3)/?q=3"


def test_arrow_line_keys_are_sparks(spark):
    from quillframe.llm import line_runs

    texts = ["Ab" * 30 + "\n\t  " + "É" * 41 + " \n" + "é" * 30, None, "", "\x0bq" * 30, "x" * 39]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")
    plain = frame.select("doc", F.array_compact(F.array_distinct(line_runs.line_array(F.col("text"), 40))).alias("keys")).where("size(keys) > 0")
    tidy = lambda df: sorted((r.doc, sorted(map(tuple, r["keys"]))) for r in df.collect())
    assert tidy(line_runs.document_keys(frame, 40)) == tidy(plain)
