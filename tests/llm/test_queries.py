"""Every numbered query on the smallest tables: against its SQL, or against a plain version."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import difference

from . import brute

FOLDER = "/root/testdata/sf0.001"


def rows(name, *columns):
    return duckdb.sql(f"SELECT {', '.join(columns)} FROM '{FOLDER}/{name}.parquet'").fetchall()


def result(spark, name, key, *columns):
    found = entry.queries()[name](spark, FOLDER).select(key, *columns).collect()
    assert len(found) == len({r[0] for r in found})
    return {r[0]: tuple(r[1:]) for r in found}


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_op2(spark):
    assert result(spark, "op2_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == brute.tokens(rows("documents", "doc_id", "text"))


def test_op3(spark):
    pages = rows("pages", "page_id", "url")
    tree = brute.url_tree(pages)
    want = {key: (*brute.rule_of(url), *tree[key]) for key, url in pages}
    assert result(spark, "op3_url_filters", "page_id", "host", "path", "rule", "template", "verdict") == want


def test_op4(spark):
    want = {k: (n, c, c == k) for k, (n, c) in brute.near(rows("documents", "doc_id", "text")).items()}
    assert result(spark, "op4_minhash_near_dedup", "doc_id", "n_shingles", "component_id", "kept") == want


def test_op5(spark):
    assert result(spark, "op5_bpe_automaton", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == brute.bpe(rows("documents", "doc_id", "text"))


def test_op6(spark):
    want = brute.leaks(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    assert result(spark, "op6_benchmark_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def test_op7(spark):
    got = result(spark, "op7_warc_capture_index", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == brute.archive(rows("pages", "page_id", "html"))


def test_op8(spark):
    got = result(spark, "op8_importance_resampling", "doc_id", "kept")
    labels = rows("labels", "doc_id", "quality", "toxic")
    good = [got[k][0] for k, q, t in labels if q == 1 and t == 0]
    bad = [got[k][0] for k, q, _ in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_op9(spark):
    name = "op9_line_dedup"
    assert difference(entry.queries()[name](spark, FOLDER), FOLDER, entry.oracle_sql()[name]) is None


def test_op10(spark):
    got = result(spark, "op10_quality_rules", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = brute.quality(rows("documents", "doc_id", "text"))
    assert {k: v[:6] for k, v in got.items()} == want
    assert not any(v[5] and v[6] for v in got.values())
    good = [got[k] for k, q, t in rows("labels", "doc_id", "quality", "toxic") if q == 1]
    assert sum(v[6] for v in good) >= 0.95 * len(good)


def test_op11(spark):
    want = {k: brute.run_digest(k, t) for k, t in rows("documents", "doc_id", "text")}
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert result(spark, "op11_periodic_runs", "doc_id", *columns) == want
    assert sum(v[0] > 0 for v in want.values()) >= 15


@pytest.mark.parametrize("name", ["op12_source_mixing", "op13_phrase_collocations"])
def test_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), FOLDER, entry.oracle_sql()[name]) is None


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain version on what the stage before it kept."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = []
    for name, stage in p.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r["doc_id"]: r.asDict() for r in docs.collect()})
    every = dict(rows("documents", "doc_id", "text"))
    quality, lines, near, clean, tokens = kept
    assert all(quality[k]["text"] == every[k] for k in quality)
    plain = brute.kept_lines([(k, r["text"]) for k, r in quality.items()])
    want = {k: text for k, (_, dropped, text) in plain.items() if not dropped or text.strip()}
    assert {k: r["text"] for k, r in lines.items()} == want
    groups = brute.near([(k, r["text"]) for k, r in lines.items()], size=5)
    assert set(near) == {k for k, (_, c) in groups.items() if c == k}
    leaks = brute.leaks([(k, r["text"]) for k, r in near.items()], rows("benchmark", "item_id", "text"))
    assert set(clean) == {k for k, v in leaks.items() if not v[4]}
    import hashlib

    want = brute.bpe([(k, r["text"]) for k, r in clean.items()])
    assert {k: (r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), r["decoded_sha256"]) for k, r in tokens.items()} == want


@pytest.mark.parametrize("name", ["pipeline"])
def test_run(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 50
