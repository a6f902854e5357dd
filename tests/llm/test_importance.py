"""The two models of the resampling against plain counts, and the draw against its chances."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quillframe.llm import importance

FOLDER = "/root/testdata/sf0.001"


def plain_features(text, settings):
    """Buckets from the tokens as the docstring names them: runs of letters and digits, runs of marks, and neighbours."""
    raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    grams, words = [], []
    for pattern in (rb"[0-9a-z\x80-\xff]+", rb"[!-/:-@\[-`{-~]+"):
        one, two = importance._mixed(re.findall(pattern, raw))
        grams += [int(h) >> (64 - settings.bits) for h in (*one, *two)]
        words = words or [int(h) >> (64 - settings.word_bits) for h in one]
    return grams, words


def test_models_are_the_counted_ones(spark):
    settings = importance.ImportanceSettings()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    model = importance.Resampler(docs, labels, good)
    side = dict(importance.label_sample(labels, good, settings).collect())
    texts = {r.doc_id: plain_features(r.text, settings) for r in docs.collect()}
    raw, target, bad, fit = Counter(), Counter(), Counter(), Counter()
    for key, (grams, words) in texts.items():
        raw.update(grams)
        if side.get(key) == 0:
            target.update(grams)
            fit.update(set(words))
        elif side.get(key) == 2:
            bad.update(set(words))
    sizes = [sum(c.values()) + (1 << settings.bits) for c in (target, raw)]
    fitted = [sum(side.get(k) == label for k in texts) for label in (0, 2)]
    ratio = lambda g: math.log((target[g] + 1) / sizes[0]) - math.log((raw[g] + 1) / sizes[1])
    # The doubt compares targets with non-targets; without labels a document counts for neither.
    share = lambda w: math.log((bad[w] + 1) / (fitted[1] + 2)) - math.log((fit[w] + 1) / (fitted[0] + 2))
    got = {r["_id"]: r for r in model.scores.collect()}
    assert set(got) == set(texts)
    for key, (grams, words) in texts.items():
        row = got[key]
        assert row.n_features == len(grams)
        assert row.log_weight == np.float64(row.log_weight) and abs(row.log_weight - sum(map(ratio, grams))) < 1e-6 * max(1, len(grams))
        assert (row.doubt is None) == (not words) and (not words or abs(row.doubt - max(map(share, words))) < 1e-4)
    # Without repeated texts the draw takes exactly k of those without doubt.
    kept = model.scores.where(model.kept()).count()
    assert kept == model.k > 0


def test_draw_follows_the_softmax(spark):
    """Of two texts the first is drawn before the second as often as their weights say, over many keys."""
    settings = importance.ImportanceSettings(sharpness=2.0)
    ratio = np.zeros(1 << settings.bits)
    doubts = np.zeros(1 << settings.word_bits, np.float32)
    texts = ["apple apple apple", "pear"]
    for text, weight in zip(texts, (0.4, -0.1)):
        ratio[importance.features(text, settings)[0]] = weight
    n = 20_000
    frame = spark.range(2 * n, numPartitions=4).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n, texts[0]).otherwise(texts[1]).alias("text"))
    rows = importance.weigh(frame, ratio, doubts, "text", "doc_id", settings).toPandas().sort_values("doc_id")
    first, second = rows.perturbed.to_numpy()[:n], rows.perturbed.to_numpy()[n:]
    assert np.allclose(rows.per_feature[:n], 0.4) and np.allclose(rows.per_feature[n:], -0.1)
    chance = 1 / (1 + math.exp(-2.0 * 0.5))
    assert abs((first > second).mean() - chance) < 0.02
    # Noise has the Gumbel mean and spread, whatever the text's length.
    for part, mean in ((first, 0.8), (second, -0.2)):
        assert abs(part.mean() - mean - 0.5772) < 0.04 and abs(part.std() - math.pi / math.sqrt(6)) < 0.04


def test_equal_rows_share_their_fate(spark):
    docs = [(1, "a good text about trees"), (1, "a good text about trees"), (2, "buy buy buy $$$"), (3, "a good text about rivers"), (4, "$$$ buy now"), (None, None), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(1, 5)], "doc_id bigint, good int")
    model = importance.Resampler(frame, labels, F.col("good") == 1)
    kept = model.weighed(frame).select("doc_id", model.kept().alias("kept")).collect()
    assert len(kept) == len(docs)
    for key in (1, None):
        assert len({r.kept for r in kept if r.doc_id == key}) == 1
