"""Quality classifier by importance resampling.

Two generative models over hashed word and punctuation n-grams are counted: one
of target texts (documents labelled good), one of all texts. A document's log
weight is the sum over its n-grams of the log ratio of the two. Sums grow with
the text, so the draw goes by the mean per n-gram times ``sharpness``, one number
for all texts. Resampling without replacement adds Gumbel noise to that and keeps
the k greatest; k is how many documents weigh at least the cut per n-gram. The
chance that one of two texts is drawn first is thus the softmax of the two.

A few words can make a text unfit that otherwise reads like a target (abuse in
sound prose), which no mean shows. So a text's ``doubt`` is the greatest log
ratio, over its words, of the shares of non-targets and of targets that hold
the word; texts above a second cut are not drawn.

Both cuts are chosen on labelled rows held out of the fit: where the share of
non-targets rejected, less ``worth`` times the share of targets lost, is
greatest. The rule compares shares, so it is the same for tables of any size.

The labelled rows are a sample of at most ``labelled`` rows (smallest hashes of
the id), targets and others; everything else reads all documents. The models
have ``2**bits`` and ``2**word_bits`` buckets whatever the corpus, and only
those and the held-out rows' weights reach the driver.

Null and empty texts have no n-grams and weigh 0. Rows with a null id are never
labelled. If no target is labelled nothing is known about quality and every
document is kept; if no other row is, all but ``lose`` of the held-out targets
reach the cut and there is no doubt. Repeated rows get equal noise and share
their fate; where more rows than asked for tie at the cut, all of them stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import arrow_bounded, ddl, renamed, row_uniform

_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_MARK = bytes(c if 33 <= c <= 126 and not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122) else 32 for c in range(256))


@dataclass(frozen=True)
class ImportanceSettings:
    bits: int = 14
    word_bits: int = 18
    labelled: int = 20_000
    worth: float = 10.0
    lose: float = 0.001
    sharpness: float = 100.0
    seed: int = 11


def _mixed(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unigrams and of the bigrams; their first bits are the bucket."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    both = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * _MIX + h[1:]
    return h * _MIX, both * _MIX


def features(text: str | None, settings: ImportanceSettings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's word and punctuation unigrams and bigrams, and the finer buckets of its words."""
    raw = (text or "").encode()
    words = _mixed(raw.translate(_WORD).split())
    grams = np.concatenate([*words, *_mixed(raw.translate(_MARK).split())]) >> np.uint64(64 - settings.bits)
    return grams.astype(np.int64), (words[0] >> np.uint64(64 - settings.word_bits)).astype(np.int64)


def label_sample(labels: DataFrame, target: Column, settings: ImportanceSettings, id_col: str = "doc_id") -> DataFrame:
    """(_label_id, _label) with _label 0 fit target, 1 held-out target, 2 fit non-target, 3 held-out non-target; at most ``labelled`` rows.

    An id that is labelled twice is a target only if both rows say so; without a label it is neither.
    """
    each = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_label_id")).agg(F.bool_and(target).alias("t"))
    order = F.xxhash64(F.lit(settings.seed), "_label_id")
    picked = each.where("t IS NOT NULL").orderBy(order, "_label_id").limit(settings.labelled)
    held = F.pmod(F.xxhash64(F.lit(settings.seed + 1), "_label_id"), F.lit(2))
    return picked.select("_label_id", (held + F.when(F.col("t"), 0).otherwise(2)).cast("int").alias("_label"))


def fit(labelled: DataFrame, text: str, settings: ImportanceSettings) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio per bucket of targets to all texts, and per word bucket of the non-targets to the targets that hold it; one is added to every count.

    Buckets of words follow those of the n-grams; the last two count the fitted non-targets and targets.
    """
    size = 1 << settings.bits
    total = size + (1 << settings.word_bits)

    def count(batches):
        raw, target = np.zeros(total + 1, np.int64), np.zeros(total + 1, np.int64)
        for batch in batches:
            for value, label in zip(batch.column("text"), batch.column("_label").to_pylist()):
                grams, words = features(value.as_py(), settings)
                got = np.bincount(grams, minlength=size)
                raw[:size] += got
                if label == 0:
                    target[:size] += got
                if label in (0, 2):
                    held = target if label == 0 else raw
                    held[size + np.unique(words)] += 1
                    held[total] += 1
        at = np.flatnonzero(raw | target)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "n", "t"])

    rows = labelled.select(F.col(f"`{text}`").alias("text"), "_label").mapInArrow(count, "bucket bigint, n bigint, t bigint")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    raw, target = np.ones(total + 1), np.ones(total + 1)
    at = found.column("bucket").to_numpy()
    raw[at] += found.column("n").to_numpy()
    target[at] += found.column("t").to_numpy()
    ratio = np.log(target[:size] / target[:size].sum()) - np.log(raw[:size] / raw[:size].sum())
    share = lambda counts: np.log(counts[size:total] / (counts[total] + 1))
    return ratio, (share(raw) - share(target)).astype(np.float32)


def weigh(df: DataFrame, ratio: np.ndarray, doubts: np.ndarray, text: str, id_col: str, settings: ImportanceSettings) -> DataFrame:
    """Add ``n_features``, ``log_weight``, ``doubt``, ``per_feature`` (the mean weight) and ``perturbed`` (that, sharpened, with Gumbel noise) to every row."""
    rows = renamed(df, ["n_features", "log_weight", "doubt", "per_feature", "perturbed"])
    columns = rows.columns

    def run(batches):
        for batch in batches:
            counts, weights, worst = [], [], []
            for value in batch.column(text):
                grams, words = features(value.as_py(), settings)
                counts.append(len(grams))
                weights.append(float(ratio[grams].sum()))
                worst.append(float(doubts[words].max()) if len(words) else None)
            made = [pa.array(counts, pa.int64()), pa.array(weights, pa.float64()), pa.array(worst, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*columns, "n_features", "log_weight", "doubt"])

    noise = -F.log(-F.log(row_uniform(settings.seed + 2, F.col(f"`{id_col}`").cast("bigint"))))
    mean = F.col("log_weight") / F.greatest("n_features", F.lit(1))
    weighed = rows.mapInArrow(run, f"{ddl(rows)}, n_features bigint, log_weight double, doubt double")
    return weighed.withColumns({"per_feature": mean, "perturbed": settings.sharpness * mean + noise})


def best_cut(targets: np.ndarray, others: np.ndarray, worth: float) -> float:
    """The value from which on to keep: the share of others below it less ``worth`` times the share of targets below it is greatest."""
    at = np.unique(np.concatenate([targets, others]))
    below = lambda values: np.searchsorted(np.sort(values), at) / len(values)
    return float(at[np.argmax(below(others) - worth * below(targets))])


def kth_greatest(df: DataFrame, column: str, k: int, most: int = 10_000) -> float | None:
    """The k-th greatest value of a column; null for k below 1 or an empty frame.

    Counts 1,024 ranges of equal width, goes on in the range that holds the
    place and takes its values to the driver only when they are at most ``most``.
    """
    if k < 1:
        return None
    value = df.select(F.col(column).alias("v")).where("v IS NOT NULL")
    while True:
        low, high, n = value.agg(F.min("v"), F.max("v"), F.count("v")).first()
        if not n:
            return None
        k = min(k, n)
        if low == high:
            return low
        if n <= most:
            return sorted((r.v for r in value.collect()), reverse=True)[k - 1]
        place = F.least(F.floor((F.col("v") - low) / (high - low) * 1024), F.lit(1023))
        counts = dict(value.groupBy(place.alias("p")).count().collect())
        for p in sorted(counts, reverse=True):
            if k <= counts[p]:
                break
            k -= counts[p]
        if len(counts) == 1:
            return low
        value = value.where(place == p)


class Resampler:
    """Fitted models with the cut of a corpus: ``weighed`` rows are kept from ``threshold`` on (null keeps all)."""

    def __init__(self, df: DataFrame, labels: DataFrame, target: Column, id_col: str = "doc_id", text: str = "text", settings: ImportanceSettings = ImportanceSettings()):
        arrow_bounded(df.sparkSession)
        self.id_col, self.text, self.settings, self.threshold, self.most_doubt = id_col, text, settings, None, None
        # At most `labelled` rows of two numbers, so sending them to every task is bounded.
        sample = F.broadcast(stored(label_sample(labels, target, settings), "label-sample"))
        key = df.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias(text)).alias("d")
        labelled = key.join(sample, F.col("_id") == F.col("_label_id"), "left").drop("_label_id")
        self.ratio, self.doubts = fit(labelled, text, settings)
        scores = weigh(labelled, self.ratio, self.doubts, text, "_id", settings).drop(text)
        self.scores = stored(scores, "importance")
        # One row for each id of the sample, whatever the number of rows that repeat it.
        held = self.scores.where("_label IN (1, 3)").groupBy("_id", "_label").agg(F.min("per_feature").alias("w"), F.max("doubt").alias("d")).collect()
        targets, others = ([r for r in held if r["_label"] == label] for label in (1, 3))
        if not targets:
            return
        values = lambda rows, name: np.array([r[name] for r in rows if r[name] is not None], float)
        cut = float(np.quantile(values(targets, "w"), settings.lose))
        if others:
            cut = best_cut(values(targets, "w"), values(others, "w"), settings.worth)
            good, bad = -values(targets, "d"), -values(others, "d")
            if len(good) and len(bad):
                self.most_doubt = -best_cut(good, bad, settings.worth)
        drawn = self.scores.where(self._undoubted())
        self.k = drawn.where(F.col("per_feature") >= cut).count()
        self.threshold = kth_greatest(drawn, "perturbed", self.k)

    def _undoubted(self) -> Column:
        return F.lit(True) if self.most_doubt is None else F.coalesce(F.col("doubt") <= self.most_doubt, F.lit(True))

    def kept(self) -> Column:
        return F.lit(True) if self.threshold is None else self._undoubted() & (F.col("perturbed") >= self.threshold)

    def weighed(self, df: DataFrame) -> DataFrame:
        return weigh(df, self.ratio, self.doubts, self.text, self.id_col, self.settings)
