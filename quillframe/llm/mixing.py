"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source's documents are shuffled by a digest of their id and queued, as often
as the source may be repeated. A long document is queued in packets of at most a
thousandth of its source's target. A packet's virtual finish time is the words of its
source up to its end, divided by the source's target; all packets are sorted by it
over all sources, and the sorted queue is cut at the total budget. So every source
ends within a packet or two of its target.

All running totals are made the same way (``running``): the rows are sorted by range
into a written table, a range's rows are summed in their own task, and only the
totals of the ranges are added up in one place. A source with most of the rows
therefore fills many ranges and no task.

A null text has no words. A null source is a source of its own, sorted last. Repeated
ids and repeated rows are documents of their own. Documents without words take nothing.
With no words at all, every target is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: A source's target is served in at least so many packets where its documents can be cut.
PACKETS = 1000


@dataclass(frozen=True)
class MixSettings:
    """``weights`` go round over the sources in order; shares in percent of all words; a document is taken at most ``repeats`` times."""

    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    repeats: int = 2


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def running(df: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including this one, in a total order of the rows."""
    placed = df.withColumn("_v", value).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    # Written once, so that a retried task cannot deal the rows anew.
    placed = stored(placed, "mix-range")
    sums = placed.groupBy("_range").agg(F.sum("_v").alias("_sum"))
    # One row a range: as many as a shuffle has partitions.
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = F.sum("_v").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("_in", inside).join(before, "_range").withColumn(name, F.col("_in") + F.col("_before")).drop("_v", "_range", "_in", "_before")


def targets(sizes: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """(source, source_size, weight, start, target) of all sources; ``start`` is the size of all sources before it.

    Shares go by weight; who reaches ``repeats`` times the own size stops there, and the
    rest is shared anew. Filled up in order of size per weight, that is one pass: a
    source is stopped if its limit lies below the level that those after it would get.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = [F.col("source").asc_nulls_last()]
    numbered = running(running(per, by_name, F.lit(1).cast("bigint"), "_at"), by_name, F.col("source_size"), "_through")
    turn = F.array(*[F.lit(w).cast("bigint") for w in settings.weights])
    numbered = numbered.select(
        "source", "source_size", F.get(turn, ((F.col("_at") - 1) % len(settings.weights)).cast("int")).alias("weight"), (F.col("_through") - F.col("source_size")).alias("start")
    )
    numbered = stored(numbered, "mix-sources")
    totals = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weights")).first()
    # Hundredths of words, so that all sums stay whole.
    budget = totals.words * settings.percent
    ratio = (settings.repeats * F.col("source_size")).cast("double") / F.col("weight")
    fill = [ratio.asc(), F.col("source").asc_nulls_last()]
    filled = running(running(numbered, fill, settings.repeats * F.col("source_size"), "_limits"), fill, F.col("weight"), "_weights")
    # Stopped: at this source's own level, all before it at their limits and all from it on by weight, there is still enough.
    limit = settings.repeats * F.col("source_size")
    exact = lambda c: c.cast("decimal(38,0)")
    need = exact(F.col("_limits") - limit) * F.col("weight") + exact(limit) * (F.lit(totals.weights) - F.col("_weights") + F.col("weight"))
    marked = stored(filled.withColumn("_stopped", 100 * need <= exact(F.lit(budget)) * F.col("weight")).drop("_limits", "_weights"), "mix-targets")
    free = marked.agg(
        F.coalesce(F.sum(F.when(F.col("_stopped"), limit)), F.lit(0)).alias("limits"), F.coalesce(F.sum(F.when(~F.col("_stopped"), F.col("weight"))), F.lit(0)).alias("weights")
    ).first()
    share = (F.lit(budget - 100 * free.limits) * F.col("weight")).cast("double") / F.lit(100.0 * max(free.weights, 1))
    return marked.withColumn("target", F.when(F.col("_stopped"), limit.cast("double")).otherwise(share)).drop("_stopped")


def queue(docs: DataFrame, sources: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """(row, words, finish, key) of all packets that start before their source's target and two packets more."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    keyed = docs.where("size > 0").withColumn("key", digest)
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_hash"), F.col("row")]
    placed = running(keyed, order, F.col("size"), "through")
    named = sources.select(F.col("source").alias("s"), "start", "source_size", "target")
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("s"))).withColumn("first", F.col("through") - F.col("size") - F.col("start"))
    most = placed.withColumn("packet", F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("target") / PACKETS)))
    turns = most.withColumn("turn", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(settings.repeats)])))
    turns = turns.withColumn("first", F.col("first") + F.col("turn") * F.col("source_size"))
    # Packets of a document: up to its end, or to where its source is surely served.
    reach = F.least(F.col("size"), (F.ceil("target") + 2 * F.col("packet") - F.col("first")).cast("bigint"))
    cut = turns.withColumn("reach", reach).where("reach > 0").withColumn("offset", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("reach") - 1, F.col("packet"))))
    words = F.least(F.col("packet"), F.col("size") - F.col("offset"))
    finish = (F.col("first") + F.col("offset") + words).cast("double") / F.col("target")
    return cut.select("row", "source", "doc_id", "turn", "offset", words.alias("words"), finish.alias("finish"), "key")


def mixed(packets: DataFrame, budget: int) -> DataFrame:
    """The packets in mixing order, cut at ``budget`` words; the last one is cut to fit."""
    order = [F.col("finish"), F.col("key"), F.col("source").asc_nulls_last(), F.col("row"), F.col("turn"), F.col("offset")]
    sorted_ = running(packets, order, F.col("words"), "through")
    before = F.col("through") - F.col("words")
    return sorted_.where(before < budget).withColumn("words", F.least(F.col("words"), F.lit(budget) - before))


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", settings: MixSettings = MixSettings()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row: how many of its words the mix takes.

    Only sizes are sorted, never texts. The same rows give the same mix on any partitioning.
    """
    named = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"))
    docs = named.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    docs = stored(docs, "mix-sizes")
    sources = stored(targets(docs, settings), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    taken = mixed(queue(docs, sources, settings), total * settings.percent // 100).groupBy("row").agg(F.sum("words").alias("taken"))
    named = sources.select(F.col("source").alias("s"), "source_size", "target")
    rows = docs.join(named, F.col("source").eqNullSafe(F.col("s"))).join(taken, "row", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
