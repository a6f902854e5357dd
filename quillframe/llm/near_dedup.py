"""Near-duplicate groups: b-bit MinHash signatures joined by a multi-index Hamming search.

A document's signature is ``hashes`` symbols of ``BITS`` bits. It is cut into
``chunks`` chunks. Two signatures that differ in at most
``chunks * (errors + 1) - 1`` symbols have, by the pigeonhole principle, a chunk
with at most ``errors`` differing symbols; with ``errors`` of 1 every chunk is
listed once for each symbol left out, so such a pair meets under an equal key
for certain. Pairs that meet are compared by signature and confirmed on the
full shingle sets.

Equal sets are one class from the start, and classes that are linked already are
not compared again: the members of a key are first confirmed against one hub,
then each against the closest member of another component, and only what is
still apart after that against all close members of other components. In that
last step no pairs are listed: the members that have an open pair are gathered
by key and blocks of a key, with their full sets, and confirmed there. A pair
that shares several keys is worked on under the first of them only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import arrow_bounded
from .components import components

BITS = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 4096


@dataclass(frozen=True)
class DedupSettings:
    """Links: ``percent`` of the union of distinct ``shingle``-word shingles in common.

    With the defaults a pair at the very threshold of 80 % is missed with a
    probability below one in 500,000; closer pairs far more rarely.
    ``far`` is the signature distance above which a pair that met is not confirmed
    (above the distance that is guaranteed to be found).
    """

    shingle: int = 5
    percent: int = 80
    chunks: int = 10
    chunk_symbols: int = 5
    errors: int = 1
    far: int = 25

    @property
    def hashes(self) -> int:
        return self.chunks * self.chunk_symbols

    @property
    def guaranteed(self) -> int:
        return self.chunks * (self.errors + 1) - 1


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; A-Z lower-cased, words split at ASCII blanks.

    With fewer words than ``size`` the whole sequence is the only shingle; without words there is none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    acc = np.full(n, size, np.uint64)
    for i in range(size):
        acc = acc * _MIX + word[i : i + n]
        acc ^= acc >> np.uint64(29)
    return np.unique(acc * np.uint64(0xBF58476D1CE4E5B9))


def _multipliers(n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"minhash", seed=i) | 1 for i in range(n)], np.uint64)


def signature(values: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """``BITS`` bits of each minimum; long sets are read in blocks."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), _BLOCK):
        np.minimum(least, (values[i : i + _BLOCK, None] * multipliers).min(axis=0), out=least)
    return ((least ^ (least >> np.uint64(31))) * _MIX >> np.uint64(64 - BITS)).astype(np.uint16)


def sketch(df: DataFrame, id_col: str, text: str, settings: DedupSettings) -> DataFrame:
    """(doc_id, n_shingles, set_hash, sig) per row; set_hash and sig are null without words."""
    arrow_bounded(df.sparkSession)
    size, multipliers = settings.shingle, _multipliers(settings.hashes)

    def run(batches):
        for batch in batches:
            n, hashed, sigs = [], [], []
            for value in batch.column("text"):
                s = shingles(value.as_py(), size)
                n.append(len(s))
                hashed.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, multipliers).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashed, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "set_hash", "sig"]
            )

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_hash binary, sig binary")


def index_keys(classes: DataFrame, settings: DedupSettings) -> DataFrame:
    """(key, slot, id): for each chunk and each choice of ``errors`` (0 or 1) left-out symbols a 64-bit key; slot numbers the choice."""
    width, chunks, errors = settings.chunk_symbols, settings.chunks, settings.errors
    kept = [[s for s in range(width) if s != out] for out in range(width)] if errors else [list(range(width))]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(ids), chunks, width)
            for c in range(chunks):
                for out, symbols in enumerate(kept):
                    key = np.full(len(ids), c * width + out + 1, np.uint64)
                    for s in symbols:
                        key = (key ^ (key >> np.uint64(32))) * _MIX + sig[:, c, s]
                    slot = np.full(len(ids), c * width + out, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(slot), pa.array(ids)], ["key", "slot", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key bigint, slot int, id bigint")


def _close(pairs: DataFrame, classes: DataFrame, far: int) -> DataFrame:
    """Pairs whose signatures differ in at most ``far`` symbols."""
    sig = classes.select("id", "sig")
    both = pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            near = pa.array((one != two).sum(axis=1) <= far)
            yield batch.select(["a", "b"]).filter(near)

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets share at least ``percent`` of their union."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("xa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("xb")), "b")

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[place] == x).sum())
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def _sets(df: DataFrame, id_col: str, text: str, wanted: DataFrame, size: int) -> DataFrame:
    """(id, set) of the wanted classes, made from the text of a document that has the class's set."""
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text"))
    picked = rows.join(wanted.select("id", "doc", "set_hash").hint("shuffle_hash"), "doc")

    def run(batches):
        for batch in batches:
            ids, sets = [], []
            for key, value, hashed in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("set_hash").to_pylist()):
                s = shingles(value.as_py(), size).tobytes()
                if xxhash.xxh3_128_digest(s) == hashed:
                    ids.append(key)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "set"])

    # Rows of one document id that all have the class's set give it once.
    return picked.select("id", "text", "set_hash").mapInArrow(run, "id bigint, set binary").dropDuplicates(["id"])


def _hubs(shared: DataFrame) -> DataFrame:
    """Each member of a key with the key's hub, the member that meets most others over all its keys.

    The centre of a family is the hub of nearly all keys of its members, so a
    member has few hubs however many keys it shares.
    """
    weight = shared.groupBy("id").agg(F.sum("n").alias("w"))
    hub = shared.join(weight, "id").groupBy("key").agg(F.max_by("id", "w").alias("b"))
    return shared.join(hub, "key").where("id <> b").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


#: Members of a key that are compared in one task at a time; larger keys are cut into blocks, and each pair of blocks is a task's work.
BLOCK_MEMBERS = 4096
#: The same where the full sets are at hand, and the bytes of sets of a block.
BLOCK_SETS = 1024
BLOCK_BYTES = 16 << 20


def _blocked(rows: DataFrame, blocks: Column) -> DataFrame:
    """The rows of each key dealt to pairs of blocks (i, j) by their id; every two rows of a key meet in one pair of blocks."""
    sizes = rows.groupBy("key").agg(F.greatest(F.lit(1), F.ceil(blocks).cast("int")).alias("blocks"))
    dealt = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other")


def _by_group(dealt: DataFrame, work, schema: str) -> DataFrame:
    """``work(key, columns, group)`` for the rows of every (key, i, j), sorted by component; it gives record batches."""
    cut = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "component")
    numbers = [c for c, kind in dealt.dtypes if kind != "binary"]

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = yield from groups(table, False)
        if held is not None:
            yield from groups(held, True)

    def groups(table, last):
        """Work on all groups but the last, which may go on in the next batch; returns its rows."""
        if not table.num_rows:
            return None
        columns = {c: table.column(c).to_numpy() for c in numbers}
        change = (np.diff(columns["key"]) != 0) | (np.diff(columns["i"]) != 0) | (np.diff(columns["j"]) != 0)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        ends = np.concatenate([starts[1:], [table.num_rows]])
        for s, e in zip(starts, ends) if last else zip(starts[:-1], ends[:-1]):
            group = {c: values[s:e] for c, values in columns.items()}
            yield from work((columns["key"][s], columns["i"][s], columns["j"][s]), group, table.slice(s, e - s))
        return None if last else table.slice(starts[-1])

    return cut.mapInArrow(run, schema)


def _symbols(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(group.num_rows, -1)


def _meetings(key, columns, sig):
    """(member, others, differs) for each member of a group and the members of other components that it has not met yet.

    Members of one component, and in a pair of blocks those of one block, do not
    meet; a member meets those of components that have at least as many members
    here. ``differs`` has a row per other member and a column per symbol.
    """
    comps, own = columns["component"], columns["own"]
    cuts = np.flatnonzero(np.diff(comps)) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(comps)]])
    order = np.argsort(ends - starts, kind="stable")
    place = np.concatenate([np.arange(starts[r], ends[r]) for r in order])
    stop = 0
    for size in (ends - starts)[order]:
        start, stop = stop, stop + size
        later = place[stop:]
        for at in place[start:stop]:
            others = later if key[1] == key[2] else later[own[later] != own[at]]
            if len(others):
                yield at, others, sig[others] != sig[at]


def _nearest(apart: DataFrame, classes: DataFrame, far: int) -> DataFrame:
    """Pairs (a, b): each member's closest one of another component of a key, if within ``far`` symbols."""
    rows = apart.select("key", "component", "id")
    dealt = _blocked(rows, F.count("*") / BLOCK_MEMBERS).join(classes.select("id", "sig"), "id")

    def work(key, columns, group):
        ids, pairs = columns["id"], set()
        for at, others, differs in _meetings(key, columns, _symbols(group)):
            distance = differs.sum(axis=1)
            k = int(distance.argmin())
            if distance[k] <= far:
                pairs.add((min(ids[at], ids[others[k]]), max(ids[at], ids[others[k]])))
        yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in pairs], pa.int64()) for n in (0, 1)], ["a", "b"])

    return _by_group(dealt, work, "a bigint, b bigint").distinct()


def _open(at, others, differs, columns, settings: DedupSettings) -> np.ndarray:
    """Which of ``others`` may be linked with ``at`` and first meet it under this group's slot, as places in ``others``.

    A pair that shares several keys is so worked on under one of them. Sets of
    too different sizes cannot be linked.
    """
    n, slot = columns["n"], columns["slot"]
    small, large = np.minimum(n[others], n[at]), np.maximum(n[others], n[at])
    near = np.flatnonzero((differs.sum(axis=1) <= settings.far) & (100 * small >= settings.percent * large))
    chunked = differs[near].reshape(len(near), settings.chunks, settings.chunk_symbols)
    equal = chunked.sum(axis=2) <= settings.errors
    chunk = equal.argmax(axis=1)
    out = chunked[np.arange(len(near)), chunk].argmax(axis=1)
    return near[equal.any(axis=1) & (chunk * settings.chunk_symbols + out == slot[at])]


def _unsettled(apart: DataFrame, classes: DataFrame, settings: DedupSettings) -> DataFrame:
    """(key, slot, component, id) of the members that have an open pair in the key: rows of members, not of pairs."""
    dealt = _blocked(apart, F.count("*") / BLOCK_MEMBERS).join(classes.select("id", "n", "sig"), "id")

    def work(key, columns, group):
        marked = np.zeros(group.num_rows, bool)
        for at, others, differs in _meetings(key, columns, _symbols(group)):
            found = _open(at, others, differs, columns, settings)
            if len(found):
                marked[at] = True
                marked[others[found]] = True
        chosen = group.select(["key", "slot", "component", "id"]).filter(pa.array(marked))
        yield from chosen.to_batches()

    return _by_group(dealt, work, "key bigint, slot int, component bigint, id bigint").distinct()


def _settled(unsettled: DataFrame, classes: DataFrame, sets: DataFrame, settings: DedupSettings) -> DataFrame:
    """Links (a, b) among the open pairs, confirmed on full sets inside the group; a group gives only links that join components."""
    members = unsettled.join(classes.select("id", "n", "sig"), "id")
    blocks = F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") * 8 / BLOCK_BYTES)
    dealt = _blocked(members, blocks).join(sets, "id")

    def work(key, columns, group):
        ids, joined = columns["id"], columns["component"].copy()
        held = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("set").combine_chunks()]
        sizes = np.array([len(x) for x in held])
        links = []
        for at, others, differs in _meetings(key, columns, _symbols(group)):
            found = others[_open(at, others, differs, columns, settings)]
            found = found[joined[found] != joined[at]]
            if not len(found):
                continue
            mine, theirs = held[at], np.concatenate([held[k] for k in found])
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            common = np.add.reduceat(mine[place] == theirs, np.cumsum(sizes[found]) - sizes[found], dtype=np.int64)
            for other in found[100 * common >= settings.percent * (len(mine) + sizes[found] - common)]:
                if joined[other] != joined[at]:
                    joined[joined == joined[other]] = joined[at]
                    links.append((ids[at], ids[other]))
        yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in links], pa.int64()) for n in (0, 1)], ["a", "b"])

    return _by_group(dealt, work, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", settings: DedupSettings = DedupSettings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row.

    ``component_id`` is the smallest id that links lead to, ``kept`` marks the
    row that has it. Texts without words are linked with nothing. Rows with a
    null id are linked with nothing, their component is null and they are kept.
    Rows that share an id are one document if their sets are equal; otherwise
    each links by its own set, and both carry the smaller of their components.
    """
    sketches = stored(sketch(df, id_col, text, settings), "sketches")
    named = sketches.where("doc_id IS NOT NULL AND set_hash IS NOT NULL")
    firsts = named.groupBy("set_hash").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("f"))
    classes = stored(firsts.select(F.monotonically_increasing_id().alias("id"), F.col("f.doc_id").alias("doc"), "set_hash", F.col("f.n_shingles").alias("n"), "f.sig"), "classes")
    links = _links(df, id_col, text, classes, settings)
    # A repeated id with several sets ties their classes.
    repeated = named.groupBy("doc_id").agg(F.min("set_hash").alias("low"), F.max("set_hash").alias("high")).where("low <> high")
    hashes = classes.select("set_hash", "id")
    tied = (
        named.join(repeated.select("doc_id", "low"), "doc_id").select("set_hash", "low").distinct().join(hashes, "set_hash")
        .join(hashes.select(F.col("set_hash").alias("low"), F.col("id").alias("b")), "low").select(F.col("id").alias("a"), "b")
    )
    found = components(links.unionAll(tied.where("a <> b")))
    least = found.join(classes.select("id", "doc"), "id").groupBy("component").agg(F.min("doc").alias("least"))
    ends = classes.join(found.join(least, "component").select("id", "least"), "id", "left").select("set_hash", F.coalesce("least", "doc").alias("least"))
    rows = sketches.select("doc_id", "n_shingles", "set_hash").join(ends, "set_hash", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _links(df: DataFrame, id_col: str, text: str, classes: DataFrame, settings: DedupSettings) -> DataFrame:
    """Confirmed links (a, b) that connect all classes that links connect."""
    keys = index_keys(classes, settings)
    many = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(keys.join(many, "key"), "shared-keys")
    wanted = classes.join(shared.select("id").distinct(), "id", "left_semi")
    sets = stored(_sets(df, id_col, text, wanted, settings.shingle), "sets")
    tried = stored(_hubs(shared), "pairs")
    links = stored(_confirmed(_close(tried, classes, settings.far), sets, settings.percent), "links")
    # What the hubs left apart: twice each member's closest pair of every key, then all that are close enough.
    for _ in range(2):
        apart = stored(_apart(shared, components(links)), "apart")
        pairs = stored(_nearest(apart, classes, settings.far).join(tried, ["a", "b"], "left_anti"), "pairs")
        links = links.unionAll(stored(_confirmed(pairs, sets, settings.percent), "links"))
        tried = tried.unionAll(pairs)
    apart = stored(_apart(shared, components(links)), "apart")
    unsettled = stored(_unsettled(apart, classes, settings), "unsettled")
    return links.unionAll(stored(_settled(unsettled, classes, sets, settings), "links"))


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, slot, id, component) of the keys whose members are in more than one component."""
    placed = shared.join(found, "id", "left").select("key", "slot", "id", F.coalesce("component", "id").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return placed.join(several, "key", "left_semi")
