"""WARC archives with revisit records, and a two-level capture index to read them back.

Archives are written by Spark's text writer, one record a row with the record
separator as line separator, so files are committed like any other output.
The index sorts captures by reversed-host url keys into compressed blocks; the
directory holds the first and last key of every block. A look-up finds blocks
by binary search in the directory, opens those only, and reads the records by
their byte ranges.

A null payload is empty, a null url has no target line and an empty key.
Records with a null id revisit the record with an id that has their payload,
and are responses where there is none; repeated rows of one id are all of its kind.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, stored
from .common import arrow_bounded

SEPARATOR = "\r\n\r\n"
BLOCK_LINES = 3000
#: Directory rows that may be sent to every task; beyond, blocks are found by a join.
DIRECTORY_ROWS = 100_000
#: Records a file holds at most, so that the index scan has files for all tasks; it streams them, whatever their size.
FILE_RECORDS = 2000
#: Payloads that occur more than once and may be sent to every task, a hundred bytes each; beyond, bodies meet them in a shuffle.
REPEATED_PAYLOADS = 500_000
#: Bytes the index scan reads at a time.
CHUNK = 1 << 20


def base32(hexed: Column) -> Column:
    """Forty hexadecimal digits as 32 letters of base 32: five digits are four letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for i in range(8):
        value = F.conv(F.substring(hexed, i * 5 + 1, 5), 16, 10).cast("int")
        parts += [F.substr(alphabet, F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


def write_archives(df: DataFrame, path: str, id_col: str, url: str, payload: str, date: str = "2000-01-01T00:00:00Z", min_bytes: int = 0) -> None:
    """Write a record per row; of equal payloads of at least ``min_bytes`` the smallest id's is stored, others refer to it."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url}`").alias("url"), body.alias("body"), F.sha1(body.cast("binary")).alias("digest"))
    sized = rows.withColumn("bytes", F.octet_length("body").cast("bigint"))
    # Payloads with one page are responses; only the others are looked up, so bodies are not shuffled for their sake.
    many = sized.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    many = stored(many, "payloads")
    # The hottest payload's pages are split by the adaptive join where it has to shuffle.
    joined = sized.join(F.broadcast(many) if many.count() <= REPEATED_PAYLOADS else many.hint("shuffle_hash"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    joined = joined.withColumn("block", block)
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), "").otherwise(line("WARC-Target-URI", target)),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    joined.select(record.alias("value")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def url_key(url: str | None) -> str:
    """Reversed host, then the rest: com,example,www)/path?query; control characters and blanks are escaped."""
    host, rest = re.match(r"([^/?#]*)(.*)", (url or "").partition("://")[2], re.DOTALL).groups()
    if not host:
        return quote(url or "", safe="!#$&'()*+,/:;=?@[]~%")
    return ",".join(reversed(host.lower().split("."))) + ")" + quote(rest if rest.startswith("/") else "/" + rest, safe="!#$&'()*+,/:;=?@[]~%")


def _header(raw: bytes) -> dict[str, str]:
    """Fields by name; only blanks and tabs are no part of a value."""
    return {k.strip().lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in raw.decode("utf-8", "replace").split("\r\n")[1:])}


def _captures(stream) -> Iterator[tuple[str, int, int]]:
    """(key, offset, length) of every record of a stream; bodies are skipped, a chunk is held at a time."""
    mark = SEPARATOR.encode()
    held, base, at = stream.read(CHUNK), 0, 0
    while True:
        if at > len(held):
            # The body went on beyond the chunk.
            base += at
            stream.seek(base)
            held, at = stream.read(CHUNK), 0
        while (end := held.find(mark, at)) < 0:
            more = stream.read(CHUNK)
            if not more:
                if held[at:]:
                    raise ValueError(f"no record header ends after byte {base + at}")
                return
            held, base, at = held[at:] + more, base + at, 0
        head = _header(held[at:end])
        stop = end + len(mark) + int(head["content-length"])
        while stop + len(mark) > len(held) and stop - len(held) < CHUNK and (more := stream.read(CHUNK)):
            held += more
        if stop <= len(held) and held[stop : stop + len(mark)] != mark:
            raise ValueError(f"no record ends at byte {base + stop}")
        yield url_key(head.get("warc-target-uri")), base + at, stop - at
        at = stop + len(mark)


class CaptureIndex:
    """``blocks`` (block, first_key, last_key, n, lines compressed) and its sparse ``directory`` (block, first_key, last_key)."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        self.directory = blocks.select("block", "first_key", "last_key")


def build_index(spark: SparkSession, path: str) -> CaptureIndex:
    """Scan the archives of a folder and write the index to the shared folder."""
    arrow_bounded(spark)
    # Without its content column the file source gives names only.
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path")

    def scan(batches):
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with _open(name) as stream:
                    records = _captures(stream)
                    while rows := list(islice(records, 10_000)):
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([name] * len(rows)), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))], ["key", "file", "offset", "length"])

    captures = stored(files.mapInArrow(scan, "key string, file string, offset bigint, length bigint"), "captures")
    # Ranges are cut by place as well, so that the captures of one url may fill several partitions.
    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def pack(batches):
        from pyspark import TaskContext

        part, n, held = TaskContext.get().partitionId(), 0, []

        def block(lines):
            text = "\n".join("\t".join(map(str, r)) for r in lines)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n]), pa.array([lines[0][0]]), pa.array([lines[-1][0]]), pa.array([len(lines)], pa.int64()), pa.array([zlib.compress(text.encode())], pa.binary())],
                ["block", "first_key", "last_key", "n", "lines"],
            )

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                held, n = held[BLOCK_LINES:], n + 1
        if held:
            yield block(held)

    return CaptureIndex(stored(ordered.mapInArrow(pack, "block bigint, first_key string, last_key string, n bigint, lines binary"), "capture-index"))


def _locate(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """(key, block) for every block whose key range holds the key."""
    if directory.count() > DIRECTORY_ROWS:
        # The directory of a directory: ranges of 4,096 blocks, searched in the same way, then their blocks by a join.
        coarse = directory.groupBy(F.shiftright("block", 12).alias("block")).agg(F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
        near = _locate(keys, stored(coarse, "directory")).withColumnRenamed("block", "range")
        fine = directory.withColumn("range", F.shiftright("block", 12))
        return near.join(fine, "range").where("first_key <= key AND key <= last_key").select("key", "block")
    rows = sorted(tuple(r) for r in directory.select("first_key", "last_key", "block").collect())
    first, last, block = ([r[i] for r in rows] for i in range(3))

    def search(batches):
        for batch in batches:
            found = []
            for key in batch.column("key").to_pylist():
                at = bisect.bisect_right(first, key) - 1
                while at >= 0 and last[at] >= key:
                    found.append((key, block[at]))
                    at -= 1
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], ["key", "block"])

    return keys.mapInArrow(search, "key string, block bigint")


def _open(path: str):
    """A seekable stream of a file that all executors can reach."""
    if path.startswith("file:"):
        return open(re.sub("^file:/*", "/", path), "rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


RECORD_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _record(raw: bytes, with_payload: bool) -> tuple:
    head, _, block = raw.partition(SEPARATOR.encode())
    http, _, payload = block.partition(SEPARATOR.encode())
    fields, inner = _header(head), _header(http)
    ident = lambda s: None if s is None or s.endswith(":null>") else int(s[len("<urn:capture:") : -1])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != int(inner["content-length"]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return (
        ident(fields["warc-record-id"]), fields.get("warc-target-uri"), int(inner["content-length"]), digest, kind,
        ident(fields.get("warc-refers-to")), payload if with_payload and kind == "response" else None,
    )


def lookup(index: CaptureIndex, urls: DataFrame, with_payload: bool = False) -> DataFrame:
    """All captures of the urls (first column of the frame), read from the archives by byte range and checked."""

    def to_key(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])

    keys = urls.mapInArrow(to_key, "key string").distinct()
    asked = _locate(keys, index.directory)
    blocks = index.blocks.join(asked.select("block").distinct(), "block", "left_semi").select("lines")

    def unpack(batches):
        for batch in batches:
            for lines in batch.column("lines").to_pylist():
                rows = [x.split("\t") for x in zlib.decompress(lines).decode().split("\n")]
                yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)), *(pa.array([int(r[i]) for r in rows], pa.int64()) for i in (2, 3))], ["key", "file", "offset", "length"])

    # Lines of the opened blocks meet the asked keys as rows: any number of keys may fall into one block.
    lines = blocks.mapInArrow(unpack, "key string, file string, offset bigint, length bigint")
    places = lines.join(asked.select("key").distinct(), "key", "left_semi").select("file", "offset", "length")
    ordered = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def read(batches):
        name, stream = None, None
        try:
            for batch in batches:
                rows, held = [], 0
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != name:
                        if stream:
                            stream.close()
                        name, stream = file, _open(file)
                    stream.seek(offset)
                    rows.append(_record(stream.read(length), with_payload))
                    held += length if with_payload else 0
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)
        finally:
            if stream:
                stream.close()

    return ordered.mapInArrow(read, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], [p.split()[0] for p in RECORD_SCHEMA.split(", ")])


def archive_and_read(df: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a frame's archives, index them and look every url up again."""
    spark = df.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(df, path, id_col, url, payload)
    return lookup(build_index(spark, path), df.select(F.regexp_replace(F.col(f"`{url}`"), r"[\x00-\x20\x7f]", "%20")))
