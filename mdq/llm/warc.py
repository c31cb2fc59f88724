"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed independently. A bundle is
a row of such frames, closed by a seek table in a skippable frame (the format
that the Zstandard project documents: compressed and plain size of every frame,
then their number and a magic number at the very end of the file). The index
maps each record to its bundle, frame, and place inside the plain frame, so one
record is read by decompressing one frame; any Zstandard tool can still read a
bundle from start to end.

Equal payloads are stored once: the record of the largest id is a response,
the others are revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.llm.common import open_fs, read_table, shared_path, write_file, write_shared

MIN_DEDUP = 1000                   # bytes; smaller payloads are always stored
FRAME_BYTES = 512 * 1024           # plain bytes after which a frame is closed
BUNDLE_BYTES = 64 * 1024 * 1024    # compressed bytes after which a bundle is closed
TASK_BYTES = 32 * 1024 * 1024      # plain bytes of the frames that a task reads
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"      # the pages have no date of their own

#: Fixed values of the seekable format and of revisit records.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id bigint, file string, frame int, offset bigint, length bigint"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


# -- records -----------------------------------------------------------------
def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    x = name.removeprefix("<urn:page:").removesuffix(">")
    return None if x == "null" else int(x)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` given) has the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~|^`{}\"<>\\"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(plain: bytes, at: int = 0) -> tuple[tuple, int]:
    """The record at ``at`` (the columns of RECORD) and the place behind it."""
    end = plain.index(b"\r\n\r\n", at)
    lines = plain[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    block = plain[start:start + size]
    cut = block.index(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in block[:cut].decode().split("\r\n")[1:])
    n, digest, kind = int(http["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block[cut + 4:]
        if len(payload) != n or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    refers = _id(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
    return (_id(head["WARC-Record-ID"]), n, digest, kind, refers, head.get("WARC-Target-URI"), payload), start + size + 4


# -- bundles -----------------------------------------------------------------
def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame of an open bundle."""
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE or flags & 0x7C:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    f.seek(size - 9 - n * entry)
    raw, out, at = f.read(n * entry), [], 0
    for i in range(n):
        c, d = struct.unpack_from("<II", raw, i * entry)
        out.append((at, c, d))
        at += c
    return out


class Bundles:
    """Open bundles of a task, with their seek tables."""

    def __init__(self):
        self.name, self.f, self.table = None, None, []

    def frame(self, name: str, k: int) -> bytes:
        if name != self.name:
            if self.f is not None:
                self.f.close()
            fs, path = open_fs(name)
            size = fs.get_file_info(path).size
            self.f, self.name = fs.open_input_file(path), name
            self.table = read_seek_table(self.f, size)
        start, c, d = self.table[k]
        self.f.seek(start)
        return zstandard.ZstdDecompressor().decompress(self.f.read(c), max_output_size=d)


def classify(pages: DataFrame, min_bytes: int = MIN_DEDUP) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: a response).

    Groups of equal payloads are counted without the payloads; only groups of
    several pages are joined back, by a join that Spark broadcasts or splits by
    their measured size. Payloads that cannot match get a key of their own, so
    they do not meet under a null key."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    groups = write_shared(p.filter(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
                          .filter("n > 1 and first is not null").select(F.col("digest").alias("group"), "first"), "warc-groups")
    key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.hex(F.xxhash64("url", "digest")))))
    return (p.join(groups, key == F.col("group"), "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))


def write_bundles(pages: DataFrame, root: str, min_bytes: int = MIN_DEDUP, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) into
    bundles under ``root``; returns the written index, a row per record.

    Null html is an empty payload; a null url leaves its header out; null ids
    are named so. Where an id repeats, each row is a record, and all rows of a
    group's largest id are responses. An empty table writes no bundle. Other
    columns are left out. A retried task writes bundles of a new name; only
    those in the index count."""
    def write(batches):
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        frames, sizes, held, rows, total = [], [], [], [], 0
        name, at = f"{root}/{uuid.uuid4().hex}.warc.zst", 0

        def close_frame():
            nonlocal held, at, total
            plain = b"".join(held)
            frames.append(squeeze(plain))
            sizes.append((len(frames[-1]), len(plain)))
            total += len(frames[-1])
            held, at = [], 0

        def close_bundle():
            nonlocal frames, sizes, rows, total, name
            write_file(name, [*frames, seek_table(sizes)])
            d, k, o, n = zip(*rows)
            out = pa.record_batch([pa.array(d, pa.int64()), pa.array([name] * len(rows)), pa.array(k, pa.int32()),
                                   pa.array(o, pa.int64()), pa.array(n, pa.int64())], ["page_id", "file", "frame", "offset", "length"])
            frames, sizes, rows, total, name = [], [], [], 0, f"{root}/{uuid.uuid4().hex}.warc.zst"
            return out

        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns)):
                raw = record(*x)
                rows.append((x[0], len(frames), at, len(raw)))
                held.append(raw)
                at += len(raw)
                if at >= frame_bytes:
                    close_frame()
                    if total >= bundle_bytes:
                        yield close_bundle()
        if held:
            close_frame()
        if frames:
            yield close_bundle()

    return write_shared(classify(pages, min_bytes).mapInArrow(write, INDEX), "warc-index")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split(" ")[0] for x in RECORD.split(", ")])


def _tasks(frames: DataFrame) -> int:
    """Tasks that read ``frames`` (a row for each, with its plain bytes). Index
    rows are few bytes, so their size says nothing about the work behind them."""
    s = frames.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    return max(1, min(s["n"], max(-(-(s["bytes"] or 0) // TASK_BYTES), 2 * frames.sparkSession.sparkContext.defaultParallelism)))


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles in ``index``, a frame at a time. Frames are
    dealt to tasks by hash, about ``TASK_BYTES`` of records to each. Payloads are
    checked against their digests. A record is returned once, also where index
    rows repeat; an empty index gives an empty table."""
    def read(batches):
        bundles = Bundles()
        for b in batches:
            for name, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                plain, at, rows = bundles.frame(name, k), 0, []
                while at < len(plain):
                    row, at = parse(plain, at)
                    rows.append(row if payloads else row[:-1] + (None,))
                yield _batch(rows)
    frames = index.groupBy("file", "frame").agg(F.sum("length").alias("bytes"))
    return (frames.select("file", "frame").repartition(_tasks(frames), "file", "frame").sortWithinPartitions("file", "frame")
            .mapInArrow(read, RECORD))


def fetch(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the page ids in ``ids`` (column page_id): of each frame
    that holds any, only their places are parsed. Null ids find nothing; an id
    that repeats in ``ids`` gives its records once, one that repeats in the
    bundles all of them; one that is in no bundle gives none."""
    def read(batches):
        bundles, at = Bundles(), (None, None)
        for b in batches:
            rows = []
            for name, k, o in zip(*(c.to_pylist() for c in b.columns)):
                if (name, k) != at:
                    plain, at = bundles.frame(name, k), (name, k)
                rows.append(parse(plain, o)[0])
            if rows:
                yield _batch(rows)
    found = write_shared(index.join(ids.select("page_id").distinct(), "page_id", "left_semi").select("file", "frame", "offset"), "warc-wanted")
    frames = found.groupBy("file", "frame").agg(F.lit(FRAME_BYTES).alias("bytes"))
    return found.repartition(_tasks(frames), "file", "frame").sortWithinPartitions("file", "frame", "offset").mapInArrow(read, RECORD)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_bundles(read_table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return read_bundles(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = f"""
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
     g AS (SELECT payload_digest AS digest, MAX(page_id) AS page FROM d WHERE payload_bytes >= {MIN_DEDUP} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page IS NOT NULL AND page_id IS DISTINCT FROM page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page IS NOT NULL AND page_id IS DISTINCT FROM page THEN page END AS refers_to
FROM d LEFT JOIN g ON payload_digest = digest AND payload_bytes >= {MIN_DEDUP}
"""
