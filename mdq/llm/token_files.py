"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

A file holds the ids of consecutive documents. Its ids are ranked by how often
they occur in it, so frequent ids get small ranks; each rank takes 1 to 4
bytes. Two bits per rank say how many, four ranks to a control byte; control
bytes and data bytes are separate streams. Reading looks the lengths of four
ranks up at once in a table of 256 rows, adds them up to offsets, gathers the
bytes, and maps ranks back to ids, all in numpy.

Layout, little-endian: magic ``FRVB0001``; counts of documents, tokens, ranks,
data bytes (4 x u64); document ids (i64); null-id flags (u8); tokens per
document (u64); ids by rank (u32); control bytes; data bytes.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mdq.llm.common import open_fs, read_table, shared_path, write_file, write_shared
from mdq.llm.tokens import BYTE_BPE, encoder, text_groups, vocabulary

MAGIC = b"FRVB0001"
END_ID = 2
TOKENS_PER_FILE = 2_000_000
READ_BYTES = 16 << 20       # file bytes a reading task gets, about

#: For each control byte, the length codes (0 to 3: 1 to 4 bytes) of its four ranks.
CODES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
MANIFEST = "part bigint, file string, n_docs bigint, n_tokens bigint, n_bytes bigint"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids by rank, control bytes, data bytes) of a u32 array. Equally
    frequent ids rank by value."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    used = np.flatnonzero(counts)
    table = used[np.argsort(-counts[used], kind="stable")].astype("<u4")
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[table] = np.arange(len(table), dtype=np.uint32)
    ranks = rank_of[ids]
    width = sum(len(table) > 1 << 8 * b for b in (1, 2, 3))        # longest code in use
    code = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    for b in range(1, width + 1):
        code[:len(ids)] += ranks > (1 << 8 * b) - 1
    four = code.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    code = code[:len(ids)]
    kind = np.int32 if len(ids) < 1 << 28 else np.int64
    ends = np.cumsum(code, dtype=kind)
    at = ends - code + np.arange(len(ids), dtype=kind)
    data = np.zeros(int(ends[-1]) + len(ids) if len(ids) else 0, np.uint8)
    data[at] = ranks.astype(np.uint8)
    for b in range(1, width + 1):
        more = np.flatnonzero(code >= b)
        data[at[more] + b] = (ranks[more] >> np.uint32(8 * b)).astype(np.uint8)
    return table, control.astype(np.uint8), data


def unpack(table: np.ndarray, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    code = CODES[control].reshape(-1)[:n]
    kind = np.int32 if n < 1 << 28 else np.int64
    at = np.cumsum(code, dtype=kind) - code + np.arange(n, dtype=kind)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    ranks = padded[at].astype(np.uint32)
    for b in range(1, int(code.max(initial=0)) + 1):
        ranks |= padded[at + kind(b)].astype(np.uint32) << np.uint32(8 * b)
    return table[ranks & MASKS[code]]


def file_parts(doc_ids: list, lengths: list[int], ids: np.ndarray) -> list[bytes]:
    table, control, data = pack(ids)
    return [MAGIC, np.array([len(doc_ids), len(ids), len(table), len(data)], "<u8").tobytes(),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array(lengths, "<u8").tobytes(), table.tobytes(), control.tobytes(), data.tobytes()]


def parse_file(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, tokens per document, all ids) of a file's bytes."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n, n_ranks, n_data = np.frombuffer(raw, "<u8", 4, 8).tolist()
    at = 40

    def take(kind, count):
        nonlocal at
        a = np.frombuffer(raw, kind, count, at)
        at += a.nbytes
        return a
    docs, null = take("<i8", n_docs), take(np.uint8, n_docs)
    lengths, table = take("<u8", n_docs), take("<u4", n_ranks)
    control, data = take(np.uint8, -(-n // 4)), take(np.uint8, n_data)
    return [None if x else d for d, x in zip(docs.tolist(), null)], lengths.astype(np.int64), unpack(table, control, data, n)


def write_token_files(docs: DataFrame, root: str, path: str | None = None, end_id: int = END_ID,
                      tokens_per_file: int = TOKENS_PER_FILE) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into files under
    ``root``; returns the written manifest, a row per file, in the order of ``part``.

    The rows are dealt out by ranges of doc_id and sorted in each range (null
    ids first; equal ids by the hash of their text), so files are in order
    without one task seeing all rows. Null and empty texts are the end id
    alone. An empty table writes no file. Other columns are left out. A retried
    task writes files of a new name; only those in the manifest count.
    """
    path = path or vocabulary(BYTE_BPE)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        enc = encoder(path, spaces=True)
        part = TaskContext.get().partitionId() << 24
        doc_ids, ids, lengths = [], [], []

        def flush():
            name = f"{root}/{part:016x}-{uuid.uuid4().hex[:8]}.frvb"
            parts = file_parts(doc_ids, lengths, np.frombuffer(b"".join(ids), "<u4"))
            write_file(name, parts)
            return pa.record_batch([pa.array([x], t) for x, t in (
                (part, pa.int64()), (name, pa.string()), (len(doc_ids), pa.int64()),
                (sum(lengths), pa.int64()), (sum(map(len, parts)), pa.int64()))],
                ["part", "file", "n_docs", "n_tokens", "n_bytes"])

        held = 0
        for b in batches:
            texts, names = b.column(1), b.column(0).to_pylist()
            for lo, hi in text_groups(texts):
                for d, x in zip(names[lo:hi], enc.encode(texts.slice(lo, hi - lo))):
                    doc_ids.append(d)
                    ids.append(x + end)
                    lengths.append(len(x) // 4 + 1)
                    held += lengths[-1]
                    if held >= tokens_per_file:
                        yield flush()
                        part, held = part + 1, 0
                        doc_ids, ids, lengths = [], [], []
        if doc_ids:
            yield flush()

    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    return write_shared(rows.mapInArrow(write, MANIFEST), "token-manifest")


def first_positions(manifest: DataFrame) -> DataFrame:
    """file and ``base``, the ids in all files before it, by ``part``.

    A running sum over the files of each writing task, on top of one over these
    tasks' totals: the only window without a key sees a row per writing task.
    Equal parts (a manifest joined from several) are in the order of their files.
    """
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select("file", "part", "n_tokens", F.shiftright("part", 24).alias("task"))
    own = F.sum("n_tokens").over(before(W.partitionBy("task").orderBy("part", "file")))
    tasks = files.groupBy("task").agg(F.sum("n_tokens").alias("n")).select(
        "task", F.sum("n").over(before(W.orderBy("task"))).alias("earlier"))
    zero = F.lit(0).cast("bigint")
    return files.withColumn("own", own).join(tasks, "task").select(
        "file", (F.coalesce("earlier", zero) + F.coalesce("own", zero)).alias("base"))


def _tasks(manifest: DataFrame) -> int:
    """Tasks that read the files: about ``READ_BYTES`` to each however many there
    are, and while there are few, enough for all cores."""
    s = manifest.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes")).first()
    return max(1, min(s["n"], max(-(-(s["bytes"] or 0) // READ_BYTES), 2 * manifest.sparkSession.sparkContext.defaultParallelism)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary,
    little-endian u32) of every document in the files of ``manifest``.

    A task holds one file at a time. Null and repeated document ids come back
    as they were written, a row for each; a document longer than a file's usual
    size is one row. Columns of the manifest beyond its own are left out, and an
    empty manifest gives an empty table.
    """
    files = first_positions(manifest)

    def read(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, path = open_fs(name)
                with fs.open_input_stream(path) as f:
                    docs, lengths, ids = parse_file(f.read())
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4", copy=False).tobytes()
                for lo in range(0, len(docs), 2000):
                    hi = min(lo + 2000, len(docs))
                    e, k = ends[lo:hi], lengths[lo:hi]
                    yield pa.record_batch(
                        [pa.array(docs[lo:hi], pa.int64()), pa.array(base + e - k), pa.array(k),
                         pa.array([raw[4 * (x - y):4 * x] for x, y in zip(e.tolist(), k.tolist())], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return files.repartition(_tasks(manifest)).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), shared_path(spark, "token-files"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
