"""Best-fit packing of token sequences, certified by lower bounds.

Documents are encoded, ended with an id, cut into pieces of at most the
capacity, and packed by best-fit decreasing in partitions of bounded size. For
each partition, dual feasible functions of the piece lengths give a number of
sequences that no packing can beat. Where best fit uses more, the partition has
a gap, and gives the pieces of its emptiest sequences to an exchange; a
partition without a gap gives those of its emptiest one, the remainder that its
own bound cannot see. The exchange is dealt anew, packed by best-fit decreasing
and bounded again, until no partition has a gap and one partition holds what is
left, or a round saves nothing. The bounds come out as a certificate, beside
the bound of all lengths together (``pack_certified``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdq.llm.common import free_prefix, quoted, read_table, write_shared
from mdq.llm.tokens import WORD_BPE, encoder, text_groups, vocabulary

CAPACITY = 4096
END_ID = 1
PIECES_PER_PARTITION = 50_000
ROUNDS = 6
PLACED = {"sequence_id": T.LongType(), "offset": T.LongType()}
OWN = {"give": T.BooleanType(), "part": T.IntegerType(), "bins": T.LongType(), "bound": T.LongType(), "pieces": T.LongType(), "given": T.LongType()}


# -- one partition -----------------------------------------------------------
def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best bound of two families of dual feasible functions: for every
    threshold a <= capacity / 2, lengths over capacity - a count as full and
    those under a as nothing; and rounding to k-ths of the capacity."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """``lower_bound`` from how often each length occurs."""
    c = capacity
    if not count.any():
        return 0
    size = count * np.arange(c + 1)
    n_upto, s_upto = np.cumsum(count), np.cumsum(size)
    half = c // 2
    a = np.arange(0, half + 1)
    n_large = n_upto[c] - n_upto[c - a]                     # > c - a
    n_mid = n_upto[c - a] - n_upto[half]                    # c/2 < w <= c - a
    s_mid = s_upto[c - a] - s_upto[half]
    s_small = s_upto[half] - np.where(a > 0, s_upto[np.maximum(a - 1, 0)], 0)
    over = np.maximum(0, s_small - (n_mid * c - s_mid))
    best = int((n_large + n_mid + -(-over // c)).max())
    w = np.arange(c + 1, dtype=np.int64)
    for k in range(1, 33):
        top = (k + 1) * w
        f = np.where(top % c == 0, w * k, top // c * c)     # k times the function's value
        best = max(best, int(-(-int((f * count).sum()) // (k * c))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of every length and the room left in every bin. Bins are
    kept by the room they have left, with a bit set of the rooms in use."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, left = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        room -= n
        left[b] = room
        if room:
            with_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, np.array(left, np.int64)


def to_exchange(left: np.ndarray, gap: int) -> np.ndarray:
    """Which bins a partition gives away: the emptiest one, and with a gap
    eight for each bin too many; never a full one."""
    give = np.zeros(len(left), bool)
    give[np.argsort(-left, kind="stable")[:1 + 8 * gap]] = True
    return give & (left > 0)


# -- on Spark ----------------------------------------------------------------
def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, piece (int, from 0), start, length and ids (binary, little-endian
    u32) of every document's pieces; only documents over ``capacity`` are cut.
    Null text counts as empty: one piece, the end id. Repeated rows give their
    pieces each time; other columns are left out, whatever their names."""
    path = path or vocabulary(WORD_BPE)
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches):
        enc = encoder(path, spaces=False, memo_size=200_000)
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for lo, hi in text_groups(texts, 7_000_000):
                rows = [(d, p // step, p // 4, raw[p:p + step])
                        for d, x in zip(names[lo:hi], enc.encode(texts.slice(lo, hi - lo)))
                        for raw in (x + end,) for p in range(0, len(raw), step)]
                d, k, s, x = zip(*rows)
                yield pa.record_batch([pa.array(d, pa.int64()), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                                       pa.array([len(y) // 4 for y in x], pa.int64()), pa.array(x, pa.binary())],
                                      ["doc_id", "piece", "start", "length", "ids"])
            pa.default_memory_pool().release_unused()

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary"))


def _round(pool: DataFrame, p: str, number: int, parts: int, capacity: int, last: bool) -> DataFrame:
    """Pack ``pool`` in ``parts`` partitions; adds sequence_id, offset, give
    and, on one row of each partition, its bins, bound, pieces and bins given away."""
    placed = {**PLACED, **{f"{p}{c}": k for c, k in OWN.items()}}
    keep = [c for c in pool.columns if c not in placed]               # the input's, by numbers, and the row's own
    base = F.pmod(F.xxhash64(F.lit(number), f"{p}uid"), F.lit(parts)).cast("int")
    dealt = pool.select(*keep).withColumn(f"{p}part", base).repartition(parts, f"{p}part")
    out = pool.select(*keep).schema
    for name, kind in placed.items():
        out = out.add(name, kind)

    def fit(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        part = t.column(f"{p}part").to_numpy()
        for k in np.unique(part).tolist():                 # a task may hold several
            rows = t.filter(pa.array(part == k))
            lengths = rows.column("length").to_numpy()
            bins, offsets, left = best_fit_decreasing(lengths, capacity)
            bound = lower_bound(lengths, capacity)
            give = np.zeros(len(left), bool) if last else to_exchange(left, len(left) - bound)
            first = np.arange(rows.num_rows) == 0
            stat = lambda x: pa.array(np.where(first, x, 0), pa.int64())
            yield from pa.Table.from_arrays(
                [rows.column(c) for c in keep]
                + [pa.array((number << 56) + (k << 24) + bins), pa.array(offsets), pa.array(give[bins]),
                   pa.array(np.full(rows.num_rows, k), pa.int32()),
                   stat(len(left)), stat(bound), stat(rows.num_rows), stat(int(give.sum()))],
                names=keep + list(placed)).to_batches()

    return write_shared(dealt.mapInArrow(fit, out), f"pack-{number}")


@dataclass
class Packing:
    """``rows``: the input with sequence_id and offset. ``certificate``: a row
    for each partition of each round (round, part, pieces, bins, bound, given,
    gap = bins - bound): its best fit used ``bins`` sequences, no packing of its
    pieces can use fewer than ``bound``, and it gave ``given`` away to the next
    round. ``sequences`` in all, and the ``bound`` of all lengths together."""
    rows: DataFrame
    certificate: DataFrame
    sequences: int
    bound: int


def total_bound(rows: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound of all lengths; the driver gets a count for each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    return bound_of_counts(counts, capacity)


def pack_certified(rows: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION,
                   rounds: int = ROUNDS) -> Packing:
    """``pack`` with its certificate. Where ``sequences`` equals ``bound``, the
    packing is proven to be the best; else the difference is what may be left."""
    p = free_prefix(rows.columns, "pk")
    # Inside, the input's columns go by numbers: Arrow functions do not take every name.
    names = {c: c if c == "length" else f"{p}c{i}" for i, c in enumerate(rows.columns) if c.lower() not in PLACED}
    pool = write_shared(rows.select(*[F.col(quoted(c)).alias(n) for c, n in names.items()]).withColumn(f"{p}uid", F.monotonically_increasing_id()), "pack-pieces")
    bound = total_bound(pool, capacity)
    n, done, stats, used = pool.count(), [], [], 0
    for r in range(rounds):
        parts = max(1, -(-n // per_partition))
        last = parts == 1 or r == rounds - 1
        got = _round(pool, p, r, parts, capacity, last)
        s = got.agg(F.sum(f"{p}bins").alias("bins"), F.sum(f"{p}given").alias("given")).first()
        stats.append(got.filter(f"{p}bins > 0").select(F.lit(r).alias("round"), *[F.col(f"{p}{c}").alias(c) for c in ("part", "pieces", "bins", "bound", "given")]))
        if r and (s["bins"] or 0) >= before:                # this exchange saved nothing: keep the packing it came from
            done.append(pool)
            used += before
            break
        done.append(got.filter(f"not {p}give"))
        used += (s["bins"] or 0) - (s["given"] or 0)
        pool, before = got.filter(f"{p}give"), s["given"] or 0
        n = pool.count() if before else 0
        if last or not n:
            break
    out = [d.select(*[F.col(n).alias(c) for c, n in names.items()], "sequence_id", "offset") for d in done]
    return Packing(reduce(DataFrame.unionByName, out), reduce(DataFrame.unionByName, stats).withColumn("gap", F.col("bins") - F.col("bound")), used, bound)


def pack(rows: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION,
         rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (with a long column length, 1 .. capacity) plus sequence_id and
    offset; input columns of these names are replaced, any other name is kept.
    Rows may repeat: each is placed once. An empty table gives an empty table.

    Rows are dealt by a hash of a number that is written with them, so a
    partition holds about ``per_partition`` rows whatever the data. Only row
    counts, bins and bounds (sums, and a count for each length) reach the driver.
    """
    return pack_certified(rows, capacity, per_partition, rounds).rows


def packed_documents(docs: DataFrame) -> DataFrame:
    """The contract's columns for ``docs``: where each piece's ids go, with the
    ids' checksum in place of the ids."""
    p = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(p).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"))
