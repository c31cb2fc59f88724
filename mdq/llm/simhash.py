"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint's 64 bits are cut into six blocks. Two fingerprints that differ
in at most four bits agree in at least two blocks, so every pair within the
radius shares one of fifteen keys (two block numbers and their bits). Rows are
brought together by key. Within a key, bit planes are stored vertically (one
machine word holds the same bit of 64 fingerprints) and shifted against
themselves, so one pass compares 64 pairs a word: differing bits are added up
by carry-save counters, and words whose pairs have all passed the radius, or
are known to be connected already, are dropped on the way.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.llm.common import connected_components, free_prefix, quoted, read_table, write_shared

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 4096                 # rows of a key that meet in one task; larger keys are cut into tiles
WINDOW = 1 << 16            # rows compared at a time
PLANES_AT_ONCE = 8          # planes added between two looks for finished words


# -- fingerprints ------------------------------------------------------------
def fingerprint(text: str, n: int = SHINGLE) -> int:
    """SimHash of the n-word shingles, repeats included; ASCII letters are
    lower-cased. Fewer than n words: the whole sequence; none: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends - size + 1)[:len(words) - n + 1].tolist()
    ends = ends[n - 1:].tolist()
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, len(starts), 1 << 15):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + (1 << 15)], ends[lo:lo + (1 << 15)])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's 64 bits as a signed long) of each row."""
    def each(batches):
        for b in batches:
            fp = np.array([fingerprint(t or "", n) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        each, "doc_id bigint, text_hash bigint, fp bigint")


# -- bit-sliced comparison ---------------------------------------------------
def planes_of(fp: np.ndarray) -> np.ndarray:
    """(64, words) bit planes: bit i % 64 of word i // 64 of plane b is bit b of fp[i]."""
    bits = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    n = -(-len(fp) // 64) * 64
    wide = np.zeros((64, n), np.uint8)
    wide[:, :len(fp)] = bits.T
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def _shifted(planes: np.ndarray, d: int, words: np.ndarray) -> np.ndarray:
    """The given words of the planes moved down by d rows (row i holds row i + d)."""
    q, r = divmod(d, 64)
    end = planes.shape[1]
    low = np.where(words + q < end, planes[:, np.minimum(words + q, end - 1)], 0)
    if not r:
        return low
    high = np.where(words + q + 1 < end, planes[:, np.minimum(words + q + 1, end - 1)], 0)
    return low >> np.uint64(r) | high << np.uint64(64 - r)


def lag_hits(planes: np.ndarray, d: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Rows i of the mask ``wanted`` whose fingerprint is within ``radius``
    bits of that of row i + d."""
    n = planes.shape[1] * 64
    mask = np.zeros(n, np.uint8)
    mask[:len(wanted)] = wanted
    alive = np.packbits(mask, bitorder="little").view("<u8")
    words = np.flatnonzero(alive)
    alive = alive[words]
    digits = [np.zeros(len(words), np.uint64) for _ in range(max(1, radius.bit_length()))]
    for lo in range(0, 64, PLANES_AT_ONCE):
        if not len(words):
            return words
        part = planes[lo:lo + PLANES_AT_ONCE]
        differ = part[:, words] ^ _shifted(part, d, words)
        for plane in differ:
            carry = plane
            for k, x in enumerate(digits):                       # carry-save: one more for the lanes that differ
                digits[k], carry = x ^ carry, x & carry
            alive = alive & ~carry                               # the counter ran over
        over, equal = np.zeros(len(words), np.uint64), np.full(len(words), ~np.uint64(0))
        for k in reversed(range(len(digits))):                   # count > radius, from the highest digit
            if radius >> k & 1:
                equal = equal & digits[k]
            else:
                over, equal = over | equal & digits[k], equal & ~digits[k]
        alive = alive & ~over
        left = alive != 0
        if not left.all():
            words, alive, digits = words[left], alive[left], [x[left] for x in digits]
    lanes = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, lane = np.nonzero(lanes)
    return words[w] * 64 + lane


def links(key: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Rows sorted by key: pairs of row numbers that connect all rows of a key
    that are within ``radius`` of each other, directly or through others of the
    key. At most one pair fewer than rows; pairs already connected are not
    compared again."""
    planes = planes_of(fp)
    parent = np.arange(len(fp))
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    longest = int(np.diff(np.append(edge, len(fp))).max(initial=0))
    out: list[tuple[int, int]] = []
    for d in range(1, longest):
        wanted = (key[:-d] == key[d:]) & (parent[:-d] != parent[d:])
        if not wanted.any():
            continue
        found = False
        for i in lag_hits(planes, d, wanted, radius).tolist():
            a, b = int(parent[i]), int(parent[i + d])
            while parent[a] != a:
                a = int(parent[a])
            while parent[b] != b:
                b = int(parent[b])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, i + d))
                found = True
        while found:                                             # every row points at its root again
            up = parent[parent]
            found = bool((up != parent).any())
            parent = up
    return out


# -- on Spark ----------------------------------------------------------------
def _keys(fp: str, radius: int):
    """Every pair of ``radius`` + 2 blocks: its number and the blocks' bits."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    bits = [F.shiftrightunsigned(F.col(fp), cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)) for i in range(n)]
    return F.array(*[F.xxhash64(F.lit(i * n + j), bits[i], bits[j]) for i, j in combinations(range(n), 2)])


def linked_pairs(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fps`` (column fp) that
    connect whatever is within the radius.

    A key with more than ``tile`` rows is cut into tiles by a hash, and each
    pair of its tiles is compared by itself, so no task gets a whole hot key;
    their counts are joined by a shuffle that AQE may split or broadcast."""
    rows = fps.select("fp", F.explode(_keys("fp", radius)).alias("key"))
    sizes = write_shared(rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
                         .select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "simhash-hot")
    t = F.coalesce(F.col("tiles"), F.lit(1))
    own = F.pmod(F.xxhash64(F.lit(7), "fp"), t).cast("int")
    other = F.explode(F.sequence(F.lit(0), t - 1))
    rows = (rows.join(sizes, "key", "left").withColumn("own", own).withColumn("other", other)
            .select(F.when(t == 1, F.col("key")).otherwise(
                F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"), "fp"))

    def compare(batches):
        keys, fps_, n = [], [], 0

        def run(last):
            nonlocal keys, fps_, n
            k, f = np.concatenate(keys), np.concatenate(fps_)
            end = len(k) if last else int(np.searchsorted(k, k[-1], side="left"))
            keys, fps_, n = [k[end:]], [f[end:]], len(k) - end
            if not end:
                return None
            k, f = k[:end], f[:end]
            same = np.append(False, k[1:] == k[:-1])
            many = same | np.append(same[1:], False)              # keys with one row need no comparison
            k, f = k[many], f[many]
            got = np.array(links(k, f.view(np.uint64), radius), np.int64).reshape(-1, 2)
            return pa.record_batch([pa.array(f[got[:, 0]]), pa.array(f[got[:, 1]])], ["a", "b"])

        for b in batches:
            keys.append(b.column(0).to_numpy())
            fps_.append(b.column(1).to_numpy())
            n += b.num_rows
            if n >= WINDOW:
                got = run(False)
                if got is not None:
                    yield got
        if n:
            got = run(True)
            if got is not None:
                yield got

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a bigint, b bigint")


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_hash, fp, root (the component's smallest fingerprint) and
    component_id of each row."""
    fps = write_shared(fingerprints(docs, shingle), "simhash")
    nodes = write_shared(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = connected_components(linked_pairs(nodes, radius))
    named = write_shared(nodes.join(roots, F.col("fp") == F.col("node"), "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    smallest = write_shared(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    of_fp = write_shared(named.drop("first").join(smallest, "root"), "simhash-components")
    return fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id
    among the documents whose fingerprints are linked, over any number of
    links) of each row.

    Null text counts as empty: fingerprint 0, linked like any other. Equal
    fingerprints are one node, so copies cost one row each and no pair. A null
    id is a component's id only if all of its ids are null. An empty table
    gives an empty table; other columns are left out."""
    return components(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest doc_id
    (null ids last), then of the smallest text hash. Where whole rows of that id
    and text repeat, one of them stays."""
    got = write_shared(components(docs, shingle, radius).drop("fp", "component_id"), "simhash-rows")
    p = free_prefix(docs.columns, "sd")
    best = got.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("z"), "doc_id", "text_hash")).alias("m"))
    best = best.select(F.col("m.doc_id").alias(f"{p}id"), F.col("m.text_hash").alias(f"{p}hash"))
    several = got.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    best = write_shared(best.join(several, F.col(f"{p}id").eqNullSafe(F.col("doc_id")) & (F.col(f"{p}hash") == F.col("text_hash")), "left")
                        .select(f"{p}id", f"{p}hash", F.col("n").isNotNull().alias(f"{p}again")), "simhash-best")
    names = [quoted(c) for c in docs.columns]
    rows = docs.join(best, F.col("doc_id").cast("bigint").eqNullSafe(F.col(f"{p}id"))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col(f"{p}hash")))
    if best.filter(f"{p}again").limit(1).count() == 0:
        return rows.select(*names)
    once = rows.filter(f"{p}again").dropDuplicates([f"{p}id", f"{p}hash"])
    return rows.filter(f"not {p}again").select(*names).unionByName(once.select(*names))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
