"""Embedding near-duplicates by an epsilon grid order join.

Cosine t between unit vectors is the distance eps = sqrt(2 - 2 t). Vectors of a
label are projected on their leading principal axes and sorted by the cells of
a grid there (half of eps wide, first axis first), which is the epsilon grid
order. The sorted sequence is cut into segments with bounding boxes. Intervals
of the sequence are joined with each other recursively, from whole labels down
to pairs of segments, and a pair of intervals is dropped as soon as their boxes
are further apart than eps. A task takes pairs of segments, goes on with the
recursion inside them, and compares the blocks that are left in two steps: the
projections and the length of what they leave out give a bound from above on the
cosine (one product in single precision); pairs that it cannot exclude are
computed in double precision.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdq.llm.blocks import BlockReader, BlockWriter, principal_axes, read_vectors, rows_of, unit_rows
from mdq.llm.common import connected_components, read_table, shared_path, write_shared

THRESHOLD = 0.93
LEAD = 24                       # principal axes that give order and bounds
BOX = 8                         # of these, the axes of a segment's box in the index
SEGMENT_ROWS = 16_384
SEGMENT_BYTES = 16 << 20        # of vectors in double precision
LEAF = 512                      # rows of a block inside a segment
FANOUT = 4                      # bits of an interval's number that a level of the recursion adds
PAIRS_PER_TASK = 1 << 29        # comparisons

INDEX = ("vec_id bigint, node bigint, n bigint, first bigint, seg bigint, part int, label string, dim int, file string, "
         "at bigint, size bigint, rows int, lo array<double>, hi array<double>")


def _axes(dim: int, main: tuple[int, np.ndarray] | None) -> np.ndarray:
    """The axes of vectors of ``dim`` components: principal ones for the most
    common length, else the first coordinates."""
    if main is not None and main[0] == dim:
        return main[1]
    return np.eye(dim, min(dim, LEAD))


def _item(column: T.DataType) -> str:
    return "<f4" if isinstance(getattr(column, "elementType", None), T.FloatType) else "<f8"


# -- inside a task -----------------------------------------------------------
class Segment:
    """A segment's vectors, projections and the boxes of its blocks."""

    def __init__(self, raw: bytes, rows: int, dim: int, item: str, axes: np.ndarray):
        head = np.frombuffer(raw, "<i8", 3 * rows)
        self.node, self.n, self.first, self.rows = head[:rows], head[rows:2 * rows], head[2 * rows:], rows
        self.x = unit_rows(np.frombuffer(raw, item, rows * dim, 24 * rows).reshape(rows, dim).astype(np.float64))
        lead = self.x @ axes
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", lead, lead)))
        lead = np.column_stack([lead, rest])
        self.p = lead.astype(np.float32)
        cuts = np.arange(0, rows, LEAF)
        self.lo, self.hi = np.minimum.reduceat(lead, cuts), np.maximum.reduceat(lead, cuts)


def _gap(lo_a, hi_a, lo_b, hi_b) -> float:
    """Squared distance of two boxes."""
    d = np.maximum(0.0, np.maximum(lo_b - hi_a, lo_a - hi_b))
    return float(d @ d)


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` with the sets of each pair joined under their smallest member."""
    while True:
        ra, rb = parent[a], parent[b]
        new = ra != rb
        if not new.any():
            return parent
        a, b, ra, rb = a[new], b[new], ra[new], rb[new]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def join_segments(a: Segment, b: Segment, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, links, root) of the rows of ``a`` followed by those of ``b`` that
    have links between the two (within ``a``, if they are the same object): how
    many vectors each is linked with, and the first row of what is connected."""
    same, base = a is b, 0 if a is b else a.rows
    links, parent = np.zeros(base + b.rows, np.int64), np.arange(base + b.rows)
    limit, floor = 2.0 - 2.0 * threshold + 1e-6, np.float32(threshold - 1e-5)
    todo = [(0, len(a.lo), 0, len(b.lo))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if _gap(a.lo[a0:a1].min(0), a.hi[a0:a1].max(0), b.lo[b0:b1].min(0), b.hi[b0:b1].max(0)) > limit:
            continue
        if a1 - a0 > 1 or b1 - b0 > 1:
            if same and a0 == b0 and a1 == b1:
                m = (a0 + a1) // 2
                todo += [(a0, m, a0, m), (a0, m, m, a1), (m, a1, m, a1)]
            elif a1 - a0 >= b1 - b0:
                m = (a0 + a1) // 2
                todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
            else:
                m = (b0 + b1) // 2
                todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
            continue
        ra, rb = slice(a0 * LEAF, min(a1 * LEAF, a.rows)), slice(b0 * LEAF, min(b1 * LEAF, b.rows))
        near = a.p[ra] @ b.p[rb].T >= floor
        if same and a0 == b0:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            continue
        if len(i) * 16 > near.size:
            hit = (a.x[ra] @ b.x[rb].T)[i, j] >= threshold
        else:
            hit = np.einsum("ij,ij->i", a.x[ra][i], b.x[rb][j]) >= threshold
        i, j = i[hit] + ra.start, j[hit] + rb.start
        np.add.at(links, i, b.n[j])
        np.add.at(links, base + j, a.n[i])
        parent = _union(parent, i, base + j)
    rows = np.flatnonzero(links)
    return rows, links[rows], parent[rows]


# -- on Spark ----------------------------------------------------------------
def _keyed(vectors: DataFrame, main, cell: float) -> DataFrame:
    """id, label, dim, cells (a byte for each leading axis), key (the same for
    equal vectors of a label) and x (bytes) of the rows that can link."""
    item = _item(vectors.schema["x"].dataType)

    def each(batches):
        for b in batches:
            ids, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            values, start, length, valid = read_vectors(b.column(2))
            out = [[], [], [], [], [], []]
            for d in np.unique(length[valid]).tolist():
                rows = np.flatnonzero(valid & (length == d))
                x = rows_of(values, start, rows, d)
                some = np.abs(x).max(axis=1) > 0
                rows, x = rows[some], x[some]
                lead = unit_rows(x) @ _axes(d, main)
                cells = (np.clip(np.floor(lead / cell), -128, 127) + 128).astype(np.uint8)
                raw, step = x.astype(item).tobytes(), d * np.dtype(item).itemsize
                for k, r in enumerate(rows.tolist()):
                    label, v = labels[r], raw[k * step:(k + 1) * step]
                    if label is None:
                        continue
                    name = label.encode()
                    key = hashlib.blake2b(struct.pack("<qq", len(name), d) + name + v, digest_size=16).digest()
                    for o, y in zip(out, (ids[r], label, d, cells[k].tobytes(), key, v)):
                        o.append(y)
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(o, k) for o, k in zip(out, kinds)], ["id", "label", "dim", "cells", "key", "x"])
    return vectors.mapInArrow(each, "id bigint, label string, dim int, cells binary, key binary, x binary")


def _segments(keyed: DataFrame, root: str, parts: int, item: str, main) -> DataFrame:
    """Sort into grid order, cut into segments and write them: an index row for
    each segment and a row (vec_id, node, n, first) for each vector. Equal
    vectors that meet in a segment are one node of n vectors."""
    def write(batches):
        out, part = BlockWriter(root), TaskContext.get().partitionId()
        made = {"seg": 0, "node": 0}
        held: list[tuple] = []
        size = 0

        def close():
            nonlocal held, size
            label, dim = held[0][1], held[0][2]
            nodes, start, last = [], made["node"], None
            members = []
            for row in held:
                if row[4] != last:
                    nodes.append([row[5], 0, None])
                    last = row[4]
                e = nodes[-1]
                e[1] += 1
                if row[0] is not None and (e[2] is None or row[0] < e[2]):
                    e[2] = row[0]
                members.append(len(nodes) - 1)
            made["node"] += len(nodes)
            base = (part << 36) + start
            none = -(1 << 63)
            raw = b"".join(e[0] for e in nodes)
            ids = np.arange(base, base + len(nodes), dtype="<i8")
            n = np.array([e[1] for e in nodes], "<i8")
            first = np.array([none if e[2] is None else e[2] for e in nodes], "<i8")
            at, nbytes = out.add(ids.tobytes(), n.tobytes(), first.tobytes(), raw)
            x = unit_rows(np.frombuffer(raw, item).reshape(len(nodes), dim).astype(np.float64))
            lead = (x @ _axes(dim, main))[:, :BOX]
            m = np.array(members)
            firsts = pa.array(first[m], mask=first[m] == none)
            k = len(held)
            rows = [pa.array([r[0] for r in held], pa.int64()), pa.array(ids[m]), pa.array(n[m]), firsts] + [None] * 10
            yield_rows = pa.record_batch([c if c is not None else pa.nulls(k, t) for c, t in zip(rows, kinds)], names)
            seg = (part << 36) + made["seg"]
            made["seg"] += 1
            index = [None, None, None, None, seg, part, label, dim, out.name, at, nbytes, len(nodes), lead.min(0).tolist(), lead.max(0).tolist()]
            held, size = [], 0
            return [yield_rows, pa.record_batch([pa.array([v], t) for v, t in zip(index, kinds)], names)]

        names = [c.split()[0] for c in INDEX.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(),
                                    pa.list_(pa.float64()), pa.list_(pa.float64())]
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (row[1] != held[0][1] or row[2] != held[0][2] or len(held) >= SEGMENT_ROWS or size >= SEGMENT_BYTES):
                    yield from close()
                held.append(row)
                size += 8 * row[2]
        if held:
            yield from close()
        out.close()

    tie = F.monotonically_increasing_id()
    order = ["label", "dim", "cells", "key", "tie"]
    return write_shared(keyed.withColumn("tie", tie).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
                        .mapInArrow(write, INDEX), "ego-index")


def _segment_pairs(index: DataFrame, parts: int, threshold: float) -> DataFrame:
    """Pairs of segments that their boxes, and those of every interval of
    partitions around them, do not prove to be further apart than eps."""
    limit = 2.0 - 2.0 * threshold + 1e-6
    group = ["label", "dim"]

    def boxes(level: int) -> DataFrame:
        iv = F.shiftright("part", FANOUT * level)
        ends = [f(F.get(F.col(c), F.lit(k))).alias(f"{c}{k}") for c, f in (("lo", F.min), ("hi", F.max)) for k in range(BOX)]
        g = index.groupBy(*group, iv.alias("iv")).agg(*ends)
        return g.select(*group, "iv", *[F.array(*[f"{c}{k}" for k in range(BOX)]).alias(c) for c in ("lo", "hi")])

    def near(a: str, b: str):
        gap = F.zip_with(F.zip_with(f"{a}lo", f"{b}hi", lambda x, y: x - y), F.zip_with(f"{b}lo", f"{a}hi", lambda x, y: x - y),
                         lambda p, q: F.greatest(F.lit(0.0), F.coalesce(p, F.lit(0.0)), F.coalesce(q, F.lit(0.0))))
        return F.aggregate(gap, F.lit(0.0), lambda s, d: s + d * d) <= limit

    def side(df: DataFrame, p: str, up) -> DataFrame:
        return df.withColumn("up", up).select(*[F.col(g) for g in group], *[F.col(c).alias(p + c) for c in df.columns if c not in group],
                                              F.col("up").alias(p))

    level = 0
    while (parts - 1) >> (FANOUT * level):
        level += 1
    pairs = boxes(level).select(*group, F.col("iv").alias("a"), F.col("iv").alias("b"))
    for at in range(level - 1, -1, -1):
        down = boxes(at)
        up = F.shiftright("iv", FANOUT)
        pairs = (pairs.join(side(down, "a", up), [*group, "a"]).join(side(down, "b", up), [*group, "b"])
                 .filter((F.col("aiv") <= F.col("biv")) & near("a", "b"))
                 .select(*group, F.col("aiv").alias("a"), F.col("biv").alias("b")))
    segs = index.select(*group, "seg", "part", "file", "at", "size", "rows", "lo", "hi")
    up = F.col("part")
    found = (pairs.join(side(segs, "a", up), [*group, "a"]).join(side(segs, "b", up), [*group, "b"])
             .filter((F.col("aseg") <= F.col("bseg")) & near("a", "b")))
    keep = [f"{p}{c}" for p in "ab" for c in ("seg", "file", "at", "size", "rows")]
    return write_shared(found.select("dim", *keep), "ego-pairs")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors of its label with a
    cosine of at least ``threshold`` to it), component_id (the smallest id
    reachable over links, its own included) and kept (it is that id).

    Rows whose label is null, or whose vector is null, empty, all zero or holds
    a null or non-finite component, link with nothing and stay their own
    component. Vectors of different lengths do not link. Equal vectors, also
    whole repeated rows, link with each other; a null id is a component's id
    only where all of its ids are null, and is kept there. An empty table gives
    an empty table; other columns are left out, whatever their names. Any label
    and any group of near copies may be large: what a task holds is two
    segments, and it returns at most a row for each of their vectors."""
    spark = vectors.sparkSession
    if not 0.0 < threshold < 1.0:
        raise ValueError("threshold must be between 0 and 1")
    q = lambda c: F.col(f"`{c}`")
    kind = vectors.schema[vector_col].dataType
    x = q(vector_col) if isinstance(kind.elementType, T.FloatType) else q(vector_col).cast("array<double>")
    rows = vectors.select(q(id_col).cast("bigint").alias("id"), q(label_col).cast("string").alias("label"), x.alias("x"))
    item = _item(rows.schema["x"].dataType)
    main = principal_axes(rows.filter("label is not null"), "x", unit=True, limit=LEAD)
    real = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & real & F.exists("x", lambda v: v != 0), F.lit(False))
    alone = rows.filter(~usable).select(F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"),
                                        F.lit(True).alias("kept"))
    if main is None:
        return alone
    cell = float(np.sqrt(max(2.0 - 2.0 * threshold, 1e-12))) / 2
    n = rows.filter(usable).count()
    parts = max(-(-n // SEGMENT_ROWS), min(spark.sparkContext.defaultParallelism, -(-n // LEAF)), 1)
    root = shared_path(spark, "ego-segments")
    written = _segments(_keyed(rows.filter(usable), main, cell), root, parts, item, main)
    index, members = written.filter("seg is not null"), written.filter("node is not null").select("vec_id", "node", "n", "first")
    pairs = _segment_pairs(index, parts, threshold)
    cost = pairs.agg(F.sum(F.col("arows").cast("double") * F.col("brows")).alias("c"), F.count("*").alias("n")).first()
    tasks = max(1, min(cost["n"], max(int((cost["c"] or 0) // PAIRS_PER_TASK), 4 * spark.sparkContext.defaultParallelism)))

    def compare(batches):
        reader, held = BlockReader(), {}

        def segment(seg, file, at, size, n, dim, other):
            if seg not in held:
                for k in [k for k in held if k != other]:
                    del held[k]
                held[seg] = Segment(reader.read(file, at, size), n, dim, item, _axes(dim, main))
            return held[seg]

        for b in batches:
            for dim, *ab in zip(*(c.to_pylist() for c in b.columns)):
                one = segment(*ab[:5], dim, ab[5])
                two = segment(*ab[5:], dim, ab[0])
                at, links, root = join_segments(one, two, threshold)
                if not len(at):
                    continue
                node = one.node if one is two else np.append(one.node, two.node)
                first = one.first if one is two else np.append(one.first, two.first)
                yield pa.record_batch([pa.array(node[at]), pa.array(first[at], mask=first[at] == -(1 << 63)), pa.array(links), pa.array(node[root])],
                                      ["node", "first", "links", "root"])
        reader.close()

    found = write_shared(pairs.repartition(tasks, "aseg", "bseg").sortWithinPartitions("aseg", "bseg")
                         .mapInArrow(compare, "node bigint, first bigint, links bigint, root bigint"), "ego-links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"), F.max("first").alias("first"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).filter("a <> b"))
    linked = write_shared(linked.join(roots, "node"), "ego-linked")
    smallest = linked.groupBy("root").agg(F.min("first").alias("cid"))
    linked = linked.join(smallest, "root").select("node", "links", "cid")
    out = members.join(linked, "node", "left")
    cid = F.when(F.col("links").isNull(), F.col("first")).otherwise(F.col("cid"))
    out = out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), cid.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).unionByName(alone)


def op11_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
