"""Centroid clustering over zone maps of a space-filling curve.

Vectors of whole numbers are sorted along a Hilbert curve over their leading
principal axes and cut into blocks. The index keeps each block's box (lowest and
highest value of every component), its count and its componentwise sum. In each
round the distances between a block's box and the centroids bound what its
vectors can be nearest to: a centroid stays a candidate if its least distance to
the box is not over the least of the candidates' largest distances. A block with
one candidate gives its stored sum without being read; of any other the vectors
are read and compared with the candidates exactly, in whole numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.llm.blocks import BlockReader, BlockWriter, principal_axes, read_vectors, rows_of
from mdq.llm.common import read_table, shared_path, write_shared

SCALE = 1024
CLUSTERS, ROUNDS, SEED, DIM = 8, 10, "3", 64
CURVE_AXES, CURVE_BITS = 8, 7
BLOCK_ROWS = 1024
BLOCKS_PER_TASK = 64
LARGEST = 1 << 27               # a component's size at which squared distances could leave a long

INDEX = "file string, at bigint, size bigint, rows int, width int, lo array<bigint>, hi array<bigint>, total array<bigint>"


# -- Hilbert curve -----------------------------------------------------------
def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (whole numbers below 2^bits, one column
    for each axis) along the Hilbert curve, as an unsigned 64-bit number.

    Skilling's transposition, for all rows at once: undo the rotations and
    exchanges from the highest bit down, Gray-encode, then interleave the bits."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            flip = (x[i] >> b) & 1 == 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] >> b) & 1 == 1, turn ^ ((1 << b) - 1), turn)
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | ((x[i] >> b) & 1).astype(np.uint64)
    return key


# -- one block ---------------------------------------------------------------
def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that a vector inside the box may be nearest to."""
    near = np.maximum(0, np.maximum(lo - centroids, centroids - hi))
    far = np.maximum(np.abs(centroids - lo), np.abs(centroids - hi))
    return np.flatnonzero((near * near).sum(1) <= (far * far).sum(1).min())


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row, ties to the smaller number. All
    numbers are whole: below 2^53 a product of doubles is exact, beyond it the
    differences are squared as longs."""
    c = centroids[among]
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * largest * largest * x.shape[1] < 1 << 53:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        d = (np.einsum("ij,ij->i", xf, xf)[:, None] - 2.0 * (xf @ cf.T) + np.einsum("ij,ij->i", cf, cf)).astype(np.int64)
    else:
        d = np.stack([((x.astype(np.int64) - v) ** 2).sum(1) for v in c], axis=1)
    best = d.argmin(1)
    return among[best], d[np.arange(len(x)), best]


# -- on Spark ----------------------------------------------------------------
def _whole(vectors: DataFrame, dim: int, scale: int, main) -> DataFrame:
    """vec_id, key (place on the curve) and x (whole numbers, bytes) of the vectors kept."""
    axes = main[1][:, :CURVE_AXES] if main is not None else np.eye(dim, CURVE_AXES)

    def each(batches):
        for b in batches:
            ids = b.column(0)
            values, start, length, valid = read_vectors(b.column(1))
            rows = np.flatnonzero(valid & (length == dim))
            x = np.floor(rows_of(values, start, rows, dim) * float(scale))
            small = np.abs(x).max(axis=1, initial=0) < LARGEST
            rows, x = rows[small], x[small]
            lead = x @ axes / scale
            cells = np.clip(np.floor((np.tanh(lead) + 1.0) * (1 << (CURVE_BITS - 1))), 0, (1 << CURVE_BITS) - 1)
            raw = x.astype("<i4").tobytes()
            yield pa.record_batch([ids.take(pa.array(rows)), pa.array(hilbert_keys(cells, CURVE_BITS).astype(np.int64)),
                                   pa.array([raw[4 * dim * k:4 * dim * (k + 1)] for k in range(len(rows))], pa.binary())], ["vec_id", "key", "x"])
    return vectors.mapInArrow(each, "vec_id bigint, key bigint, x binary")


def write_blocks(whole: DataFrame, root: str, dim: int, parts: int) -> DataFrame:
    """Sort along the curve, write blocks, return their written index (the zone map)."""
    def write(batches):
        out = BlockWriter(root)

        def block(ids, xs):
            x = np.frombuffer(b"".join(xs), "<i4").reshape(-1, dim)
            width = 2 if np.abs(x).max() < 1 << 15 else 4
            known = np.array([i is not None for i in ids], np.uint8)
            named = np.array([0 if i is None else i for i in ids], "<i8")
            at, size = out.add(x.astype(f"<i{width}").tobytes(), named.tobytes(), known.tobytes())
            return [out.name, at, size, len(x), width, x.min(0).tolist(), x.max(0).tolist(), x.sum(0, dtype=np.int64).tolist()]

        def index(rows):
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in INDEX.split(", ")])

        ids, xs, rows = [], [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            xs += b.column(1).to_pylist()
            while len(xs) >= BLOCK_ROWS:
                rows.append(block(ids[:BLOCK_ROWS], xs[:BLOCK_ROWS]))
                del ids[:BLOCK_ROWS], xs[:BLOCK_ROWS]
            if len(rows) >= 1000:
                yield index(rows)
                rows = []
        if xs:
            rows.append(block(ids, xs))
        out.close()
        if rows:
            yield index(rows)

    order = ["key", "vec_id", "x"]
    return write_shared(whole.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "x").mapInArrow(write, INDEX), "zone-map")


def _each_block(index: DataFrame, dim: int, tasks: int) -> DataFrame:
    return index.repartition(tasks, "file", "at").sortWithinPartitions("file", "at")


def _load(reader: BlockReader, file: str, at: int, size: int, rows: int, width: int, dim: int):
    raw = reader.read(file, at, size)
    x = np.frombuffer(raw, f"<i{width}", rows * dim).reshape(rows, dim)
    end = rows * dim * width
    return x, np.frombuffer(raw, "<i8", rows, end), np.frombuffer(raw, np.uint8, rows, end + 8 * rows)


def _box(b: pa.RecordBatch, k: int, name: str) -> np.ndarray:
    return np.asarray(b.column(b.schema.get_field_index(name))[k].values)


def move_centroids(index: DataFrame, centroids: list[list[int]], tasks: int) -> list[list[int]]:
    """Centroids after one round: floor(sum / count) of each component over the
    vectors nearest to it; one without vectors stays. The driver gets a number
    for each cluster and component."""
    dim, held = len(centroids[0]), np.array(centroids, np.int64)

    def assign(batches):
        reader = BlockReader()
        n, total = np.zeros(len(held), np.int64), np.zeros((len(held), dim), np.int64)
        for b in batches:
            for k, (file, at, size, rows, width) in enumerate(zip(*(b.column(i).to_pylist() for i in range(5)))):
                among = candidates(_box(b, k, "lo"), _box(b, k, "hi"), held)
                if len(among) == 1:
                    n[among] += rows
                    total[among] += _box(b, k, "total")
                    continue
                x, _, _ = _load(reader, file, at, size, rows, width, dim)
                cluster, _ = nearest(x, held, among)
                for c in np.unique(cluster).tolist():
                    own = cluster == c
                    n[c] += int(own.sum())
                    total[c] += x[own].sum(0, dtype=np.int64)
        reader.close()
        at, to = np.nonzero(np.broadcast_to(n[:, None] > 0, total.shape))
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(to.astype(np.int32)), pa.array(n[at]), pa.array(total[at, to])],
                              ["cluster", "j", "n", "s"])

    sums = (_each_block(index, dim, tasks).mapInArrow(assign, "cluster int, j int, n bigint, s bigint").groupBy("cluster", "j")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    moved = [list(c) for c in centroids]
    for r in sums:
        moved[r["cluster"]][r["j"]] = int(r["s"]) // int(r["n"])
    return moved


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED, dim: int = DIM, scale: int = SCALE,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 of every vector kept: those of exactly ``dim`` components,
    none null or non-finite, each turned into floor(``scale`` * x).

    Vectors with a component of 2^27 or more after scaling are not kept either:
    their squared distances could leave a long. The first centroids are the
    ``k`` vectors (fewer, if there are fewer) of the smallest SHA-256 of
    "seed:id" (a null id is "null"; rows that repeat an id in the order of their
    numbers). Repeated rows count each; an empty table, or one without a vector
    kept, gives an empty table; other columns are left out."""
    spark = vectors.sparkSession
    q = lambda c: F.col(f"`{c}`")
    rows = vectors.select(q(id_col).cast("bigint").alias("vec_id"), q(vector_col).cast("array<double>").alias("x"))
    whole = _whole(rows, dim, scale, principal_axes(rows, "x", unit=False, limit=CURVE_AXES, dim=dim))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = whole.select(named.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = [np.frombuffer(r["x"], "<i4").tolist() for r in first]
    wanted = max(spark.sparkContext.defaultParallelism, 1)
    index = write_blocks(whole, shared_path(spark, "zone-blocks"), dim, wanted_parts(rows, wanted))
    tasks = max(1, min(index.count(), max(-(-index.count() // BLOCKS_PER_TASK), wanted)))
    for _ in range(rounds):
        moved = move_centroids(index, centroids, tasks)
        if moved == centroids:                                  # every later round would repeat this one
            break
        centroids = moved
    held = np.array(centroids, np.int64)

    def place(batches):
        reader = BlockReader()
        for b in batches:
            for n, (file, at, size, rows, width) in enumerate(zip(*(b.column(i).to_pylist() for i in range(5)))):
                x, ids, known = _load(reader, file, at, size, rows, width, dim)
                c, d = nearest(x, held, candidates(_box(b, n, "lo"), _box(b, n, "hi"), held))
                yield pa.record_batch([pa.array(ids, mask=known == 0), pa.array(c.astype(np.int32)), pa.array(d)], ["vec_id", "cluster", "distance"])
        reader.close()

    placed = write_shared(_each_block(index, dim, tasks).mapInArrow(place, "vec_id bigint, cluster int, distance bigint"), "zone-placed")
    sums = {r["cluster"]: int(r["s"]) for r in
            placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    per = spark.createDataFrame([(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()],
                                "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def wanted_parts(rows: DataFrame, parallel: int) -> int:
    """Sort partitions: some 256 blocks each, more where cores would idle."""
    n = rows.count()
    return max(1, -(-n // (256 * BLOCK_ROWS)), min(parallel, -(-n // BLOCK_ROWS)))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(spark, sf_dir, "embeddings"))


def _op13_sql() -> str:
    """The same rounds in SQL: a row per vector and component."""
    parts = [f"""
v AS MATERIALIZED (SELECT vec_id, u.j, floor({SCALE} * embedding[u.j]::DOUBLE)::BIGINT AS x
      FROM (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIM}
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIM}) k, range(1, {DIM + 1}) u(j)),
s AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM v)
      QUALIFY k < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT k, j, x AS c FROM v JOIN s USING (vec_id))"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, d * {CLUSTERS} + k) AS k, min(d) AS d
      FROM (SELECT vec_id, k, SUM((x - c) * (x - c)) AS d FROM v JOIN c{r} USING (j) GROUP BY vec_id, k) GROUP BY vec_id)""")
        if r < ROUNDS:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (SELECT o.k, o.j, COALESCE(m.c, o.c) AS c FROM c{r} o
      LEFT JOIN (SELECT k, j, (SUM(x)::BIGINT - ((SUM(x)::BIGINT % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS c
                 FROM v JOIN a{r} USING (vec_id) GROUP BY k, j) m ON o.k = m.k AND o.j = m.j)""")
    return f"""WITH {','.join(parts)},
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS digest FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, (SUM(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (SUM(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM a{ROUNDS} JOIN h USING (k)"""


OP13_SQL = _op13_sql()
