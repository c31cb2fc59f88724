"""Helpers of the training-data operators: shared files, bounded samples,
connected components."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.session import ship_package, shared_path, write_shared  # noqa: F401

WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder in shared storage (file, hdfs, s3, ...)."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def write_file(uri: str, parts) -> None:
    """Write byte pieces to ``uri`` under a temporary name, then rename: a
    reader never sees half a file, and a lost task leaves nothing under it."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with fs.open_output_stream(tmp) as out:
        for p in parts:
            out.write(p)
    fs.move(tmp, path)


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free_prefix(columns, base: str) -> str:
    """A prefix that no column of the input has, for an operator's own columns."""
    p = f"{base}__"
    while any(c.lower().startswith(p) for c in columns):
        p = f"_{p}"
    return p


def crc_mod(col: str, n: int):
    """crc32 of the id as text, modulo n (null ids: 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % n, F.lit(0))


def hash_unit(*cols, seed: int):
    """A uniform number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def remove_shared(spark: SparkSession, paths) -> None:
    """Delete tables of the shared folder that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as (a, b) rows of longs.

    Returns (node, root), root the smallest node of the component, for every
    node in ``edges``. Alternates the two star operations of Kiveris et al.
    (every neighbour larger than a node is linked to the node's smallest
    neighbour; then the same among the smaller ones), which needs O(log n)
    rounds in practice. Each round is written to the shared folder, and once
    its links are written, nothing reads what it was made from: those tables are
    deleted, so the folder holds two rounds at most. Minima are combined before
    the shuffle, and the joins are between two plain shuffles, so a node with
    very many links can be split by AQE.
    Self links, repeated links and empty input are fine.
    """
    spark, written = edges.sparkSession, []

    def write(df: DataFrame, name: str) -> DataFrame:
        written.append(shared_path(spark, name))
        df.write.parquet(written[-1])
        return spark.read.schema(df.schema).parquet(written[-1])

    e = write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        got = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                    F.sum(F.shiftright(F.xxhash64("v", "u"), 24)).alias("s")).first()
        if got == state or got["n"] == 0:
            break
        state = got
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-min")
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = write(large, "cc-large")                       # u > v
        low = write(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).filter("u <> v")
        e = write(small.distinct(), "cc")
        remove_shared(spark, written[:-1])
        del written[:-1]
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
