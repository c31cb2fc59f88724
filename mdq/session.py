"""SparkSession factory and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Set only where the submit (command line, defaults file) leaves them unset.
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    # Size post-shuffle partitions by bytes (advisory 64 MB), not by core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join next to a DISTINCT or aggregate on the same key may still be split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No broadcast from file-size estimates; AQE converts a join after the
    # shuffle has measured the side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
}


def submitted_conf() -> dict[str, str]:
    """Settings that spark-submit, the defaults file or a running context
    already fix, read from a SparkConf that loads them."""
    from pyspark import SparkConf, SparkContext
    if SparkContext._active_spark_context is not None:
        return dict(SparkContext._active_spark_context.getConf().getAll())
    SparkContext._ensure_initialized()
    return dict(SparkConf(loadDefaults=True, _jvm=SparkContext._jvm).getAll())


def get_session(master: str | None = None, app: str = "mdq",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session.

    The cluster decides: a master is set only when the caller names one, and
    each of ``DEFAULTS`` only when the submit leaves it unset. Without any
    master Spark's own rule holds (an error, or the submitted default).
    """
    running = SparkSession.getActiveSession()
    if running is not None and not master:
        return running
    given = submitted_conf()
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    parts = shuffle_partitions or int(os.environ.get("MDQ_SHUFFLE_PARTITIONS", "0") or 0)
    if parts:
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    for k, v in DEFAULTS.items():
        if k not in given:
            b = b.config(k, v)
    if "MDQ_DRIVER_MEMORY" in os.environ and "spark.driver.memory" not in given:
        b = b.config("spark.driver.memory", os.environ["MDQ_DRIVER_MEMORY"])
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only when the setting is missing and the
    master is local (tests, one machine); on a cluster its absence is an error.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if cur:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(cur)
        return cur
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="mdq-ckpt-")
    sc.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_shared(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.
    This cuts the lineage: a lost executor re-reads files, nothing is redone."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Jobs that run at a time.
AT_ONCE = 3


def write_parts(spark: SparkSession, frames, name: str) -> DataFrame:
    """The union of ``frames`` (same columns), each written by a job of its own
    into a folder of its own of one new shared folder, read back by one scan.
    Every task reports all metrics of its stage to the driver; those of one frame
    are few, those of a union of many are not. ``AT_ONCE`` of the jobs run at a
    time, so that one's last tasks leave no core idle."""
    path = shared_path(spark, name)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        jobs = [(df, f"{path}/{i}") for i, df in enumerate(frames)]
        for job in [pool.submit(inheritable_thread_target(spark)(df.write.parquet), to, compression="zstd") for df, to in jobs]:
            job.result()
    return spark.read.schema(jobs[0][0].schema).parquet(*[to for _, to in jobs])


#: Files of one input from which tasks are counted by size, and file bytes for each.
LARGE_BYTES, PART_BYTES = 32 << 20, 4 << 20


def parts_by_size(df: DataFrame) -> int:
    """How many partitions the rows of ``df`` should be dealt to, by the size of
    the files it reads, never fewer than ``spark.sql.shuffle.partitions``; 0 for
    small input, where Spark's own choice will do."""
    spark, size = df.sparkSession, 0
    for f in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(-(-size // PART_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))) if size > LARGE_BYTES else 0


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, unless they
    find it already (it is on the submitted PYTHONPATH) or were given it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_mdq_shipped", False):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="mdq-ship-"), "mdq.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "mdq")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(name)
    sc._mdq_shipped = True
