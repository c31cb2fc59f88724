"""The stored history (X5): validity intervals that take snapshots in any order.

``put`` adds, replaces or takes out the snapshot of one date. Only intervals
that are valid around that date change: with p and n the dates of the runs
before and after it, a key's states at p, at the date and at n decide which
intervals split, merge, start or end there (``splice``). All others stay as
they are, and so do the files they are in, unless a changed interval is there.

A run writes one folder, ``AS_OF=<date>/<run>``, with the intervals that are
still open (IS_OPEN=1) and those that it closed (IS_OPEN=0), and then commits a
new manifest. Folders without a manifest entry do not count, so a run may break
off anywhere. The open intervals are bucketed by their key: the daily run, which
joins them with the new snapshot, shuffles the snapshot and never the history.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdq.plans.conform import KEY
from mdq.plans.manifest import Manifest

col = F.col
FLAGS = ["COMPLETENESS", "ACCURACY"]
SPAN = ["VALID_FROM", "VALID_TO"]
FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in KEY] + [T.StructField(n, T.IntegerType()) for n in FLAGS]
                      + [T.StructField(n, T.DateType()) for n in SPAN])
DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FIELDS)
BUCKETS = 64
NONE = "\x00"                    # how a NULL key is stored: joins and buckets need values


def _stored(c: str):
    """Key column -> its stored form: NULL becomes a mark, a value that begins
    with the mark is written after another one."""
    return F.when(col(c).isNull(), F.lit(NONE)).when(col(c).startswith(NONE), F.concat(F.lit(NONE), col(c))).otherwise(col(c)).alias(c)


def _plain(c: str):
    return F.when(col(c) == NONE, F.lit(None)).when(col(c).startswith(NONE), F.expr(f"substring({c}, 2)")).otherwise(col(c)).alias(c)


def _same(a, b):
    """Both states are there and have equal flags."""
    return a.isNotNull() & b.isNotNull() & reduce(lambda x, y: x & y, [a[f].eqNullSafe(b[f]) for f in FLAGS])


def splice(around: DataFrame, date: str, before: str | None, after: str | None, present: bool) -> DataFrame:
    """The intervals of each key around ``date``.

    ``around``: the key and up to three structs, NULL where the key had no row:
    L, the interval valid at ``before`` (flags and VALID_FROM); M, the flags in
    the snapshot of ``date``; R, the interval valid at ``after`` (flags and
    VALID_TO). ``present``: whether ``date`` is a run (else it is taken out).
    Runs of equal states become one interval; it starts where L does if the
    state before is in it, ends where R does if the state after is in it, and
    otherwise starts and ends at the dates of the runs."""
    day = lambda d: F.lit(d).cast("date")
    points = [("L", before, col("L.VALID_FROM"))] if before else []
    points += [("M", date, day(date))] if present else []
    points += [("R", after, day(after))] if after else []
    rows = []
    for i, (name, _, start) in enumerate(points):
        # An interval begins at this point unless it goes on from the one before.
        begins = col(name).isNotNull()
        if i:
            begins = begins & ~_same(col(points[i - 1][0]), col(name))
        end = col("R.VALID_TO") if points[-1][0] == "R" else day(None)
        for j in range(len(points) - 1, i, -1):              # the first later point with another state ends it
            end = F.when(_same(col(points[j - 1][0]), col(points[j][0])), end).otherwise(day(points[j][1]))
        rows.append(F.when(begins, F.struct(*[col(f"{name}.{f}").alias(f) for f in FLAGS], start.alias("VALID_FROM"), end.alias("VALID_TO"))))
    if not rows:
        return around.select(*KEY).where("false").select(*KEY, *[F.lit(None).cast("int").alias(f) for f in FLAGS], *[day(None).alias(s) for s in SPAN])
    return around.select(*KEY, F.explode(F.array_compact(F.array(*rows))).alias("r")).select(*KEY, "r.*")


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.manifest = Manifest(spark, root)

    # -- reading ----------------------------------------------------------
    def dates(self) -> list[str]:
        """The dates of the finished runs, in order."""
        return self.manifest.read()[1].get("dates", [])

    def read(self, as_of: str | None = None) -> DataFrame:
        """The intervals as the runs up to ``as_of`` (default: all) give them."""
        _, state = self.manifest.read()
        dates = state.get("dates", [])
        if not dates or as_of is not None and as_of not in dates:
            raise ValueError(f"no finished run{f' of {as_of}' if as_of else ''} under {self.root}")
        rows = self._closed(state, dates[0]).unionByName(self._open(state)).select(*[_plain(c) for c in KEY], *FLAGS, *SPAN)
        if as_of is None or as_of == dates[-1]:
            return rows
        day = F.lit(as_of).cast("date")
        return rows.where(col("VALID_FROM") <= day).withColumn("VALID_TO", F.when(col("VALID_TO") <= day, col("VALID_TO")))

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], FIELDS)

    def _closed(self, state: dict, since: str) -> DataFrame:
        """Closed intervals of the folders that hold some that end at ``since`` or later."""
        paths = [f"{self.root}/{f['path']}" for f in state.get("closed", []) if f["to"] >= since]
        return self.spark.read.schema(FIELDS).parquet(*paths) if paths else self._none()

    def _open(self, state: dict) -> DataFrame:
        """Open intervals, as a table that knows its buckets."""
        if not state.get("open"):
            return self._none()
        name = f"mdq_open_{uuid.uuid4().hex}"
        path = f"{self.root}/{state['open']}"
        self.spark.sql(f"CREATE TABLE {name} ({DDL}) USING parquet CLUSTERED BY ({', '.join(KEY)}) SORTED BY ({', '.join(KEY)}) "
                       f"INTO {state['buckets']} BUCKETS LOCATION '{path}'")
        try:
            df = self.spark.table(name)
            df.schema
            return df
        finally:
            self.spark.sql(f"DROP TABLE {name}")            # the files stay: the table does not own them

    # -- writing ----------------------------------------------------------
    def put(self, snapshot: DataFrame | None, as_of: str) -> None:
        """Add the snapshot of ``as_of``, replace it where there is one, or take
        the date out (``snapshot`` None). The result is what the snapshots give
        in the order of their dates, whatever the order of the calls."""
        number, state = self.manifest.read()
        dates = state.get("dates", [])
        if snapshot is None and as_of not in dates:
            raise ValueError(f"no finished run of {as_of} under {self.root}")
        before = max((d for d in dates if d < as_of), default=None)
        after = min((d for d in dates if d > as_of), default=None)
        day = lambda d: F.lit(d).cast("date")
        snap = None
        if snapshot is not None:
            snap = snapshot.select(*[_stored(c) for c in KEY], F.struct(*[col(c).cast("int").alias(c) for c in FLAGS]).alias("M"))
        stays = None
        daily = after is None and as_of not in dates
        if daily:
            # The daily case: one join on the buckets; what is open is what is valid at ``before``.
            left = self._open(state).select(*KEY, F.struct(*FLAGS, "VALID_FROM").alias("L"))
            around = left.join(snap, KEY, "full").withColumn("R", F.lit(None))
        else:
            rows = self._closed(state, as_of).unionByName(self._open(state))
            at = lambda d: (col("VALID_FROM") <= day(d)) & (col("VALID_TO").isNull() | (col("VALID_TO") > day(d))) if d else F.lit(False)
            inside = (col("VALID_FROM") == day(as_of)) if as_of in dates else F.lit(False)
            rows = rows.withColumn("_l", at(before)).withColumn("_r", at(after)).withColumn("_in", inside)
            touched = col("_l") | col("_r") | col("_in")
            stays = rows.where(~touched).select(*KEY, *FLAGS, *SPAN)
            # At most one interval of a key is valid at a date, so each group has one row for L and one for R.
            sides = rows.where(touched).groupBy(*KEY).agg(
                F.first(F.when(col("_l"), F.struct(*FLAGS, "VALID_FROM")), True).alias("L"),
                F.first(F.when(col("_r"), F.struct(*FLAGS, "VALID_TO")), True).alias("R"))
            around = sides.join(snap, KEY, "full") if snap is not None else sides.withColumn("M", F.lit(None))
        out = splice(around, as_of, before, after, snapshot is not None)
        if stays is not None:
            out = out.unionByName(stays)
        folder = f"AS_OF={as_of}/run-{uuid.uuid4().hex[:12]}"
        if not daily or not state.get("open"):
            out = out.repartition(state.get("buckets", self.buckets), *KEY)      # one file for each bucket
        self._write(out, folder, state.get("buckets", self.buckets))
        new = sorted({*dates, as_of} - (set() if snapshot is not None else {as_of}))
        closed = [f for f in state.get("closed", []) if f["to"] < as_of]
        here = lambda k: f"{folder}/IS_OPEN={k}" if self.manifest.exists(f"{self.root}/{folder}/IS_OPEN={k}") else None
        if here(0):
            closed.append({"path": here(0), "to": new[-1]})
        self.manifest.commit(number, {"dates": new, "buckets": state.get("buckets", self.buckets), "open": here(1), "closed": closed})

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> None:
        name = f"mdq_run_{uuid.uuid4().hex}"
        (rows.select(*KEY, *FLAGS, *SPAN, col("VALID_TO").isNull().cast("int").alias("IS_OPEN"))
         .write.partitionBy("IS_OPEN").bucketBy(buckets, *KEY).sortBy(*KEY).format("parquet")
         .option("path", f"{self.root}/{folder}").saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")

    def clean(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete the folders that the newest state does not name and that were
        left alone for some hours: those of broken runs and those replaced."""
        _, state = self.manifest.read()
        used = {self.manifest.name(f"{self.root}/{p.rsplit('/', 1)[0]}") for p in [state.get("open"), *[f["path"] for f in state.get("closed", [])]] if p}
        gone = [p for p in self.manifest.folders("AS_OF=*/run-*") if p not in used and self.manifest.age_hours(p) >= older_than_hours]
        for p in gone:
            self.manifest.remove(p)
        return gone
