"""X5: dated history of the conformed flags.

``write_snapshot`` stores the conformed view of one run under
``<root>/SNAPSHOT_DATE=<date>`` (dynamic partition overwrite, so a retried
run replaces its own date only). ``change_history`` turns any set of
snapshots into validity intervals: one row per key and run of consecutive
snapshots with the same flags; VALID_TO is the first snapshot date at which
the flags differ or the key is absent, NULL while still current.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdq.plans.catalog import enabled_rules
from mdq.plans.conform import KEY, conformed_at_dates, conformed_parts, conformed_rule, conformed_rule_at, conformed_suite
from mdq.plans.history_store import HistoryStore
from mdq.plans.records import RULES as RECORD_RULES, record_parts
from mdq.session import write_parts
from mdq.sources.tables import TABLE_NAMES, Tables

col = F.col

# Fixed parameters of the registered history query.
HISTORY_DATES = ("1998-06-30", "1998-12-31", "1999-06-30")


def write_snapshot(conf: DataFrame, root: str, as_of: str) -> None:
    """Store the snapshot of one date. A rerun replaces that date's folder,
    also when it now has no rows."""
    conf.write.mode("overwrite").parquet(f"{root.rstrip('/')}/SNAPSHOT_DATE={as_of}")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def _date_index(spark: SparkSession, dates) -> DataFrame:
    schema = T.StructType([T.StructField("SNAPSHOT_DATE", T.StringType()), T.StructField("_i", T.IntegerType())])
    idx = spark.createDataFrame([(d, i) for i, d in enumerate(sorted(dates))], schema)
    return idx.withColumn("SNAPSHOT_DATE", col("SNAPSHOT_DATE").cast("date"))


def change_history(snapshots: DataFrame, dates) -> DataFrame:
    """Validity intervals per (SOURCE_SYSTEM, GMID, ATTRIBUTE).

    ``dates`` lists the snapshot dates taken (a key missing from one of them
    was absent that day). The date list is a run parameter, so the index
    table is small by construction and broadcast.
    """
    spark = snapshots.sparkSession
    idx = F.broadcast(_date_index(spark, dates))
    s = snapshots.join(idx, "SNAPSHOT_DATE")
    w = Window.partitionBy(*KEY).orderBy("_i")
    prev_i = F.lag("_i").over(w)
    new_run = (prev_i.isNull() | (prev_i != col("_i") - 1)
               | ~col("COMPLETENESS").eqNullSafe(F.lag("COMPLETENESS").over(w))
               | ~col("ACCURACY").eqNullSafe(F.lag("ACCURACY").over(w)))
    runs = (s.withColumn("_new", new_run.cast("int"))
            .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    g = (runs.groupBy(*KEY, "_run")
         .agg(F.min("_i").alias("_first"), F.max("_i").alias("_last"),
              F.max("COMPLETENESS").alias("COMPLETENESS"), F.max("ACCURACY").alias("ACCURACY")))
    start = idx.select(col("_i").alias("_first"), col("SNAPSHOT_DATE").alias("VALID_FROM"))
    end = idx.select((col("_i") - 1).alias("_last"), col("SNAPSHOT_DATE").alias("VALID_TO"))
    return (g.join(start, "_first").join(end, "_last", "left")
            .select(*KEY, col("COMPLETENESS").cast("int").alias("COMPLETENESS"),
                    col("ACCURACY").cast("int").alias("ACCURACY"), "VALID_FROM", "VALID_TO"))


def history_parts(t: Tables, dates, rules=None, written: bool = False) -> list[DataFrame]:
    """Validity intervals of the conformed flags evaluated at each date in
    ``dates`` over the same tables, as one frame for each family of rules and
    each other rule (no interval has rows of two attributes).

    A rule that does not read the as-of date gives the same flags at every
    date, so each of its keys is one interval from the first date, still
    open; only the date-dependent rules go through ``change_history``.
    ``written``: the rules on info records, PRDAT with them, over their one
    join (``records``).
    """
    rules = enabled_rules() if rules is None else rules
    fixed = [r for r in rules if not r.uses_as_of]
    dated = [r for r in rules if r.uses_as_of]
    open_ = [F.lit(min(dates)).cast("date").alias("VALID_FROM"), F.lit(None).cast("date").alias("VALID_TO")]
    first = []
    if written:
        def worst(df, r):
            return change_history(conformed_rule_at(df, r, list(dates)), dates) if r.uses_as_of else conformed_rule(df, r)
        joined = [r for r in rules if not r.uses_as_of or r.key in RECORD_RULES]
        first, others = record_parts(t, list(dates), joined, True, worst)
        fixed, dated = [r for r in fixed if r in others], [r for r in dated if r not in joined or r in others]
    shape = [*KEY, "COMPLETENESS", "ACCURACY", "VALID_FROM", "VALID_TO"]
    parts = first + (conformed_parts(t, None, fixed) if fixed else [])
    parts = [p if "VALID_FROM" in p.columns else p.select("*", *open_) for p in parts]
    return [p.select(*shape) for p in parts] + [change_history(conformed_at_dates(t, list(dates), [r]), dates) for r in dated]


def history_over_dates(t: Tables, dates, rules=None) -> DataFrame:
    """The union of ``history_parts``."""
    return reduce(DataFrame.unionByName, history_parts(t, dates, rules))


def history_query(spark: SparkSession, sf_dir: str, dates=HISTORY_DATES) -> DataFrame:
    """Conformed flags at each date in ``dates``, turned into intervals; the
    parts are written by jobs of their own (``write_parts``)."""
    return write_parts(spark, history_parts(Tables.from_tpch(spark, sf_dir, share=True), dates, written=True), "mdq-history")


def _moved(open_: DataFrame | None, snapshot: DataFrame, as_of: str) -> DataFrame:
    """What one snapshot makes of the open intervals: closed, still open, or new.

    One join on the key (null-safe: GMID may be NULL). Each pair gives the
    interval that was open (left open if the flags are the same, else closed at
    ``as_of``) and, for new or changed keys, one that starts at ``as_of``."""
    d = F.lit(as_of).cast("date")
    flags = ["COMPLETENESS", "ACCURACY"]
    snap = snapshot.select(*KEY, *[col(c).cast("int").alias(c) for c in flags])
    if open_ is None:
        return snap.select(*KEY, *flags, d.alias("VALID_FROM"), F.lit(None).cast("date").alias("VALID_TO"))
    o, n = open_.alias("o"), snap.alias("n")
    j = o.join(n, reduce(lambda a, b: a & b, [col(f"o.{k}").eqNullSafe(col(f"n.{k}")) for k in KEY]), "full")
    has_o, has_n = col("o.VALID_FROM").isNotNull(), col("n.ATTRIBUTE").isNotNull()   # never NULL where the side is there
    same = reduce(lambda a, b: a & b, [col(f"o.{c}").eqNullSafe(col(f"n.{c}")) for c in flags])

    def row(side, start, end):
        return F.struct(*[col(f"{side}.{c}").alias(c) for c in KEY + flags], start.alias("VALID_FROM"), end.cast("date").alias("VALID_TO"))
    rows = F.array(F.when(has_o, row("o", col("o.VALID_FROM"), F.when(~(has_n & same), d))),
                   F.when(has_n & ~(has_o & same), row("n", d, F.lit(None))))
    return j.select(F.explode(F.array_compact(rows)).alias("r")).select("r.*")


def advance_history(history: DataFrame | None, snapshot: DataFrame, as_of: str) -> DataFrame:
    """Add one snapshot, taken at ``as_of``, to the validity intervals, without
    rereading old snapshots.

    ``as_of`` must be later than every date in ``history``: a rerun of a date
    starts from the history before it. Closed intervals pass through; equal to
    ``change_history`` over all dates.
    """
    if history is None:
        return _moved(None, snapshot, as_of)
    newest = history.agg(F.greatest(F.max("VALID_FROM"), F.max("VALID_TO")).cast("string").alias("d")).first()["d"]
    if newest is not None and as_of <= newest:
        raise ValueError(f"the history already reaches {newest}; {as_of} is not later")
    moved = _moved(history.where(col("VALID_TO").isNull()), snapshot, as_of)
    return history.where(col("VALID_TO").isNotNull()).select(moved.columns).unionByName(moved)


def finished_runs(spark: SparkSession, root: str) -> list[str]:
    """The dates of the runs that the history's manifest names, in order."""
    return HistoryStore(spark, root).dates()


def read_history(spark: SparkSession, root: str, as_of: str | None = None) -> DataFrame:
    """The intervals after the run of ``as_of`` (default: the last one)."""
    return HistoryStore(spark, root).read(as_of)


def append_history(snapshot: DataFrame, root: str, as_of: str, new_history: bool = False, late: bool = False) -> None:
    """Add the snapshot of ``as_of`` to the history under ``root`` (``HistoryStore.put``).

    A rerun of the last date replaces it. An earlier date is spliced in, but
    only on request (``late``), and so is a history started, so a wrong date or
    a forgotten past is an error and not a loss."""
    store = HistoryStore(snapshot.sparkSession, root)
    runs = store.dates()
    if runs and as_of < runs[-1] and not late:
        raise ValueError(f"the history already reaches {runs[-1]}; {as_of} is earlier")
    before = [d for d in runs if d < as_of]
    if late and not runs or not late and new_history == bool(before):
        raise ValueError(f"{root} has a history up to {before[-1]}" if before else f"{root} has no history before {as_of}; ask for a new one")
    store.put(snapshot, as_of)


def daily_run(t, as_of: str, snapshot_root: str, history_root: str | None = None, new_history: bool = False,
              late: bool = False, reports: str | None = None, changes: str | None = None) -> DataFrame:
    """One scheduled run: conformed suite -> dated snapshot -> history (the
    snapshot appended to the earlier runs', or spliced in if it is ``late``) ->
    scorecard.

    The suite reads tables and shared views that are written once for the run.
    Under ``reports`` the run leaves, for its date, how many values of each
    source column could not be read (``sources``), these values
    (``quarantine``), and the sketches of the materials (``materials``).
    With ``changes``, a folder of a ``ChangeStore``, only the materials are
    evaluated that something reached since the last run there."""
    from mdq.plans.catalog import catalog_df
    from mdq.plans.changes import ChangeStore
    from mdq.plans.scorecard import material_sketches, scorecard

    spark = t.spark
    t = t.materialize(names=TABLE_NAMES if changes else None)
    write_snapshot(ChangeStore(spark, changes).run(t, as_of) if changes else conformed_suite(t, as_of), snapshot_root, as_of)
    snap = spark.read.parquet(f"{snapshot_root.rstrip('/')}/SNAPSHOT_DATE={as_of}")
    if history_root:
        append_history(snap, history_root, as_of, new_history, late)
    if reports:
        for name, df in (("sources", t.source_report()), ("quarantine", t.quarantined()), ("materials", material_sketches(snap, catalog_df(spark)))):
            df.write.mode("overwrite").parquet(f"{reports.rstrip('/')}/{name}/AS_OF={as_of}")
    return scorecard(snap, catalog_df(spark))
