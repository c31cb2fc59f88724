"""Catalog, history intervals, scorecard and command line."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from mdq.operators import RULES
from mdq.plans.catalog import catalog_df, enabled_rules
from mdq.plans.history import change_history, read_snapshots, write_snapshot


def test_catalog_covers_every_rule(spark):
    cat = catalog_df(spark)
    rows = {r["attribute"]: r for r in cat.collect()}
    assert len(rows) == 31 == len(RULES)
    assert {r.attribute for r in RULES.values()} == set(rows)
    assert [a for a, r in rows.items() if not r["run_in_engine"]] == ["LOEKZ"]
    assert len(enabled_rules()) == 30
    assert rows["LVORM"]["polarity"] == "OK=1"
    assert rows["dock to stock lead time"]["criticality"] == "Medium"


SNAP = T.StructType([T.StructField(n, t) for n, t in [
    ("SNAPSHOT_DATE", T.DateType()), ("SOURCE_SYSTEM", T.StringType()), ("GMID", T.StringType()),
    ("ATTRIBUTE", T.StringType()), ("COMPLETENESS", T.IntegerType()), ("ACCURACY", T.IntegerType())]])


def test_change_history_runs_gaps_and_nulls(spark):
    d = [dt.date(2020, 1, i) for i in (1, 2, 3, 4)]
    rows = [(d[0], "S", "A", "X", 0, 0), (d[1], "S", "A", "X", 0, 0), (d[2], "S", "A", "X", 1, 0),
            (d[3], "S", "A", "X", 1, 0),
            (d[0], "S", "B", "X", 1, 1), (d[2], "S", "B", "X", 1, 1),
            (d[3], "S", None, "X", 0, None)]
    snaps = spark.createDataFrame(rows, SNAP)
    out = sorted((tuple(r) for r in change_history(snaps, [x.isoformat() for x in d]).collect()), key=str)
    assert out == sorted([
        ("S", "A", "X", 0, 0, d[0], d[2]), ("S", "A", "X", 1, 0, d[2], None),
        ("S", "B", "X", 1, 1, d[0], d[1]), ("S", "B", "X", 1, 1, d[2], d[3]),
        ("S", None, "X", 0, None, d[3], None)], key=str)


def test_snapshot_rewrite_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "snaps")
    conf = spark.createDataFrame([("S", "A", "X", 0, 0)], SNAP[1:])
    write_snapshot(conf, root, "2020-01-01")
    write_snapshot(conf, root, "2020-01-02")
    write_snapshot(conf, root, "2020-01-02")
    assert read_snapshots(spark, root).count() == 2


def test_empty_rerun_replaces_the_date(spark, tmp_path):
    root = str(tmp_path / "snaps")
    conf = spark.createDataFrame([("S", "A", "X", 0, 0)], SNAP[1:])
    write_snapshot(conf, root, "2020-01-01")
    write_snapshot(conf, root, "2020-01-02")
    write_snapshot(conf.limit(0), root, "2020-01-02")
    assert [str(r.SNAPSHOT_DATE) for r in read_snapshots(spark, root).collect()] == ["2020-01-01"]


def test_history_refuses_old_dates_and_a_forgotten_past(spark, tmp_path):
    from mdq.plans.history import advance_history, append_history, finished_runs
    snap = spark.createDataFrame([("S", "A", "X", 0, 0)], SNAP[1:])
    first = advance_history(None, snap, "2020-01-02")
    for d in ("2020-01-02", "2019-12-31"):
        with pytest.raises(ValueError):
            advance_history(first, snap, d)
    assert advance_history(first, snap.limit(0), "2020-01-03").collect()[0]["VALID_TO"] == dt.date(2020, 1, 3)
    root = str(tmp_path / "h")
    with pytest.raises(ValueError):                          # nothing to go on from
        append_history(snap, root, "2020-01-01")
    append_history(snap, root, "2020-01-02", new_history=True)
    for d, new in (("2020-01-01", False), ("2020-01-01", True), ("2020-01-03", True), ("2020-01-02", False)):
        with pytest.raises(ValueError):
            append_history(snap, root, d, new_history=new)
    assert finished_runs(spark, root) == ["2020-01-02"]


def test_stored_history_appends_and_reruns(spark, tmp_path):
    import os

    from mdq.plans.history import append_history, finished_runs, read_history
    d = [dt.date(2020, 1, i) for i in (1, 2, 3, 4, 5)]
    rows = [(d[0], "S", "A", "X", 0, 0), (d[1], "S", "A", "X", 1, 0), (d[3], "S", "A", "X", 1, 0),
            (d[0], "S", None, "X", 0, None), (d[1], "S", None, "X", 0, None), (d[4], "S", "B", "X", 1, 1)]   # nothing on the third day
    snaps = spark.createDataFrame(rows, SNAP)
    root, dates = str(tmp_path / "h"), [x.isoformat() for x in d]
    of = lambda x: snaps.where(snaps.SNAPSHOT_DATE == x).drop("SNAPSHOT_DATE")
    listing = lambda x: sorted(os.path.join(a, f) for a, _, fs in os.walk(f"{root}/AS_OF={x}") for f in fs)
    for i, x in enumerate(d):
        old = [listing(y) for y in dates[:i]]
        append_history(of(x).limit(0), root, dates[i], new_history=i == 0)     # a wrong run, then its rerun
        append_history(of(x), root, dates[i], new_history=i == 0)
        assert old == [listing(y) for y in dates[:i]]                            # earlier runs' files are left alone
        want = change_history(snaps.where(snaps.SNAPSHOT_DATE <= x), dates[:i + 1])
        assert sorted(map(tuple, read_history(spark, root).select(want.columns).collect()), key=str) == \
            sorted(map(tuple, want.collect()), key=str)
    for _ in range(2):                                                         # take back the last date's two states
        state = max(f for f in os.listdir(f"{root}/_manifest") if f.endswith(".json"))
        os.remove(f"{root}/_manifest/{state}")
        os.remove(f"{root}/_manifest/.{state}.crc")
    assert finished_runs(spark, root) == dates[:4]
    want = change_history(snaps.where(snaps.SNAPSHOT_DATE <= d[3]), dates[:4])
    assert sorted(map(tuple, read_history(spark, root).select(want.columns).collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(ValueError):
        read_history(spark, root, "2020-01-05")


def test_scorecard_levels_and_ko_listing(spark):
    from mdq.plans.scorecard import in_report_order, ko_listing, scorecard, scorecard_over_time
    rows = [("S", "M1", "LVORM", 1, 0), ("S", "M2", "MEINS", 0, 0), ("S", "M3", "dock to stock lead time", 0, 1), ("S", None, "EFFPR", 0, None)]
    conf = spark.createDataFrame(rows, RESULT)
    card = scorecard(conf, catalog_df(spark))
    by = {(r.CLASS, r.CRITICALITY, r.ATTRIBUTE): (r.LEVEL, r.N_KEYS, r.ANY_KO) for r in card.collect()}
    assert by[None, "Medium", None] == (5, 1, 1) and by[None, "High", None] == (5, 3, 1)
    assert by["Planning", None, None] == (3, 3, 2) and by[None, None, None] == (7, 4, 2)
    assert by["Customer Fulfillment", "High", "MEINS"] == (0, 1, 0) and len(by) == 9
    ko = in_report_order(ko_listing(conf, catalog_df(spark))).collect()
    assert [(r.CRITICALITY, r.GMID) for r in ko] == [("High", "M1"), ("Medium", "M3")]
    dated = conf.selectExpr("*", "explode(array(date'2020-01-01', date'2020-01-02')) AS SNAPSHOT_DATE")
    assert scorecard_over_time(dated, catalog_df(spark)).groupBy("SNAPSHOT_DATE").count().collect()[1]["count"] == 9


@pytest.mark.parametrize("key,table,change", [
    ("dq_to_gmid", "material", {"IS_ACTIVE": "false"}), ("dq_from_gmid", "material", {"IS_ACTIVE": "false"}),
    ("dq_effective_end_date", "part_dim", {"RELEVANCYKNX": "'0'"}), ("dq_kapid", "crca", {"KAPID": "'none'"}),
    ("dq_bstae", "lfm2", {"BSTAE": "'zz'"}), ("dq_loekz", "marc", {"LVORM": "'X'"}), ("dq_lvorm", "crhd", {"LVORM": "NULL"})])
def test_changed_dimension_is_seen_in_the_same_session(spark, tmp_path, key, table, change):
    from datapaths import SF_SMALL

    from mdq.sources.tables import Tables
    base = Tables.from_tpch(spark, SF_SMALL)
    root = str(tmp_path)
    from mdq.sources.tables import TABLE_NAMES
    paths = {n: f"{root}/{n}" for n in TABLE_NAMES}
    base[table].write.parquet(paths[table])
    t = Tables(spark, {n: (lambda n=n: spark.read.parquet(paths[n]) if n == table else base[n]) for n in TABLE_NAMES})
    before = sorted(map(tuple, RULES[key].fn(t, "1998-06-30").collect()), key=str)
    df = base[table]
    for c, v in change.items():
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.expr(v).cast(df.schema[c].dataType))
    df.write.mode("overwrite").parquet(paths[table])
    t = Tables(spark, {n: (lambda n=n: spark.read.parquet(paths[n]) if n == table else base[n]) for n in TABLE_NAMES})
    again = RULES[key].fn(t, "1998-06-30")
    assert sorted(map(tuple, again.collect()), key=str) != before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_advance_history_equals_full_recompute(spark):
    from mdq.plans.history import advance_history
    d = [dt.date(2020, 1, i) for i in (1, 2, 3, 4)]
    rows = [(d[0], "S", "A", "X", 0, 0), (d[1], "S", "A", "X", 0, 0), (d[2], "S", "A", "X", 1, 0),
            (d[3], "S", "A", "X", 1, 0),
            (d[0], "S", "B", "X", 1, 1), (d[2], "S", "B", "X", 1, 1),
            (d[1], "S", None, "X", 0, None), (d[2], "S", None, "X", 0, None), (d[3], "S", None, "X", 1, None)]
    snaps = spark.createDataFrame(rows, SNAP)
    dates = [x.isoformat() for x in d]
    full = sorted((tuple(r) for r in change_history(snaps, dates).collect()), key=str)
    hist = None
    for x in d:
        hist = advance_history(hist, snaps.where(snaps.SNAPSHOT_DATE == x).drop("SNAPSHOT_DATE"), x.isoformat())
        hist = spark.createDataFrame(hist.collect(), hist.schema)  # as if read back from storage
    assert sorted((tuple(r) for r in hist.select(*change_history(snaps, dates).columns).collect()), key=str) == full


@pytest.mark.parametrize("key", [k for k, r in RULES.items() if r.uses_as_of])
def test_dated_rules_give_all_dates_in_one_pass(spark, key):
    from functools import reduce

    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    from datapaths import SF_SMALL

    from mdq.plans.conform import conformed_at_dates, conformed_suite
    from mdq.sources.tables import Tables
    t, dates, rule = Tables.from_tpch(spark, SF_SMALL), ["1996-06-30", "1998-06-30", "1998-12-31"], [RULES[key]]
    got = conformed_at_dates(t, dates, rule)
    want = reduce(DataFrame.unionByName, [conformed_suite(t, d, rule).withColumn("SNAPSHOT_DATE", F.lit(d).cast("date")) for d in dates])
    rows = sorted(map(tuple, got.select(want.columns).collect()), key=str)
    assert rows == sorted(map(tuple, want.collect()), key=str) and len({r[-1] for r in rows}) == 3


def test_daily_runs_build_the_same_history(spark, tmp_path):
    from datapaths import SF_SMALL

    from mdq.plans.history import daily_run, history_query, read_history
    from mdq.sources.tables import Tables
    t = Tables.from_tpch(spark, SF_SMALL)
    dates = ["1998-06-30", "1999-06-30"]
    snaps, hist = str(tmp_path / "snaps"), str(tmp_path / "history")
    for i, d in enumerate(dates):
        card = daily_run(t, d, snaps, hist, new_history=i == 0).collect()
        assert len(card) > 0
    got = read_history(spark, hist)
    want = history_query(spark, SF_SMALL, dates)
    cols = want.columns
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_sql_views_and_cli(spark, tmp_path):
    from datapaths import SF_SMALL

    from mdq.__main__ import main
    from mdq.sql import register_views
    from mdq.sources.tables import Tables
    t = Tables.from_tpch(spark, SF_SMALL)
    register_views(spark, t, "1998-06-30")
    n_sql = spark.sql("SELECT COUNT(*) AS n FROM dq_to_site WHERE ACCURACY = 1").first()["n"]
    assert n_sql == RULES["dq_to_site"].fn(t, "1998-06-30").where("ACCURACY = 1").count()
    attrs = spark.sql("SELECT COUNT(DISTINCT ATTRIBUTE) AS n FROM dqm_conformed").first()["n"]
    assert attrs == len(enabled_rules())
    root = str(tmp_path / "erp")
    m = t.materialize(root, names=("bod",))
    assert main(["rule", "dq_to_site", "--tables-root", root, "--as-of", "1998-06-30",
                 "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.table("dq_to_site").count()
    assert m.bod.count() > 0


RESULT = T.StructType([T.StructField(n, t) for n, t in [
    ("SOURCE_SYSTEM", T.StringType()), ("GMID", T.StringType()), ("ATTRIBUTE", T.StringType()),
    ("COMPLETENESS", T.IntegerType()), ("ACCURACY", T.IntegerType())]])


def test_conformed_flips_polarity_and_keeps_worst(spark):
    from mdq.plans.conform import conformed, conformed_rule
    rows = [("S", "M1", "LVORM", 1, 1), ("S", "M1", "LVORM", 0, 1),      # 1 = OK in the rule
            ("S", "M2", "EFFPR", 0, None), ("S", "M2", "EFFPR", 1, None),
            ("S", "M3", "EFFPR", 0, 0), ("S", "M3", "EFFPR", 0, 1)]
    suite = spark.createDataFrame(rows, RESULT)
    via_catalog = sorted(map(tuple, conformed(suite, catalog_df(spark)).collect()), key=str)
    assert via_catalog == sorted([("S", "M1", "LVORM", 1, 0), ("S", "M2", "EFFPR", 1, None),
                                  ("S", "M3", "EFFPR", 0, 1)], key=str)
    per_rule = conformed_rule(suite.where("ATTRIBUTE = 'LVORM'"), RULES["dq_lvorm"]).unionByName(
        conformed_rule(suite.where("ATTRIBUTE = 'EFFPR'"), RULES["dq_effpr"]))
    assert sorted(map(tuple, per_rule.collect()), key=str) == via_catalog
