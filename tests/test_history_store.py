"""The stored history: any order of dates, broken runs, competing runs, plans."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import types as T

from mdq.plans.history import append_history, change_history, finished_runs, read_history
from mdq.plans.history_store import FIELDS, HistoryStore
from mdq.plans.manifest import Manifest

SNAP = T.StructType([T.StructField(n, t) for n, t in [
    ("SNAPSHOT_DATE", T.DateType()), ("SOURCE_SYSTEM", T.StringType()), ("GMID", T.StringType()),
    ("ATTRIBUTE", T.StringType()), ("COMPLETENESS", T.IntegerType()), ("ACCURACY", T.IntegerType())]])
DATES = [dt.date(2020, 1, i) for i in (1, 2, 4, 8, 16)]
KEYS = [("S", "A"), ("S", "B"), (None, "A"), ("S", None), ("S", ""), ("S", "\x00"), ("S", "\x00x"), (None, None)]


def snapshots(spark, seed, dates=DATES):
    """Random flags; each key is absent at some dates."""
    r = random.Random(seed)
    rows = [(d, *k, a, r.randint(0, 1), r.choice([0, 1, None])) for d in dates for k in KEYS for a in ("X", "Y") if r.random() < 0.75]
    return spark.createDataFrame(rows, SNAP)


def rows(df):
    return sorted((tuple(r) for r in df.select(*FIELDS.names).collect()), key=str)


def wanted(snaps, dates):
    dates = sorted(dates)
    return rows(change_history(snaps.where(snaps.SNAPSHOT_DATE.isin(dates)), [d.isoformat() for d in dates]))


def of(snaps, d):
    return snaps.where(snaps.SNAPSHOT_DATE == d).drop("SNAPSHOT_DATE")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_dates_gives_the_same_history(spark, tmp_path, seed):
    snaps, wrong, done = snapshots(spark, seed), snapshots(spark, seed + 50), []
    store = HistoryStore(spark, str(tmp_path / "h"), buckets=4)
    for d in random.Random(seed).sample(DATES, len(DATES)):
        store.put(of(snaps, d), d.isoformat())
        done.append(d)
        assert rows(store.read()) == wanted(snaps, done)
    for d in DATES:                                            # as it was known at each date
        assert rows(store.read(d.isoformat())) == wanted(snaps, [x for x in DATES if x <= d])
    d = random.Random(seed).choice(DATES)
    store.put(of(wrong, d), d.isoformat())                     # a wrong rerun of any date, then the right one
    assert rows(store.read()) != wanted(snaps, DATES)
    store.put(of(snaps, d), d.isoformat())
    assert rows(store.read()) == wanted(snaps, DATES)
    store.put(None, d.isoformat())                             # and the date taken out
    assert rows(store.read()) == wanted(snaps, [x for x in DATES if x != d])
    assert store.dates() == [x.isoformat() for x in DATES if x != d]


def test_a_history_may_lose_all_its_dates(spark, tmp_path):
    snaps, store = snapshots(spark, 4), HistoryStore(spark, str(tmp_path / "h"), buckets=2)
    store.put(of(snaps, DATES[0]), "2020-01-01")
    store.put(None, "2020-01-01")
    assert store.dates() == []
    with pytest.raises(ValueError):
        store.read()
    with pytest.raises(ValueError):
        store.put(None, "2020-01-01")
    store.put(of(snaps, DATES[1]).limit(0), "2020-01-02")      # an empty snapshot is a run
    store.put(of(snaps, DATES[2]), "2020-01-04")
    assert rows(store.read()) == wanted(snaps, DATES[2:3])


@pytest.mark.parametrize("where", ["write", "commit", "rename"])
def test_a_broken_run_leaves_no_trace(spark, tmp_path, monkeypatch, where):
    snaps, root = snapshots(spark, 5), str(tmp_path / "h")
    append_history(of(snaps, DATES[0]), root, "2020-01-01", new_history=True)
    with monkeypatch.context() as m:
        def broken(*a, **k):
            raise RuntimeError("lost")
        if where == "write":                                   # the folder is there, the run did not finish
            write = HistoryStore._write
            m.setattr(HistoryStore, "_write", lambda *a: (write(*a), broken()))
        elif where == "commit":
            m.setattr(Manifest, "commit", broken)
        else:                                                  # the state was written and not yet renamed
            m.setattr("json.dumps", lambda *a, **k: "{")
            m.setattr(Manifest, "versions", lambda self, seen=[]: (seen.append(1), broken())[1] if len(seen) else (seen.append(1), [1])[1])
        with pytest.raises(RuntimeError):
            append_history(of(snaps, DATES[1]), root, "2020-01-02")
    assert finished_runs(spark, root) == ["2020-01-01"]
    append_history(of(snaps, DATES[2]), root, "2020-01-04")     # the next day goes on as if nothing had been
    assert rows(read_history(spark, root)) == wanted(snaps, [DATES[0], DATES[2]])
    append_history(of(snaps, DATES[1]), root, "2020-01-02", late=True)
    assert rows(read_history(spark, root)) == wanted(snaps, DATES[:3])
    store = HistoryStore(spark, root)
    assert store.clean() == []                                  # young folders may belong to a running job
    gone = store.clean(older_than_hours=0.0)
    assert gone and rows(store.read()) == wanted(snaps, DATES[:3])


def test_of_two_competing_runs_one_is_refused(spark, tmp_path, monkeypatch):
    snaps, root = snapshots(spark, 6), str(tmp_path / "h")
    a, b = HistoryStore(spark, root, buckets=2), HistoryStore(spark, root, buckets=2)
    a.put(of(snaps, DATES[0]), "2020-01-01")
    write = HistoryStore._write
    def overtaken(self, *args):
        write(self, *args)
        monkeypatch.setattr(HistoryStore, "_write", write)
        b.put(of(snaps, DATES[1]), "2020-01-02")
    monkeypatch.setattr(HistoryStore, "_write", overtaken)
    with pytest.raises(RuntimeError, match="another run"):
        a.put(of(snaps, DATES[2]), "2020-01-04")
    assert rows(a.read()) == wanted(snaps, DATES[:2])


def test_manifest_states(spark, tmp_path):
    m = Manifest(spark, str(tmp_path / "m"))
    assert m.read() == (0, {}) and m.versions() == []
    assert m.commit(0, {"a": "ä"}) == 1 and m.commit(1, {"a": 2}) == 2
    assert m.read() == (2, {"a": 2}) and m.read(1) == (1, {"a": "ä"})
    with pytest.raises(RuntimeError):
        m.commit(1, {"a": 3})
    os.makedirs(tmp_path / "m" / "_manifest", exist_ok=True)
    (tmp_path / "m" / "_manifest" / ".half.tmp").write_text("{")
    assert m.read() == (2, {"a": 2})


def test_the_daily_join_does_not_shuffle_the_history(spark, tmp_path, monkeypatch):
    snaps, store = snapshots(spark, 7), HistoryStore(spark, str(tmp_path / "h"), buckets=4)
    store.put(of(snaps, DATES[0]), "2020-01-01")
    plans = []
    write = HistoryStore._write
    monkeypatch.setattr(HistoryStore, "_write", lambda self, out, *a: (plans.append(out._jdf.queryExecution().executedPlan().toString()),
                                                                       write(self, out, *a))[1])
    store.put(of(snaps, DATES[1]), "2020-01-02")
    plan = plans[0]
    left, right = plan[plan.index("SortMergeJoin"):].split("Exchange", 1)
    assert plan.count("Exchange") == 1                          # the snapshot's
    assert "FileScan parquet" in left and "Bucketed: true" in left
    files = [f for d, _, fs in os.walk(tmp_path / "h" / "AS_OF=2020-01-02") for f in fs if f.endswith(".parquet") and "IS_OPEN=1" in d]
    assert 0 < len(files) <= 4                                  # a file for each bucket


def test_late_snapshots_rewrite_only_later_folders(spark, tmp_path):
    snaps, root = snapshots(spark, 8), str(tmp_path / "h")
    store = HistoryStore(spark, root, buckets=2)
    for d in (DATES[0], DATES[1], DATES[2], DATES[4]):
        store.put(of(snaps, d), d.isoformat())
    before = {f["path"] for f in store.manifest.read()[1]["closed"]}
    store.put(of(snaps, DATES[3]), DATES[3].isoformat())
    after = {f["path"] for f in store.manifest.read()[1]["closed"]}
    assert {p for p in before if "AS_OF=2020-01-16" not in p} < after and len(after - before) == 1
    assert rows(store.read()) == wanted(snaps, DATES)
