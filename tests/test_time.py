"""What the time of the large queries hangs on: code that the JVM compiles, few pairs of rows, one join for many rules."""

from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from mdq.functions.scope import prefix_scope
from mdq.operators import RULES, joins
from mdq.plans import records
from mdq.plans.conform import conformed_rule
from mdq.plans.history import HISTORY_DATES, history_over_dates, history_parts
from test_fused import AS_OF, bag, by_contract, odd_tables

#: The JVM leaves longer methods (bytes) uncompiled and interprets them for each row.
LONGEST = 8000


def longest_method(df):
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size()))


@pytest.fixture
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_code_of_the_conformed_records_is_compiled(spark, fixed_plans, tmp_path):
    rows, _ = records.records(odd_tables(spark, 90).materialize(str(tmp_path)), True)
    assert longest_method(rows) <= LONGEST


def prices(spark):
    """Units and states of a record that differ between its rows: met as sets, not in pairs."""
    eine, eina = [], []
    units = ["KG", " KG", "EA", "", " ", None]
    for i, u in enumerate(units):
        for n, z in ((1, 1), (2, 1), (1, 2), (None, 1), (1, None), (0, 0), (1, -1), (None, None)):
            for system in ("ATHENA", "XX_ATHENA", "OTHER", None):
                eine.append(dict(SOURCE_SYSTEM=system, INFNR=f"{i}-{n}-{z}", EKORG="P1", WERKS="W1", BPRME=u, BPUMN=n, BPUMZ=z, MINBM=[None, 4, 5, "0.0001", 100000000][(i + (n or 0)) % 5],
                                 UEBTO=[4, 5, None][i % 3], NETPR=[0, 1, None][i % 3], PEINH=[0, 1, None][i % 3], EFFPR=[0, None, 2][i % 3], MHDRZ=[0, 3651, 5][i % 3]))
            for j, m in enumerate(units):
                if (i + j + (z or 0)) % 3:
                    eina.append(dict(SOURCE_SYSTEM=["ATHENA", "XX_ATHENA", None, "P08"][(i + j) % 4], INFNR=f"{i}-{n}-{z}", MATNR=["M1", f"M{i}{j}", None][j % 3], LOEKZ=[None, "", "X"][(i + 2 * j) % 3], MEINS=m))
    marc = [dict(SOURCE_SYSTEM="ATHENA", MATNR=m, WERKS=w, BSTRF=b) for m in ("M1", "M01", "M10", "M31") for w, b in (("W1", 2), ("W1", [2, 4, 0, None][len(m)]), ("W2", 5))]
    mara = [dict(SOURCE_SYSTEM="ATHENA", MATNR=m) for m in ("M1", "M01", "M10")]
    return by_contract(spark, eine=eine, eina=eina, marc=marc, mara=mara)


def test_record_rules_of_sets_of_units(spark):
    t, rules = prices(spark), [RULES[k] for k in ("dq_bpumn", "dq_bpumz", "dq_minbm", "dq_netpr", "dq_uebto", "dq_mhdrz_eine")]
    got = bag(reduce(DataFrame.unionByName, records.record_parts(t, AS_OF, rules, True, conformed_rule)[0]))
    assert got == bag(reduce(DataFrame.unionByName, [conformed_rule(r.rows(t, AS_OF), r) for r in rules]))
    assert len({k[2:] for k in got}) > 10


def test_rows_of_a_material_are_one_before_the_join(spark):
    """Forty EINA rows of a record, system and material and ten EINE rows make ten rows, not four hundred."""
    eine = [dict(SOURCE_SYSTEM="P08", INFNR="1", WERKS="W1", BPRME="KG", BPUMN=1, BPUMZ=1, MINBM=i) for i in range(10)]
    eina = [dict(SOURCE_SYSTEM="P08", INFNR="1", MATNR="M", MEINS=f"U{i}") for i in range(40)]
    t = by_contract(spark, eine=eine, eina=eina)
    rows, names = records.records(t, True)
    assert "_state" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == 10 and t.eine.where(prefix_scope()).count() == 10


def test_history_over_the_one_join(spark):
    t, rules = odd_tables(spark, 91), [RULES[k] for k in ("dq_prdat", "dq_bstae", "dq_aplfz")]
    rows = lambda df: Counter(map(tuple, df.select("SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "COMPLETENESS", "ACCURACY", "VALID_FROM", "VALID_TO").collect()))
    got = rows(reduce(DataFrame.unionByName, history_parts(t, HISTORY_DATES, rules, written=True)))
    assert got == rows(history_over_dates(t, HISTORY_DATES, rules))
    assert {k[2] for k in got} == {"PRDAT", "BSTAE", "APLFZ"} and {k[6] for k in got if k[2] == "PRDAT"} != {k[6] for k in got if k[2] == "BSTAE"} == {None}


def test_copies_are_made_by_many_tasks(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 5000), ("b", 1), (None, 3), ("c", 1024), ("c", 1)], "k string, _n bigint").coalesce(1)
    want = Counter(r.k for r in joins.expand_copies(rows, "_n").collect())
    assert joins.spread_copies(rows, "_n").rdd.getNumPartitions() == 1
    monkeypatch.setattr(joins, "COPIES", 400)
    df = joins.spread_copies(rows, "_n")
    assert Counter(r.k for r in df.collect()) == want == {"a": 5000, "b": 1, None: 3, "c": 1025}
    made = [n for n in df.rdd.glom().map(len).collect() if n]
    assert len(made) > 3 and max(made) < 3500


def test_parts_are_written_by_jobs_at_a_time(spark, monkeypatch):
    """As many jobs as allowed are open together, all rows come back, and an error of one is an error of all."""
    import threading

    from pyspark.sql.readwriter import DataFrameWriter

    from mdq import session
    met, write, seen = threading.Barrier(session.AT_ONCE, timeout=60), DataFrameWriter.parquet, []

    def parquet(self, path, *a, **k):
        seen.append(path)
        met.wait()
        return write(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    frames = [spark.range(i, i + 1) for i in range(2 * session.AT_ONCE)]
    df = session.write_parts(spark, iter(frames), "mdq-test")
    assert sorted(r.id for r in df.collect()) == list(range(len(frames))) and len(set(seen)) == len(frames)
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    with pytest.raises(Exception, match="no_such"):
        session.write_parts(spark, [spark.range(1), spark.range(1).selectExpr("assert_true(id > 9, 'no_such') IS NULL AS id")], "mdq-test")
