"""Rules evaluated together against the same rules one by one; joins under NULL keys."""

import random
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datapaths import SF_SMALL
from mdq.operators import RULES
from mdq.operators.joins import left_join, spread_join
from mdq.plans import fused
from mdq.plans.catalog import enabled_rules
from mdq.plans.conform import conformed_rule, conformed_suite
from mdq.plans.suite import run_suite
from mdq.sources.tables import Tables

AS_OF = "1998-06-30"


def bag(df):
    return Counter(tuple(r) for r in df.select("SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "COMPLETENESS", "ACCURACY").collect())


def by_contract(spark, **tables):
    """A registry of literal rows with the contract's wide types."""
    import datetime as dt
    import decimal

    from mdq.sources import contract
    from mdq.sources.tables import TABLE_NAMES
    read = {"decimal": lambda v: decimal.Decimal(str(v)), "date": dt.date.fromisoformat}

    def frame(n):
        fields = contract.columns(n)
        rows = [tuple(None if r.get(f.name) is None else read.get(f.dataType.typeName(), lambda v: v)(r[f.name]) for f in fields) for r in tables.get(n, [])]
        return spark.createDataFrame(rows, fields)
    return Tables(spark, {n: (lambda n=n: frame(n)) for n in TABLE_NAMES})


def odd_tables(spark, seed, n=70):
    """Small domains, so that every branch, NULL, blank, repeated row and value occurs."""
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    ss = lambda: pick("ATHENA1", "XATHENA", "P08", "SHIFT", "OTHER", "kinaxis", None)
    infnr = lambda: pick("I1", "I2", "I3", "I4", "", " ", None)
    matnr = lambda: pick("M1", "M2", "M3", "M4", None)
    num = lambda: pick(None, -1, 0, "0.5", 1, 5, 7, 10, 4000)
    unit = lambda: pick("KG", "KG ", "EA", "", None)
    day = lambda: pick(None, "1998-06-30", "1998-07-05", "1998-07-06", "1998-07-20", "1999-01-01")
    mark = lambda: pick(None, "", " ", "X", "1", "2")
    eine = [dict(SOURCE_SYSTEM=ss(), INFNR=infnr(), EKORG=pick("E1", "E2", None), WERKS=pick("W1", "W2", None), LOEKZ=mark(), APLFZ=num(), BPRME=unit(),
                 BPUMN=num(), BPUMZ=num(), BSTAE=pick("A", "B", None), EFFPR=num(), NETPR=num(), PEINH=num(), PRDAT=day(), MEPRF=mark(), MHDRZ=num(),
                 MINBM=num(), UEBTO=num(), UNTTO=num(), UEBTK=mark()) for _ in range(n)]
    eina = [dict(SOURCE_SYSTEM=ss(), INFNR=infnr(), MATNR=matnr(), LOEKZ=pick(None, None, "", "X"), MEINS=unit(), LMEIN=unit(), UMREZ=num(), UMREN=num())
            for _ in range(n // 2)]
    marc = [dict(SOURCE_SYSTEM=ss(), MATNR=matnr(), WERKS=pick("W1", "W2", None), PLIFZ=num(), BESKZ=pick("F", "E", None), BSTRF=num(),
                 WEBAZ=pick(None, 0, 3, 20, -2), UNETO=num()) for _ in range(n // 3)]
    mara = [dict(SOURCE_SYSTEM=ss(), MATNR=matnr(), MEINS=unit(), LVORM=pick(None, "X")) for _ in range(n // 4)]
    lfm2 = [dict(EKORG=pick("E1", "E2", None), BSTAE=pick("A", "B", None)) for _ in range(5)]
    bod = [dict(SOURCE_SYSTEM=ss(), GMID=matnr(), SITE=pick("S1", None), SITE_UID=pick("kinaxis_S1", "KINAXIS_S2", "S1", None),
                FROM_SITE=pick("S1", "", None), FROM_SITE_UID=pick("kinaxis_S1", "x_S1", None)) for _ in range(n // 2)]
    return by_contract(spark, eine=eine, eina=eina, marc=marc, mara=mara, lfm2=lfm2, bod=bod)


FAMILIES = [*fused.PIR_FAMILY, *fused.SITES, *fused.CONVERSION, *fused.BY_RECORD]


@pytest.mark.parametrize("seed", range(5))
def test_fused_rows_are_the_rules_rows(spark, seed):
    t, rules = odd_tables(spark, seed), [RULES[k] for k in FAMILIES]
    parts, rest = fused.suite_rows(t, AS_OF, rules)
    assert [r.key for r in rest] == ["dq_aplfz"] and len(parts) == 4
    got, want = bag(reduce(DataFrame.unionByName, parts)), Counter()
    for r in rules:
        if r.key != "dq_aplfz":
            want += bag(r.fn(t, AS_OF))
    assert got == want
    parts, rest = fused.conformed_rows(t, AS_OF, rules)
    assert rest == [] and len(parts) == 4
    got = bag(reduce(DataFrame.unionByName, parts))
    assert got == bag(reduce(DataFrame.unionByName, [conformed_rule(r.rows(t, AS_OF), r) for r in rules]))


def test_a_rule_alone_is_not_fused(spark):
    t = odd_tables(spark, 9)
    parts, rest = fused.suite_rows(t, AS_OF, [RULES["dq_netpr"], RULES["dq_to_site"], RULES["dq_lvorm"]])
    assert parts == [] and {r.key for r in rest} == {"dq_netpr", "dq_to_site", "dq_lvorm"}


def test_suite_and_conformed_of_derived_tables(spark):
    t, rules = Tables.from_tpch(spark, SF_SMALL), enabled_rules()
    want = Counter()
    for r in rules:
        want += bag(r.fn(t, AS_OF))
    assert bag(run_suite(t, AS_OF)) == want
    assert bag(conformed_suite(t, AS_OF)) == bag(reduce(DataFrame.unionByName, [conformed_rule(r.rows(t, AS_OF), r) for r in rules]))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(plan.count(f"Exchange {k}") for k in ("hashpartitioning", "SinglePartition", "RoundRobin", "rangepartitioning"))


def test_nine_rules_need_one_exchange_of_the_join(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL).materialize(str(tmp_path), names=("eine", "eina", "marc", "pir"))
    rules = [RULES[k] for k in fused.PIR_FAMILY]
    parts, rest = fused.conformed_rows(t, AS_OF, rules)
    assert rest == [] and exchanges(parts[0]) == 2               # the join's rows once, MARC once
    assert exchanges(RULES["dq_prdat"].fn(t, AS_OF)) == 2        # the rule alone: both sides by the material


def test_prdat_from_first_and_last_dates_equals_all_pairs(spark):
    for seed in range(4):
        t = odd_tables(spark, 20 + seed)
        days = F.coalesce(F.col("WEBAZ"), F.lit(0)) + 5
        pir = t.pir.where(fused.pir.prdat().where).select("SOURCE_SYSTEM", "MATNR", "PRDAT")
        pairs = pir.join(t.marc.select("SOURCE_SYSTEM", "MATNR", "WEBAZ"), ["SOURCE_SYSTEM", "MATNR"], "left")
        ko = F.col("PRDAT").isNull() | (F.col("PRDAT") <= F.date_add(F.lit(AS_OF).cast("date"), days.cast("int")))
        want = pairs.select("SOURCE_SYSTEM", F.col("MATNR").alias("GMID"), F.lit("PRDAT").alias("ATTRIBUTE"),
                            F.col("PRDAT").isNull().cast("int").alias("COMPLETENESS"), ko.cast("int").alias("ACCURACY")).distinct()
        assert bag(RULES["dq_prdat"].fn(t, AS_OF)) == bag(want)


# -- NULL keys ---------------------------------------------------------------
def thirds(spark, n=6000):
    left = spark.range(n).select(F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"), F.when(F.col("id") % 5 != 0, F.lit(1)).alias("j"),
                                 F.col("id").alias("v"))
    right = spark.createDataFrame([(i, 1, f"w{i % 7}") for i in range(40)] + [(3, 1, "again"), (None, 1, "n"), (None, None, "m")], "k bigint, j int, w string")
    return left, right


@pytest.mark.parametrize("join", [left_join, spread_join])
@pytest.mark.parametrize("on", [["k"], ["k", "j"]])
def test_joins_around_null_keys_are_left_joins(spark, join, on):
    left, right = thirds(spark)
    right = right if len(on) == 2 else right.drop("j")
    got, want = join(left, right, on), left.join(right, on, "left")
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_null_keys_do_not_meet_in_one_partition(spark):
    """Without AQE: the plain join puts a third of all rows into one partition."""
    left, right = thirds(spark)
    right = right.drop("j")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert largest(left.join(right, ["k"], "left")) >= 2000
        assert largest(spread_join(left, right, ["k"])) < 1500
        joined = left_join(left, right, ["k"])
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert largest(joined) < 2500 and "isnull(" in plan    # past the join, in the partitions they came in
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def holes(spark, tmp_path_factory):
    """A third of EINE without record, org and plant, a third of EINA without record or material."""
    import duckdb

    from mdq.sources.tables import TABLE_NAMES
    root, base = str(tmp_path_factory.mktemp("holes")), Tables.from_tpch(spark, SF_SMALL)
    lost = {"eine": ["INFNR", "EKORG", "WERKS"], "eina": ["INFNR", "MATNR"], "marc": ["MATNR", "WERKS"]}
    con = duckdb.connect()
    for n in TABLE_NAMES:
        df = base[n]
        for i, c in enumerate(lost.get(n, [])):
            df = df.withColumn(c, F.when(F.pmod(F.xxhash64(F.lit(i), *base[n].columns), F.lit(3)) != 0, F.col(c)))
        df.write.parquet(f"{root}/{n}")
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{root}/{n}/*.parquet')")
    return Tables.from_parquet(spark, root), con


@pytest.mark.parametrize("key", ["dq_bstae", "dq_minbm", "dq_uebtk", "dq_uebto", "dq_prdat", "dq_untto"])
def test_rules_under_a_third_of_null_keys(holes, key):
    from check_oracle import norm_rows
    from test_skew import _sql
    t, con = holes
    df = RULES[key].fn(t, AS_OF)
    rel = con.sql(_sql(key))
    assert norm_rows(df.columns, [tuple(r) for r in df.collect()]) == norm_rows(rel.columns, rel.fetchall())


# -- written in parts, and at size ---------------------------------------------
LANE_ROWS = dict(part_dim=[dict(GMID="M1", RELEVANCYKNX="1"), dict(GMID="7", RELEVANCYKNX="1"), dict(GMID="M2", RELEVANCYKNX="0")],
                 material=[dict(GMID_CODE="007", IS_ACTIVE=True), dict(GMID_CODE="7", IS_ACTIVE=True), dict(GMID_CODE="8", IS_ACTIVE=False)])


@pytest.mark.parametrize("seed", range(3))
def test_untto_and_lanes_in_their_families(spark, seed):
    r, t = random.Random(seed), odd_tables(spark, 40 + seed)
    pick = lambda *v: r.choice(v)
    lanes = [dict(SOURCE_SYSTEM=pick("kinaxis", "KINAXIS", "Kinaxis", None), GMID=pick("7", "07", "8", "M1", "M2", None), FROM_GMID=pick("7", "M1", "", None),
                  SITE=pick("S1", None), SITE_UID=pick("kinaxis_S1", "KINAXIS_S2", None), FROM_SITE=pick("S1", None), FROM_SITE_UID=pick("kinaxis_S1", None),
                  TYPE=pick("Make", "Other", None), ORDER_POLICY=pick("NoOrders", "LotForLot", None), EFFECTIVE_OUT_DATE=pick(None, "1999-01-01")) for _ in range(60)]
    t._frames |= {n: by_contract(spark, bod=lanes, **LANE_ROWS)[n] for n in ("bod", "part_dim", "material")}
    rules = [RULES[k] for k in (*fused.PIR_FAMILY, "dq_untto", *fused.LANES)]
    parts, rest = fused.conformed_rows(t, AS_OF, rules)
    assert rest == [] and len(parts) == 2
    assert bag(reduce(DataFrame.unionByName, parts)) == bag(reduce(DataFrame.unionByName, [conformed_rule(x.rows(t, AS_OF), x) for x in rules]))
    parts, rest = fused.suite_rows(t, AS_OF, [RULES[k] for k in fused.LANES])
    assert rest == [] and len(parts) == 1
    want = Counter()
    for k in fused.LANES:
        want += bag(RULES[k].fn(t, AS_OF))
    assert bag(parts[0]) == want


def test_suite_written_in_parts_is_the_suite(spark):
    from mdq.plans.suite import suite_written
    t = odd_tables(spark, 3)
    assert bag(suite_written(t, AS_OF)) == bag(run_suite(t, AS_OF))


def test_large_input_is_dealt_by_size(spark, monkeypatch, tmp_path):
    from mdq import session
    t = odd_tables(spark, 8, n=120).materialize(str(tmp_path))
    keys = ("dq_bstae", "dq_uebtk", "dq_minbm")
    want = {k: bag(RULES[k].fn(t, AS_OF)) for k in keys}
    assert session.parts_by_size(t.eine) == 0
    monkeypatch.setattr(session, "LARGE_BYTES", 10)
    monkeypatch.setattr(session, "PART_BYTES", 400)
    n = session.parts_by_size(t.eine.join(t.eina, "INFNR"))
    assert n > 8
    assert {k: bag(RULES[k].fn(t, AS_OF)) for k in keys} == want
    plan = RULES["dq_bstae"].fn(t, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2        # the records of EINE and of EINA, once each


def test_one_organisation_does_not_meet_in_one_partition(spark):
    """Without AQE: all rows of the one purchasing organisation used to be in one partition."""
    from mdq.operators import pir
    eine = [dict(SOURCE_SYSTEM="P08", INFNR=f"I{i}", EKORG="E1", BSTAE="A") for i in range(4000)]
    t = by_contract(spark, eine=eine, lfm2=[dict(EKORG="E1", BSTAE="A"), dict(EKORG="E1", BSTAE="B"), dict(EKORG="E1", BSTAE="B")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = pir.with_vendor(t, t.eine).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in got) == 8000 and max(r["count"] for r in got) < 3000


def test_history_and_views_end_in_one_scan_of_their_parts(spark):
    """A task sends the metrics of all plan nodes of its stage to the driver: of a union of all parts, those of all rules."""
    from __spark_entry__ import queries
    from mdq.plans.history import HISTORY_DATES, history_over_dates
    df = queries()["dqm_history"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan and plan.count("Relation") == 1
    names = ["SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "COMPLETENESS", "ACCURACY", "VALID_FROM", "VALID_TO"]
    rows = lambda df: Counter(tuple(r) for r in df.select(*names).collect())
    assert rows(df) == rows(history_over_dates(Tables.from_tpch(spark, SF_SMALL), HISTORY_DATES))
