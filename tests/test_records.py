"""The rules on info records over their one written join, against the rules one by one."""

import random
import re
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from mdq.functions.texts import packed, unpacked
from mdq.operators import RULES
from mdq.operators.joins import expand_copies
from mdq.plans import records
from mdq.plans.conform import conformed_rule
from test_fused import AS_OF, bag, by_contract, odd_tables


def with_units(t, seed, spark):
    r = random.Random(seed)
    t._frames["marm"] = by_contract(spark, marm=[dict(MATNR=r.choice(["M1", "M2", "M3", "M9", None]), MEINH=r.choice(["KG", "EA", "", None])) for _ in range(9)])["marm"]
    return t


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("many_orgs", [False, True])
def test_record_rules_over_one_join(spark, seed, many_orgs, monkeypatch):
    if many_orgs:
        monkeypatch.setattr(records, "MANY_ORGS", 0)
    t, rules = with_units(odd_tables(spark, 60 + seed), seed, spark), [RULES[k] for k in (*records.RULES, *records.UNITS)]
    parts, rest = records.record_parts(t, AS_OF, rules, False)
    assert rest == []
    want, got = Counter(), bag(expand_copies(reduce(DataFrame.unionByName, parts), "_n"))
    for r in rules:
        want += bag(r.fn(t, AS_OF))
    assert got == want
    parts, rest = records.record_parts(t, AS_OF, rules, True, conformed_rule)
    assert rest == []
    assert bag(reduce(DataFrame.unionByName, parts)) == bag(reduce(DataFrame.unionByName, [conformed_rule(r.rows(t, AS_OF), r) for r in rules]))


def test_records_are_shuffled_once(spark, monkeypatch, tmp_path):
    """Of the fourteen rules, one shuffle of EINE and one of EINA by info record."""
    from mdq import session
    t = odd_tables(spark, 70, n=120).materialize(str(tmp_path))
    monkeypatch.setattr(session, "LARGE_BYTES", 10)
    monkeypatch.setattr(session, "PART_BYTES", 400)
    for conformed in (False, True):
        df, _ = records.records(t, conformed)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 2
        assert plan.count("Exchange hashpartitioning(INFNR") == 2


def test_conformed_view_writes_a_row_for_each_material(spark, monkeypatch):
    """One shuffle by material and plant for the matrix and MINBM, nothing written by record, and no counts where only the worst flags matter."""
    t, rules, seen = odd_tables(spark, 80), [RULES[k] for k in records.RULES], {}
    write = records.write_shared
    monkeypatch.setattr(records, "write_shared", lambda df, name: seen.setdefault(name, write(df, name)))
    records.record_parts(t, AS_OF, rules, True, conformed_rule)
    assert set(seen) == {"mdq-vendors", "mdq-materials"}
    keys = seen["mdq-materials"].select("SOURCE_SYSTEM", "GMID")
    assert keys.count() == keys.distinct().count() > 5
    rows, names = records.records(t, True)
    assert not [c for c in rows.columns if c.startswith("dq_")] and len(set(names)) == len(names) <= 63


def shuffled(df):
    """(how many columns, the first keys) of each shuffle in the plan of ``df``."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [(int(n), re.sub("#[0-9]+L?", "", keys)) for n, keys in re.findall(r"Exchange\nInput \[(\d+)\]:.*\nArguments: hashpartitioning\(([^)]*?), \d+\)", plan)]


def test_rows_of_the_conformed_view_are_shuffled_short(spark, tmp_path):
    """Few columns by record, by material and for the units, and one shuffle by the material for MINBM, not one more for its plants."""
    t = odd_tables(spark, 81).materialize(str(tmp_path))
    rows, names = records.records(t, True)
    found = shuffled(records._matrix(records._with_minbm(t, rows, names), names, True))
    assert sorted(n for n, keys in found if keys == "INFNR") == [3, 5]
    assert max(n for n, keys in found if keys == "MATNR, _spread") == 6
    assert not [keys for _, keys in found if keys.startswith("MATNR, WERKS")]
    assert (2, "MATNR") in shuffled(records._unit_rows(t, [RULES[k] for k in records.UNITS], True))


def test_packed_texts_come_back(spark):
    from decimal import Decimal
    values = [None, "", " ", "=", "|", "~", "~0", "~1", "||~1~", "W1", "~|=", "\\|", "NULL"]
    rows = [(a, b, n, x) for a in values for b in values for n, x in ((None, None), (Decimal("0E-10"), 0.1), (Decimal("-12.5"), float("inf")), (Decimal("9" * 28 + ".0000000001"), 1e300))]
    df = spark.createDataFrame(rows, "a string, b string, n decimal(38,10), x double")
    back = df.withColumn("t", packed("a", "b", "n", "x")).withColumns(unpacked("t", **{c + "_": df.schema[c].dataType for c in df.columns}))
    assert back.count() == len(rows)
    for r in back.collect():
        assert (r.a, r.b, r.n, r.x) == (r.a_, r.b_, r.n_, r.x_)
    assert back.select("t").distinct().count() == len(rows)


def test_ratio_kind_answers_like_the_numbers(spark):
    from pyspark.sql import functions as F

    from mdq.operators import material
    values = [None, "-1", "0", "0.5", "1", "2", "10000", "10001", "20000", "5000.5"]
    one = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast("decimal(13,3)").alias("v"))
    units = spark.createDataFrame([("KG", "KG"), ("KG", "EA"), (None, "KG"), ("KG", None)], "MEINS string, _BASE string").withColumn("LMEIN", F.col("MEINS"))
    df = one.withColumnRenamed("v", "UMREZ").crossJoin(one.withColumnRenamed("v", "UMREN")).crossJoin(units).withColumn("_ratio", material.ratio_kind())
    flags = [*material.lmein_flags(), *material.meins_flags(F.col("MEINS") == "KG"), *material.conversion_flags(F.col("LMEIN"), F.col("_BASE"))]
    both = df.select("*", F.array(*flags).alias("want")).withColumns(material.ratio_of("_ratio")).select("want", F.array(*flags).alias("got"), "_ratio")
    rows = both.collect()
    assert len(rows) == 400 and all(r.want == r.got for r in rows)
    assert {r._ratio for r in rows} == set(range(11))
