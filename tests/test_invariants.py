"""Structural invariants of the rule results, and dedupe-before-join rewrites
against the plain fan-out joins."""

import pytest
from pyspark.sql import functions as F

from mdq.functions import first_match, result
from mdq.functions.scope import prefix_scope
from mdq.operators import RULES
from mdq.sources.tables import Tables

from datapaths import SF_SMALL

AS_OF = "1998-06-30"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables.from_tpch(spark, SF_SMALL)


@pytest.mark.parametrize("key", sorted(RULES))
def test_result_shape_and_flag_domain(tables, key):
    df = RULES[key].fn(tables, AS_OF)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("SOURCE_SYSTEM", "string"), ("GMID", "string"), ("ATTRIBUTE", "string"),
        ("COMPLETENESS", "int"), ("ACCURACY", "int")]
    labels = {r[0] for r in df.select("ATTRIBUTE").distinct().collect()}
    assert labels <= {RULES[key].label}
    bad = df.where(~F.col("COMPLETENESS").isin(0, 1) | ~F.coalesce(F.col("ACCURACY"), F.lit(0)).isin(0, 1))
    assert bad.count() == 0
    if key != "dq_effpr":
        assert df.where(F.col("ACCURACY").isNull()).count() == 0


@pytest.mark.parametrize("key", ["dq_umren", "dq_umrez", "dq_vdatu"])
def test_grouped_rules_unique_per_material(tables, key):
    df = RULES[key].fn(tables, AS_OF)
    assert df.count() == df.select("SOURCE_SYSTEM", "GMID").distinct().count()


def test_umren_and_umrez_flags_agree(tables):
    a = RULES["dq_umren"].fn(tables, AS_OF).drop("ATTRIBUTE")
    b = RULES["dq_umrez"].fn(tables, AS_OF).drop("ATTRIBUTE")
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_bstae_dedupe_equals_plain_fan_out(tables):
    e, v, p = tables.eine.alias("e"), tables.lfm2.alias("v"), tables.eina.alias("p")
    plain = (e.where(prefix_scope("e.SOURCE_SYSTEM"))
             .join(v, F.col("v.EKORG") == F.col("e.EKORG"), "left")
             .join(p, F.col("p.INFNR") == F.col("e.INFNR"), "left"))
    b, vb = F.col("e.BSTAE"), F.col("v.BSTAE")
    plain = result(plain, F.col("e.SOURCE_SYSTEM"), F.col("p.MATNR"), "BSTAE",
                   first_match(b.isNull()), first_match(b.isNull(), vb.isNotNull() & (b != vb)))
    assert sorted(plain.collect(), key=str) == sorted(RULES["dq_bstae"].fn(tables, AS_OF).collect(), key=str)


def test_loekz_dedupe_equals_plain_fan_out(tables):
    e, m = tables.eine.alias("e"), tables.marc.alias("m")
    plain = e.where(F.col("e.PRDAT") < F.lit(AS_OF).cast("date")).join(
        m, (F.col("e.SOURCE_SYSTEM") == F.col("m.SOURCE_SYSTEM")) & (F.col("e.WERKS") == F.col("m.WERKS")))
    i = F.coalesce(F.col("e.INFNR"), F.lit(""))
    plain = result(plain, F.col("e.SOURCE_SYSTEM"), F.col("e.INFNR"), "deactivation flag",
                   first_match(i == ""),
                   first_match((i != "") & (F.coalesce(F.col("m.LVORM"), F.lit("")) == "")
                               & (F.col("e.LOEKZ") != "X")))
    assert sorted(plain.collect(), key=str) == sorted(RULES["dq_loekz"].fn(tables, AS_OF).collect(), key=str)
