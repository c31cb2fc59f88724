"""Hot keys: one key holding about a third of the rows.

The sf0.001 tables are rewritten so that a third of EINE shares one info
record, purchasing org and plant, a third of the PP_TABS links share one
capacity, a third of the work centres sit in one plant, and EINA holds a hot
info record and NULL materials. Each affected rule runs in Spark and is compared
with plain SQL over the same parquet files in DuckDB.
"""

import duckdb
import pytest
from check_oracle import norm_rows
from pyspark.sql import functions as F

from mdq.operators import RULES
from mdq.oracle.rules_sql import rule_body
from mdq.sources.tables import TABLE_NAMES, Tables

from datapaths import SF_SMALL

AS_OF = "1998-06-30"
HOT_KEYS = ["dq_aplfz", "dq_bpumn", "dq_bstae", "dq_effpr", "dq_kapid", "dq_loekz", "dq_lvorm", "dq_minbm",
            "dq_netpr", "dq_peinh", "dq_uebtk", "dq_uebto", "dq_untto", "dq_prdat"]


def _hot(c, mod):
    return F.abs(F.hash(F.col(c))) % mod == 0


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    base = Tables.from_tpch(spark, SF_SMALL)
    frames = {n: base[n] for n in TABLE_NAMES}
    e = frames["eine"]
    hot = _hot("INFNR", 3)
    frames["eine"] = (e.withColumn("EKORG", F.when(hot, F.lit("P0")).otherwise(F.col("EKORG")))
                       .withColumn("WERKS", F.when(hot, F.lit("W00")).otherwise(F.col("WERKS")))
                       .withColumn("INFNR", F.when(hot, F.lit("0000000001")).otherwise(F.col("INFNR"))))
    a = frames["eina"]
    frames["eina"] = (a.withColumn("MATNR", F.when(_hot("INFNR", 7), F.lit(None)).otherwise(F.col("MATNR")))
                       .withColumn("INFNR", F.when(_hot("INFNR", 30), F.lit("0000000001")).otherwise(F.col("INFNR"))))
    frames["pp_tabs"] = frames["pp_tabs"].withColumn(
        "KAKO_KAPID", F.when(_hot("MARA_MATNR", 3), F.lit("00000002")).otherwise(F.col("KAKO_KAPID")))
    frames["crhd"] = frames["crhd"].withColumn(
        "WERKS", F.when(_hot("OBJID", 3), F.lit("W00")).otherwise(F.col("WERKS")))
    for n, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{n}")
    con = duckdb.connect()
    for n in TABLE_NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{root}/{n}/*.parquet')")
    return Tables.from_parquet(spark, root), con


def _sql(key):
    _, ctes, select = rule_body(key)
    return (f"WITH {ctes.strip()}\n{select.strip()}" if ctes.strip() else select.strip())


@pytest.mark.parametrize("key", HOT_KEYS)
def test_hot_keys_match_brute_force(spark, skewed, key):
    t, con = skewed
    df = RULES[key].fn(t, AS_OF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(_sql(key))
    assert norm_rows(df.columns, rows) == norm_rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", ["dq_aplfz", "dq_prdat"])
def test_hot_material_is_reduced_before_the_join(skewed, key):
    plan = RULES[key].fn(skewed[0], AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert plan.count("Aggregate", join) >= 2                                                 # both sides are aggregates
    assert key == "dq_prdat" or plan.count("Aggregate", 0, join) >= 1                          # PRDAT's sides are one row per key


def test_hot_info_record_is_counted_not_paired(spark, skewed):
    t, _ = skewed
    from mdq.operators.pir import untto_counts
    counts = untto_counts(t)
    assert counts.groupBy().sum("_n").first()[0] == RULES["dq_untto"].fn(t, AS_OF).count()
    assert counts.count() == RULES["dq_untto"].fn(t, AS_OF).distinct().count()


def test_skewed_fixture_is_skewed(skewed):
    t, _ = skewed
    n = t.eine.count()
    top = t.eine.groupBy("INFNR").count().orderBy(F.desc("count")).first()["count"]
    assert top >= n / 4
