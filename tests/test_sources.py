"""The Spark-derived ERP tables equal the DuckDB-derived ones (same formulas)."""

import pytest
from check_oracle import duck_connect, norm_rows

from mdq.sources import erp_fixtures
from mdq.sources.tables import TABLE_NAMES, Tables

from datapaths import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_fixture_matches_duckdb(spark, duck, name):
    df = Tables.from_tpch(spark, SF_SMALL)[name]
    rel = duck.sql(f"WITH {erp_fixtures.sql_ctes([name])} SELECT * FROM {name}")
    assert df.columns == rel.columns
    assert norm_rows(df.columns, [tuple(r) for r in df.collect()]) == norm_rows(rel.columns, rel.fetchall())


def test_materialize_roundtrip(spark, tmp_path):
    t = Tables.from_tpch(spark, SF_SMALL)
    m = t.materialize(str(tmp_path / "tables"), names=("kako", "crca"))
    assert m.kako.count() == t.kako.count()
    assert sorted(m.crca.collect()) == sorted(t.crca.collect())


def test_contract_types_blank_text_and_other_names(spark, tmp_path):
    from mdq.operators import RULES
    bod = "'kinaxis' SOURCE_SYSTEM, g GMID, g FROM_GMID, 'W1_x' SITE, 'u' SITE_UID, 'f' FROM_SITE, 'u' FROM_SITE_UID, 'Transfer' TYPE, " \
          "'p' ORDER_POLICY, date'1998-01-01' EFFECTIVE_IN_DATE, d EFFECTIVE_OUT_DATE, l DOCK_TO_STOCK_LEAD_TIME"
    paths = {n: str(tmp_path / n) for n in ("bod", "part_dim", "marc", "mara", "forecast", "demand")}
    spark.createDataFrame([("1", "", "2.4"), ("2", " ", "2"), ("3", "1999-01-01", "x")], "g string, d string, l string").selectExpr(*[
        x for x in bod.split(", ")]).write.parquet(paths["bod"])
    spark.createDataFrame([(g, "1") for g in "123"], "GMID string, RELEVANCYKNX string").write.parquet(paths["part_dim"])
    spark.createDataFrame([("kinaxis", g, "W1") for g in "123"], "SOURCE_SYSTEM string, MATNR string, WERKS string").selectExpr(
        "*", "'2' WEBAZ", "NULL PLIFZ", "NULL BESKZ", "NULL MMSTA", "CAST(NULL AS STRING) LVORM", "NULL DISMM", "1 BSTRF", "1 UNETO"
    ).selectExpr(*[f"CAST({c} AS STRING) {c}" for c in ("SOURCE_SYSTEM", "MATNR", "WERKS", "WEBAZ", "PLIFZ", "BESKZ", "MMSTA", "LVORM", "DISMM", "BSTRF", "UNETO")]).write.parquet(paths["marc"])
    spark.createDataFrame([("kinaxis", g) for g in "123"], "SOURCE_SYSTEM string, MATNR string").selectExpr(
        "*", *[f"CAST(NULL AS STRING) {c}" for c in ("MEINS", "MSTAE", "ZMTAR", "MTART", "LVORM")]).write.parquet(paths["mara"])
    spark.createDataFrame([("1|W1_x", 5.0, "1999-01-01")], "GMID string, EFFECTIVE_QUANTITY double, DATE string").write.parquet(paths["forecast"])
    spark.createDataFrame([("9|z", "1")], "GMID string, MENGE string").write.parquet(paths["demand"])
    t = Tables.from_parquet(spark, paths, mapping={"demand": {"BALANCE_DELTA": "MENGE"}})
    flags = lambda k: {r.GMID: (r.COMPLETENESS, r.ACCURACY) for r in RULES[k].fn(t, "1998-06-30").collect()}
    assert flags("dq_effective_end_date") == {"1": (1, 1), "2": (1, 1), "3": (0, 0)}       # blank text is missing
    assert flags("dq_dock_to_stock") == {"1": (0, 1), "2": (0, 0), "3": (0, 1)}            # 2.4 is not 2
    assert flags("dq_order_policy") == {"1": (0, 0)}                                       # a DATE column, a mapped quantity
    with pytest.raises(ValueError, match="BALANCE_DELTA"):
        Tables.from_parquet(spark, paths).demand
