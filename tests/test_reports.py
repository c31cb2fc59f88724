"""Unreadable source values, dated catalog versions, materials per class."""

import datetime as dt

from pyspark.sql import functions as F

from datapaths import SF_SMALL
from mdq.plans.catalog import catalog_df, dated_catalog, publish_catalog
from mdq.plans.scorecard import (
    ko_listing, material_sketches, materials, materials_of_sketches, scorecard, scorecard_over_time, with_catalog,
)
from mdq.sources import contract
from mdq.sources.tables import Tables

DEMAND = "GMID string, BALANCE_DELTA string"


def test_unreadable_values_are_counted_and_kept(spark, tmp_path):
    raw = [("1|a", "5"), ("2|a", "x"), ("3|a", " "), ("4|a", ""), ("5|a", None), ("6|a", "1e3"), ("7|a", " 7 "), ("8|a", "1,5"), (None, "?")]
    spark.createDataFrame(raw, DEMAND).write.parquet(str(tmp_path / "in" / "demand"))
    dates = [("1|a", 1.0, "1999-01-01"), ("2|a", 2.0, "soon"), ("3|a", None, "1999-13-01")]
    spark.createDataFrame(dates, "GMID string, EFFECTIVE_QUANTITY double, DATE string").write.parquet(str(tmp_path / "in" / "forecast"))
    spark.createDataFrame([("K", "1")], "SOURCE_SYSTEM string, KAPID string").write.parquet(str(tmp_path / "in" / "kako"))
    t = Tables.from_parquet(spark, str(tmp_path / "in")).materialize(str(tmp_path / "out"), names=("demand", "forecast", "kako"))
    assert {tuple(r) for r in t.source_report().collect()} == {
        ("demand", "BALANCE_DELTA", 9, 3), ("forecast", "FORECAST_DATE", 3, 2), ("kako", None, 1, 0)}
    got = {(r.SOURCE, r.COLUMN_NAME, r.VALUE, r.REASON, r.ROW_KEY["GMID"]) for r in t.quarantined().collect()}
    number, date = "not a decimal(38,10)", "not a date"
    assert got == {("demand", "BALANCE_DELTA", "x", number, "2|a"), ("demand", "BALANCE_DELTA", "1,5", number, "8|a"),
                   ("demand", "BALANCE_DELTA", "?", number, None), ("forecast", "FORECAST_DATE", "soon", date, "2|a"),
                   ("forecast", "FORECAST_DATE", "1999-13-01", date, "3|a")}
    assert t.demand.where("BALANCE_DELTA IS NULL").count() == 6          # the rules see them as missing
    again = t.materialize(str(tmp_path / "again"), names=("demand",))
    assert again.quarantined().count() == 0 and {r.UNREADABLE for r in again.source_report().collect()} == {0}


def test_sources_without_text_need_no_quarantine(spark):
    df = spark.createDataFrame([("K", "1")], "SOURCE_SYSTEM string, KAPID string")
    assert contract.quarantine(df, "kako").collect() == []
    assert contract.quarantine(df, "pir").collect() == []
    assert contract.quarantine(spark.createDataFrame([], DEMAND), "demand").collect() == []


CONF = "SNAPSHOT_DATE date, SOURCE_SYSTEM string, GMID string, ATTRIBUTE string, COMPLETENESS int, ACCURACY int"


def test_a_changed_criticality_leaves_earlier_scorecards_alone(spark, tmp_path):
    root, day = str(tmp_path / "catalog"), lambda i: dt.date(2020, 1, i)
    publish_catalog(catalog_df(spark), root)
    changed = catalog_df(spark).withColumn("criticality", F.when(F.col("attribute") == "MEINS", "Low").otherwise(F.col("criticality")))
    rows = [(day(i), "S", m, a, i % 2, 0) for i in (1, 5, 9) for m in ("A", None) for a in ("MEINS", "EFFPR")]
    snaps = spark.createDataFrame(rows, CONF)
    def cards():
        return {(r.SNAPSHOT_DATE.day, r.CLASS, r.CRITICALITY, r.ATTRIBUTE): tuple(r)[4:] for r in scorecard_over_time(snaps, dated_catalog(spark, root)).collect()}
    before = cards()
    assert before == {(r.SNAPSHOT_DATE.day, r.CLASS, r.CRITICALITY, r.ATTRIBUTE): tuple(r)[4:]
                      for r in scorecard_over_time(snaps, catalog_df(spark)).collect()}
    publish_catalog(changed, root, "2020-01-05")                           # holds from the fifth on, that day included
    publish_catalog(catalog_df(spark).where("attribute <> 'EFFPR'"), root, "2020-01-09")
    after = cards()
    assert {k: v for k, v in after.items() if k[0] == 1} == {k: v for k, v in before.items() if k[0] == 1}
    assert (5, None, "Low", None) in after and (5, None, "Low", None) not in before
    assert (9, None, "Low", None) not in after and not any(k[3] == "EFFPR" for k in after if k[0] == 9)
    dated = dated_catalog(spark, root)
    assert dated.where("attribute = 'MEINS'").count() == 3 and dated.where("VALID_TO IS NULL").count() == 30
    undated = snaps.where("SNAPSHOT_DATE = DATE'2020-01-01'").drop("SNAPSHOT_DATE")
    assert {r.ATTRIBUTE for r in with_catalog(undated, dated).collect()} == {"MEINS"}      # the last version
    assert ko_listing(undated, dated).count() == 2 and scorecard(undated, dated).count() == 4


def test_materials_are_counted_once_per_level(spark):
    rows = [(None, "S", "A", "MEINS", 1, 0), (None, "S", "A", "EFFPR", 0, 1), (None, "S", "A", "NETPR", 1, None), (None, "T", "A", "NETPR", 0, None),
            (None, "S", None, "EFFPR", 0, 0), (None, "S", "", "EFFPR", 1, 0)]
    got = {(r.CLASS, r.CRITICALITY, r.ATTRIBUTE): (r.LEVEL, r.MATERIALS, r.KO_MATERIALS)
           for r in materials(spark.createDataFrame(rows, CONF), catalog_df(spark)).collect()}
    assert got == {("Planning", "High", "EFFPR"): (0, 3, 2), ("Planning", "High", "NETPR"): (0, 2, 1), ("Customer Fulfillment", "High", "MEINS"): (0, 1, 1),
                   ("Planning", None, None): (3, 4, 2), ("Customer Fulfillment", None, None): (3, 1, 1), (None, "High", None): (5, 4, 2),
                   (None, None, None): (7, 4, 2)}
    empty = spark.createDataFrame([], CONF)
    assert materials(empty, catalog_df(spark)).collect() == [] and material_sketches(empty, catalog_df(spark)).collect() == []


def test_merged_sketches_agree_with_exact_counts(spark, tmp_path):
    n, cat = 30_000, catalog_df(spark)
    days = spark.createDataFrame([(dt.date(2020, 1, i),) for i in (1, 2)], "SNAPSHOT_DATE date")
    conf = (spark.range(n).crossJoin(spark.createDataFrame([("MEINS",), ("EFFPR",), ("NETPR",), ("dock to stock lead time",)], "ATTRIBUTE string"))
            .crossJoin(days).where(F.pmod(F.xxhash64("id", "ATTRIBUTE", "SNAPSHOT_DATE"), F.lit(3)) > 0)
            .select("SNAPSHOT_DATE", F.lit("S").alias("SOURCE_SYSTEM"), F.col("id").cast("string").alias("GMID"), "ATTRIBUTE",
                    (F.pmod(F.xxhash64("ATTRIBUTE", "id"), F.lit(5)) == 0).cast("int").alias("COMPLETENESS"), F.lit(0).alias("ACCURACY")))
    path = str(tmp_path / "sketches")
    material_sketches(conf, cat, by=("SNAPSHOT_DATE",)).write.parquet(path)
    sketches = spark.read.parquet(path)
    name = lambda r: (r.CLASS, r.CRITICALITY, r.ATTRIBUTE, r.LEVEL)
    for by, want in (((), materials(conf, cat)), (("SNAPSHOT_DATE",), materials(conf, cat, by=("SNAPSHOT_DATE",)))):
        exact = {(name(r), *[r[b] for b in by]): (r.MATERIALS, r.KO_MATERIALS) for r in want.collect()}
        near = {(name(r), *[r[b] for b in by]): (r.MATERIALS, r.KO_MATERIALS) for r in materials_of_sketches(sketches, by).collect()}
        assert exact.keys() == near.keys()
        for k, pair in exact.items():
            for x, y in zip(pair, near[k]):
                assert abs(x - y) <= 0.025 * x + 1                       # three standard errors of 0.8 %


def test_a_daily_run_leaves_its_reports(spark, tmp_path):
    from mdq.plans.history import daily_run
    base = Tables.from_tpch(spark, SF_SMALL)
    rule_tables = base.materialize(str(tmp_path / "in"))
    daily_run(rule_tables, "1998-06-30", str(tmp_path / "snaps"), reports=str(tmp_path / "r")).count()
    assert spark.read.parquet(str(tmp_path / "r" / "sources")).count() >= 16
    assert spark.read.parquet(str(tmp_path / "r" / "quarantine")).count() == 0
    total = materials_of_sketches(spark.read.parquet(str(tmp_path / "r" / "materials"))).where("LEVEL = 7").first()
    conf = spark.read.parquet(str(tmp_path / "snaps"))
    exact = conf.select("SOURCE_SYSTEM", "GMID").distinct().count()
    assert abs(total.MATERIALS - exact) <= 0.025 * exact + 1
