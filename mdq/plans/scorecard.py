"""X4: scorecard - KO counts and OK rates per attribute, class and criticality,
with a grand total; the KO keys behind it; and the rates over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq import AS_OF_DEFAULT
from mdq.plans.catalog import catalog_df
from mdq.plans.conform import conformed_written
from mdq.sources.tables import Tables

col = F.col


def _rate(ko: str, n: str):
    """Share of OK keys, (n - ko) / n, rounded half up to 4 decimals with
    integer arithmetic so that every engine gives the same value."""
    return F.expr(f"CAST(((({n} - {ko}) * 20000 + {n}) div (2 * {n})) AS DECIMAL(9,0)) / 10000"
                  ).cast("decimal(9,4)")


def with_catalog(conf: DataFrame, catalog: DataFrame) -> DataFrame:
    """``conf`` with CLASS, CRITICALITY and weight from the catalog (31 rows, or
    31 for each version, broadcast). A dated catalog (VALID_FROM, VALID_TO) is
    joined as of SNAPSHOT_DATE, so a later version changes no earlier rate;
    without SNAPSHOT_DATE its last version counts."""
    cat = catalog.select(col("attribute").alias("ATTRIBUTE"), col("class").alias("CLASS"), col("criticality").alias("CRITICALITY"),
                         F.round(col("criticality_number") * 1000).cast("bigint").alias("_w"),
                         *[col(c).alias(f"_{c}") for c in ("VALID_FROM", "VALID_TO") if c in catalog.columns])
    if "_VALID_FROM" not in cat.columns:
        return conf.join(F.broadcast(cat), "ATTRIBUTE")
    if "SNAPSHOT_DATE" not in conf.columns:
        return conf.join(F.broadcast(cat.where("_VALID_TO IS NULL").drop("_VALID_FROM", "_VALID_TO")), "ATTRIBUTE")
    c = F.broadcast(cat.withColumnRenamed("ATTRIBUTE", "_ATTRIBUTE"))
    held = (col("_VALID_FROM") <= col("SNAPSHOT_DATE")) & (col("_VALID_TO").isNull() | (col("SNAPSHOT_DATE") < col("_VALID_TO")))
    return conf.join(c, (col("ATTRIBUTE") == col("_ATTRIBUTE")) & held).drop("_ATTRIBUTE", "_VALID_FROM", "_VALID_TO")


#: The report's levels: each attribute, class, criticality, and everything.
def _levels(by: list) -> tuple[list, list]:
    c, k, a = col("CLASS"), col("CRITICALITY"), col("ATTRIBUTE")
    return [[*by, c, k, a], [*by, c], [*by, k], by], [*by, c, k, a]


def scorecard(conf: DataFrame, catalog: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per attribute (LEVEL 0), per class (3), per criticality (5) and
    in all (7); ``by`` adds columns of ``conf`` to every level."""
    x = with_catalog(conf, catalog)
    ko_any = F.greatest(col("COMPLETENESS"), F.coalesce(col("ACCURACY"), F.lit(0)))
    sets, names = _levels([col(n) for n in by])
    g = (x.groupingSets(sets, *names)
         .agg(F.grouping_id().cast("int").alias("LEVEL"),
              F.count(F.lit(1)).alias("N_KEYS"),
              F.sum("COMPLETENESS").cast("bigint").alias("COMPLETENESS_KO"),
              F.sum("ACCURACY").cast("bigint").alias("ACCURACY_KO"),
              F.count("ACCURACY").alias("ACCURACY_CHECKED"),
              F.sum(ko_any).cast("bigint").alias("ANY_KO"),
              F.sum(col("_w")).alias("W_TOTAL"),
              F.sum(col("_w") * ko_any).alias("W_KO")))
    return g.select(
        *by, "CLASS", "CRITICALITY", "ATTRIBUTE", "LEVEL", "N_KEYS", "COMPLETENESS_KO", "ACCURACY_KO", "ACCURACY_CHECKED", "ANY_KO",
        _rate("COMPLETENESS_KO", "N_KEYS").alias("COMPLETENESS_RATE"),
        _rate("ACCURACY_KO", "NULLIF(ACCURACY_CHECKED, 0)").alias("ACCURACY_RATE"),
        _rate("W_KO", "W_TOTAL").alias("WEIGHTED_OK_RATE"))


def scorecard_over_time(snapshots: DataFrame, catalog: DataFrame) -> DataFrame:
    """The scorecard of every stored snapshot, with SNAPSHOT_DATE; with a dated
    catalog each by the version of its date."""
    return scorecard(snapshots, catalog, by=("SNAPSHOT_DATE",))


# -- materials ---------------------------------------------------------------
#: log2 of the registers of a sketch: relative standard error 1.04 / sqrt(2^14), 0.8 %.
LG_K = 14


def _materials(conf: DataFrame, catalog: DataFrame) -> DataFrame:
    ko = F.greatest(col("COMPLETENESS"), F.coalesce(col("ACCURACY"), F.lit(0))) == 1
    return with_catalog(conf, catalog).withColumn("_ko", ko).withColumn("_m", F.struct("SOURCE_SYSTEM", "GMID"))


def materials(conf: DataFrame, catalog: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How many different materials (system and number; the NULL number is one)
    each level of the report covers, and how many have a KO there. A material
    counts once in a class, however many of its attributes it fails; key counts
    cannot be added up to that.

    Each level's materials are made distinct before they are counted, so no
    task holds a set; classes and criticalities start from the distinct
    materials of the attributes."""
    c, k, m, own = col("CLASS"), col("CRITICALITY"), col("_m"), [col(n) for n in by]
    ko = F.bool_or("_ko").alias("_ko")
    leaf = _materials(conf, catalog).groupBy(*own, c, k, "ATTRIBUTE", m).agg(ko)
    upper = (leaf.groupBy(*own, c, k, m).agg(ko).groupingSets([[*own, c, m], [*own, k, m], [*own, m]], *own, c, k, m)
             .agg(ko, F.grouping_id().cast("int").alias("LEVEL")))         # one bit for the material below, as for the attribute
    each = leaf.withColumn("LEVEL", F.lit(0)).unionByName(upper.withColumn("ATTRIBUTE", F.lit(None).cast("string")).withColumn("LEVEL", F.col("LEVEL") + 1))
    return (each.groupBy(*by, "CLASS", "CRITICALITY", "ATTRIBUTE", "LEVEL")
            .agg(F.count(F.lit(1)).alias("MATERIALS"), F.count_if("_ko").alias("KO_MATERIALS")))


def material_sketches(conf: DataFrame, catalog: DataFrame, by: tuple[str, ...] = (), lg_k: int = LG_K) -> DataFrame:
    """One row per attribute with two mergeable sketches, of all its materials
    and of those with a KO. Kept for each run, they answer for any class, level
    or span of dates without the snapshots (``materials_of_sketches``)."""
    x = _materials(conf, catalog).withColumn("_id", F.xxhash64(F.isnull("GMID"), "SOURCE_SYSTEM", "GMID"))
    return (x.groupBy(*by, "CLASS", "CRITICALITY", "ATTRIBUTE")
            .agg(F.hll_sketch_agg("_id", lg_k).alias("ALL_SKETCH"), F.hll_sketch_agg(F.when(col("_ko"), col("_id")), lg_k).alias("KO_SKETCH")))


def materials_of_sketches(sketches: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The counts of ``materials``, estimated by merging sketches; rows of other
    columns than ``by`` (say, of several dates) are merged into one."""
    sets, names = _levels([col(n) for n in by])
    size = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    return (sketches.groupingSets(sets, *names)
            .agg(F.grouping_id().cast("int").alias("LEVEL"), size("ALL_SKETCH").alias("MATERIALS"), size("KO_SKETCH").alias("KO_MATERIALS")))


def materials_query(spark: SparkSession, sf_dir: str, as_of: str = AS_OF_DEFAULT) -> DataFrame:
    return materials(conformed_written(Tables.from_tpch(spark, sf_dir, share=True), as_of), catalog_df(spark))


def ko_listing(conf: DataFrame, catalog: DataFrame) -> DataFrame:
    """The keys that fail completeness or accuracy, for inspection."""
    return (with_catalog(conf.where((col("COMPLETENESS") == 1) | (col("ACCURACY") == 1)), catalog)
            .select("CLASS", "CRITICALITY", "ATTRIBUTE", "SOURCE_SYSTEM", "GMID", "COMPLETENESS", "ACCURACY"))


def in_report_order(df: DataFrame) -> DataFrame:
    """Rows in the order of the report: by the naming columns, nulls last."""
    names = [c for c in ("SNAPSHOT_DATE", "CLASS", "CRITICALITY", "ATTRIBUTE", "SOURCE_SYSTEM", "GMID") if c in df.columns]
    return df.orderBy(*[col(c).asc_nulls_last() for c in names])


def scorecard_query(spark: SparkSession, sf_dir: str, as_of: str = AS_OF_DEFAULT) -> DataFrame:
    return scorecard(conformed_written(Tables.from_tpch(spark, sf_dir, share=True), as_of), catalog_df(spark))


def ko_listing_query(spark: SparkSession, sf_dir: str, as_of: str = AS_OF_DEFAULT) -> DataFrame:
    return ko_listing(conformed_written(Tables.from_tpch(spark, sf_dir, share=True), as_of), catalog_df(spark))
