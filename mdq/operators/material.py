"""Rules on order units and conversions (EINA against MARA / MARM)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.functions import first_match, result
from mdq.functions.scope import active_pir, contains_scope
from mdq.sources.tables import Tables

SS, MATNR = "SOURCE_SYSTEM", "MATNR"
col = F.col


def lmein_flags():
    z, n, lmein, base = col("UMREZ"), col("UMREN"), col("LMEIN"), col("_BASE")
    missing = lmein.isNull() | (lmein == "")
    return first_match(missing), first_match(missing, base.isNull(), lmein != base, z <= 0, n <= 0)


def dq_lmein(t: Tables, as_of=None) -> DataFrame:
    """R08 PIR order unit against the material's base unit.

    MARA is matched on the material number alone (all systems), so both
    sides are reduced to the distinct values the flags read first.
    """
    z, n = col("UMREZ"), col("UMREN")
    eina = (t.eina.select(SS, MATNR, "LMEIN",
                          (z.isNotNull() & (z <= 0)).alias("_z_bad"),
                          (n.isNotNull() & (n <= 0)).alias("_n_bad"))
            .distinct())
    mara = t.mara.select(MATNR, col("MEINS").alias("_BASE")).distinct()
    df = eina.join(mara, MATNR, "left")
    lmein, base = col("LMEIN"), col("_BASE")
    missing = lmein.isNull() | (lmein == "")
    c = first_match(missing)
    a = first_match(missing, base.isNull(), lmein != base, col("_z_bad"), col("_n_bad"))
    return result(df, SS, MATNR, "LMEIN", c, a)


def meins_flags(in_marm):
    z, n = col("UMREZ"), col("UMREN")
    return (first_match(col("MEINS").isNull()),
            first_match(~F.coalesce(in_marm, F.lit(False)), z.isNull() | (z <= 0), n.isNull() | (n <= 0),
                        (col("MEINS") == col("_BASE")) & ((z != 1) | (n != 1))))


def dq_meins(t: Tables, as_of=None) -> DataFrame:
    """R11 PIR order unit (EINA.MEINS): defined in MARM, valid ratio, 1:1
    when equal to the base unit. Label MEINS_EINA."""
    z, n = col("UMREZ"), col("UMREN")
    eina = (t.eina.select(SS, MATNR, "MEINS",
                          (z.isNull() | (z <= 0)).alias("_z_bad"),
                          (n.isNull() | (n <= 0)).alias("_n_bad"),
                          ((z != 1) | (n != 1)).alias("_not_1_1"))
            .distinct())
    mara = t.mara.select(MATNR, col("MEINS").alias("_BASE")).distinct()
    marm = t.marm.select(MATNR, col("MEINH").alias("MEINS"), F.lit(True).alias("_in_marm")).distinct()
    df = eina.join(mara, MATNR, "left").join(marm, [MATNR, "MEINS"], "left")
    c = first_match(col("MEINS").isNull())
    a = first_match(col("_in_marm").isNull(), col("_z_bad"), col("_n_bad"),
                    (col("MEINS") == col("_BASE")) & col("_not_1_1"))
    return result(df, SS, MATNR, "MEINS_EINA", c, a)


def conversion_flags(ou, bu):
    z, n = col("UMREZ"), col("UMREN")
    c = first_match((ou != bu) & n.isNull(), (ou != bu) & z.isNull(),
                    n.isNotNull() & z.isNull(), z.isNotNull() & n.isNull())
    a = first_match(c == 1, n <= 0, z <= 0,
                    (n != 0) & ((z * 10000 < n) | (z > n * 10000)),
                    (ou == bu) & ((n != 1) | (z != 1)))
    return c, a


def ratio_kind():
    """What the flags ask of UMREZ and UMREN, as one small number: NULL (0), not
    positive (1) or positive (2) each (UMREZ times 3), and, of two positive ones,
    8 if the ratio is 1:1, 9 if it is another, 10 if it is out of bounds."""
    z, n = col("UMREZ"), col("UMREN")
    kind = lambda x: F.when(x.isNull(), 0).when(x <= 0, 1).otherwise(2)
    far = F.when((z * 10000 < n) | (z > n * 10000), 10).when((z == 1) & (n == 1), 8).otherwise(9)
    return F.when((z > 0) & (n > 0), far).otherwise(kind(z) * 3 + kind(n)).cast("tinyint")


def ratio_of(kind: str) -> dict:
    """UMREZ and UMREN that the flags answer like those of this ``ratio_kind``."""
    k = col(kind)
    value = lambda x: F.when(x == 1, F.lit(-1)).when(x == 2, F.lit(1))
    n = F.when(k == 8, 1).when(k == 9, 2).when(k == 10, 20000).otherwise(value(k % 3))
    return {"UMREZ": F.when(k >= 8, 1).otherwise(value(F.floor(k / 3))), "UMREN": n}


def conversion_checks(t: Tables) -> DataFrame:
    """Per active PIR in scope with an undeleted material: completeness and
    accuracy of the order-unit conversion (UMREZ / UMREN).

    Every branch of both CASEs yields 1, so their order does not matter and
    UMREN and UMREZ share this frame. The ratio bounds are compared by
    cross-multiplication, exact for decimals; the earlier branches leave only
    positive values at that point.
    """
    eina = (t.eina.where(contains_scope() & active_pir())
            .select(SS, MATNR, "UMREZ", "UMREN", col("LMEIN").alias("_ORDER_UNIT")))
    mara = t.mara.where(col("LVORM").isNull()).select(SS, MATNR, col("MEINS").alias("_BASE_UNIT"))
    df = eina.join(mara, [MATNR, SS])
    c, a = conversion_flags(col("_ORDER_UNIT"), col("_BASE_UNIT"))
    return df.withColumn("_C", c).withColumn("_A", a)


def _max_per_material(df: DataFrame, label: str) -> DataFrame:
    return (df.groupBy(SS, MATNR)
            .agg(F.max("_C").alias("COMPLETENESS"), F.max("_A").alias("ACCURACY"))
            .select(col(SS).alias("SOURCE_SYSTEM"), col(MATNR).alias("GMID"), F.lit(label).alias("ATTRIBUTE"),
                    col("COMPLETENESS").cast("int").alias("COMPLETENESS"),
                    col("ACCURACY").cast("int").alias("ACCURACY")))


def dq_umren(t: Tables, as_of=None) -> DataFrame:
    """R21 order-unit conversion, denominator; one row per material."""
    return _max_per_material(conversion_checks(t), "UMREN")


def dq_umrez(t: Tables, as_of=None) -> DataFrame:
    """R22 order-unit conversion, numerator; one row per material."""
    return _max_per_material(conversion_checks(t), "UMREZ")
