"""Rules on capacities (KAKO) and work centres (CRHD)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.functions import first_match, is_blank, result
from mdq.operators.joins import expand_flag_pairs, flag_presence
from mdq.sources.tables import Tables

SS, MATNR = "SOURCE_SYSTEM", "MATNR"
col = F.col


def dq_kapid(t: Tables, as_of=None) -> DataFrame:
    """R07 capacity id: present and assigned in CRCA; GMID from PP_TABS.

    The reference left-joins the capacities to PP_TABS. One capacity can be
    linked to a large share of all materials, and AQE cannot split the
    non-preserved side of an outer join, so the same rows are built as an
    inner join (splittable on both sides) plus the capacities without any
    link (anti join against the distinct link keys), with GMID NULL.
    """
    crca = t.crca.select(SS, "KAPID", F.lit(True).alias("_in_crca")).distinct()
    checked = (t.kako.select(SS, "KAPID")
               .join(crca, ["KAPID", SS], "left")
               .select(SS, "KAPID",
                       first_match(is_blank("KAPID")).alias("_C"),
                       first_match(is_blank("KAPID"), col("_in_crca").isNull()).alias("_A"))
               .distinct())
    links = (t.pp_tabs.select(col("MARA_SOURCE_SYSTEM").alias(SS), col("KAKO_KAPID").alias("KAPID"),
                              col("MARA_MATNR").alias("GMID"))
             .distinct())
    linked = links.join(checked, ["KAPID", SS])
    unlinked = (checked.join(links.select("KAPID", SS).distinct(), ["KAPID", SS], "left_anti")
                .withColumn("GMID", F.lit(None).cast("string")))
    df = linked.unionByName(unlinked)
    return result(df, SS, "GMID", "KAPID", "_C", "_A")


def _upper_scope(ss: str = SS):
    u = F.upper(col(ss))
    return u.startswith("ATHENA"), u.isin("SHIFT", "P08")


def dq_lvorm(t: Tables, as_of=None) -> DataFrame:
    """R10 work-centre deletion flag per material of the work centre's plant.

    Polarity as in the reference: 1 = flag set (the reference calls 1 OK);
    the conformed view flips it. The scope filters keep the reference's
    operator precedence: (A AND B) OR C.

    Instead of joining every work centre to every material of its plant,
    the work centres are summarised per (system, plant) into the flag values
    that occur, that summary is joined to the distinct (system, material,
    plant) links, and the values are collected per material.
    """
    athena, extra = _upper_scope()
    lv = col("LVORM")
    c_set = lv.isNotNull() & (F.trim(lv) != "")
    per_plant = (t.crhd.where(((col("OBJTY") == "A") & athena) | extra)
                 .where(col("WERKS").isNotNull())
                 .groupBy(SS, "WERKS")
                 .agg(*flag_presence(c_set, ~c_set, lv.isNotNull(), lv.isNull())))
    m_athena, m_extra = _upper_scope()
    mara = t.mara.where((col("LVORM").isNotNull() & m_athena) | m_extra).select(SS, MATNR).distinct()
    marc = t.marc.where(col("WERKS").isNotNull()).select(MATNR, "WERKS").distinct()
    links = mara.join(marc, MATNR)
    g = (links.join(per_plant, [SS, "WERKS"])
         .groupBy(SS, MATNR)
         .agg(F.bool_or("_c1").alias("_c1"), F.bool_or("_c0").alias("_c0"),
              F.bool_or("_a1").alias("_a1"), F.bool_or("_a0").alias("_a0")))
    df = expand_flag_pairs(g)
    return result(df, SS, MATNR, "LVORM", "COMPLETENESS", "ACCURACY", distinct=False)
