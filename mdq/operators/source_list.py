"""Rules on the source list (EORD) and material plant status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.functions import first_match, is_blank, per_date, result
from mdq.functions.scope import contains_scope
from mdq.sources.tables import Tables

SS, MATNR = "SOURCE_SYSTEM", "MATNR"
col = F.col

# Status codes that exclude a material or plant from R02.
MARA_EXCLUDED_STATUS = ("XX", "WF")
MARA_MATERIAL_TYPES = ("PM", "RM", "AI")
MARC_EXCLUDED_STATUS = ("XX", "WF", "MC", "NE", "IN", "XO")
OPEN_END = "9999-12-31"


def dq_bdatu(t: Tables, as_of=None) -> DataFrame:
    """R02 source-list end date for externally procured, active materials.

    A material without any source-list row at its plant is KO on both flags.
    The source list is reduced to its distinct flag pairs per plant first.
    """
    mara = (t.mara.where(~col("MSTAE").isin(*MARA_EXCLUDED_STATUS) & col("ZMTAR").isin(*MARA_MATERIAL_TYPES))
            .select(SS, MATNR))
    mmsta, dismm = col("MMSTA"), col("DISMM")
    marc = (t.marc.where((~mmsta.isin(*MARC_EXCLUDED_STATUS) | mmsta.isNull())
                         & col("LVORM").isNull() & (col("BESKZ") == "F")
                         & ((dismm != "ND") | dismm.isNull()) & contains_scope())
            .select(SS, MATNR, "WERKS"))
    b = col("BDATU")
    eord = (t.eord.select(SS, MATNR, "WERKS",
                          first_match(b.isNull()).alias("_C"),
                          per_date(as_of, lambda d: first_match(b.isNull(), (b != F.lit(OPEN_END).cast("date")) & (b < d)))
                          .alias("_A"))
            .distinct())
    df = mara.join(marc, [MATNR, SS]).join(eord, [MATNR, "WERKS", SS], "left")
    return result(df, SS, MATNR, "BDATU", F.coalesce(col("_C"), F.lit(1)), F.coalesce(col("_A"), per_date(as_of, lambda d: F.lit(1))))


def dq_notkz(t: Tables, as_of=None) -> DataFrame:
    """R16 blocked-supplier indicator (bag over the distinct source list)."""
    base = (t.eord.where(contains_scope())
            .select(SS, MATNR, "WERKS", "LIFNR", "NOTKZ", "AUTET", "FLIFN", "BDATU")
            .distinct())
    nk = col("NOTKZ")
    blocked = nk == "X"
    c = first_match(is_blank(nk))
    a = per_date(as_of, lambda d: first_match(
        is_blank(nk), ~F.trim(nk).isin("X", ""),
        blocked & col("AUTET").isin("1", "2"),
        blocked & (col("FLIFN") == "X"),
        blocked & (col("BDATU") < F.date_sub(d, 365))))
    return result(base, SS, MATNR, "NOTKZ", c, a, distinct=False)


def dq_vdatu(t: Tables, as_of=None) -> DataFrame:
    """R24 source-list start date equals creation date; MAX per material."""
    v, e = col("VDATU"), col("ERDAT")
    return (t.eord.where(contains_scope())
            .groupBy(SS, MATNR)
            .agg(F.max(first_match(v.isNull())).alias("COMPLETENESS"),
                 F.max(first_match(v.isNull(), e.isNull(), v != e)).alias("ACCURACY"))
            .select(col(SS).alias("SOURCE_SYSTEM"), col(MATNR).alias("GMID"), F.lit("VDATU").alias("ATTRIBUTE"),
                    col("COMPLETENESS").cast("int").alias("COMPLETENESS"),
                    col("ACCURACY").cast("int").alias("ACCURACY")))
