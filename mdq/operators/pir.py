"""Rules on purchasing info records (EINE conditions, EINA general data).

Each rule returns SOURCE_SYSTEM, GMID, ATTRIBUTE, COMPLETENESS, ACCURACY with
1 = KO and 0 = OK. Joins that the reference writes without the full key
(INFNR alone, EKORG alone, plant alone) fan out; the dimension side is
reduced to the distinct values the flags read before the join, which gives
the same rows under the final DISTINCT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdq.functions import any_date, first_match, is_blank, ok_only_if, per_date, result
from mdq.functions.scope import active_pir, contains_scope, prefix_scope
from mdq.operators.joins import expand_copies, expand_flag_pairs, flag_presence, left_join, spread_join
from mdq.session import parts_by_size
from mdq.sources.tables import Tables

SS, INFNR, MATNR = "SOURCE_SYSTEM", "INFNR", "MATNR"
col = F.col


def _pir(t: Tables, *cols) -> DataFrame:
    """Rows of the shared EINE-EINA join (every EINE row, with its EINA
    partners of the same info record and system, or one unmatched row)."""
    return t.pir.select(SS, INFNR, *cols)


def ACTIVE():
    """Inner join to active general data: a partner exists and is not deleted."""
    return col("_HAS_EINA") & col("EINA_LOEKZ").isNull()


@dataclass(frozen=True)
class PirCheck:
    """A rule that decides each row of the shared join by itself."""
    where: Column
    completeness: Column
    accuracy: Column
    bag: bool = False           # duplicates are kept


def _checked(t: Tables, label: str, k: PirCheck) -> DataFrame:
    return result(t.pir.where(k.where), SS, MATNR, label, k.completeness, k.accuracy, distinct=not k.bag)


def dq_aplfz(t: Tables, as_of=None) -> DataFrame:
    """R01 planned delivery time (EINE.APLFZ) against the plant data (MARC)."""
    # Only the values matter: a hot material (or the NULL one) is down to its
    # distinct values before the join, by map-side aggregation.
    return aplfz_of(t, _pir(t, MATNR, "APLFZ", "_HAS_EINA", "EINA_LOEKZ").where(ACTIVE() & prefix_scope())
                    .select(SS, MATNR, "APLFZ").distinct())


def aplfz_of(t: Tables, base: DataFrame) -> DataFrame:
    """R01 of a material's different delivery times."""
    # MARC carries one row per plant; keep only the values the flags read.
    marc = t.marc.select(SS, MATNR, "PLIFZ", (col("BESKZ") == "F").alias("_ext")).distinct()
    df = base.join(marc, [MATNR, SS], "left")
    aplfz, plifz = col("APLFZ"), col("PLIFZ")
    c = first_match(aplfz.isNull(), aplfz == 0)
    a = first_match(aplfz <= 0, plifz.isNotNull() & (aplfz != plifz), col("_ext") & (aplfz < 1))
    return result(df, SS, MATNR, "APLFZ", c, a)


def _price_units(field: str):
    """Scope and unit tests that the two price-unit rules share."""
    loekz = col("EINA_LOEKZ")
    where = col("_HAS_EINA") & (loekz.isNull() | (loekz == "")) & prefix_scope() & col(field).isNotNull()
    same = F.trim(col("BPRME")) == F.trim(col("MEINS"))
    differ = F.trim(col("BPRME")) != F.trim(col("MEINS"))
    return where, same, differ, col("BPUMN"), col("BPUMZ")


def bpumn() -> PirCheck:
    where, same, differ, n, z = _price_units("BPUMN")
    return PirCheck(where, first_match(is_blank("BPRME"), is_blank("MEINS"), n.isNull(), z.isNull()),
                    first_match(same & ((n != 1) | (z != 1)), differ & (n == 1) & (z == 1), z == 0), bag=True)


def bpumz() -> PirCheck:
    where, same, differ, n, z = _price_units("BPUMZ")
    return PirCheck(where, first_match(z.isNull(), is_blank("BPRME"), is_blank("MEINS")),
                    first_match(z == 0, z < 0, same & (z != 1), differ & (z == 1) & (n == 1)), bag=True)


def dq_bpumn(t: Tables, as_of=None) -> DataFrame:
    """R03 order-price-unit conversion, BPUMN (bag: duplicates kept)."""
    return _checked(t, "BPUMN", bpumn())


def dq_bpumz(t: Tables, as_of=None) -> DataFrame:
    """R04 order-price-unit conversion, BPUMZ (bag)."""
    return _checked(t, "BPUMZ", bpumz())


def _distinct_by_record(rows: DataFrame, n: int) -> DataFrame:
    """The different ``rows``. Of large input (``n`` partitions by its size)
    nearly all are different, so they go straight to their info record and are
    made distinct there: one shuffle, which a join by the record can use, and
    no task's memory grows with the input."""
    return (rows.repartition(n, INFNR) if n else rows).distinct()


def record_materials(t: Tables, n: int | None = None) -> DataFrame:
    """The different (INFNR, MATNR) of EINA."""
    rows = t.eina.where(col(INFNR).isNotNull()).select(INFNR, MATNR)
    return _distinct_by_record(rows, parts_by_size(rows) if n is None else n)


def material_of(t: Tables, eine: DataFrame, *flags: Column) -> DataFrame:
    """SS, MATNR and ``flags`` of the rows of ``eine``: the materials by info
    record alone, in whatever system. Rows without an info record, few when they
    are distinct, go past the join."""
    n = max(parts_by_size(eine), parts_by_size(t.eina))
    rows = eine.select(SS, INFNR, *flags)
    joined = _distinct_by_record(rows.where(col(INFNR).isNotNull()), n).join(record_materials(t, n), INFNR, "left").drop(INFNR)
    none = rows.where(col(INFNR).isNull()).drop(INFNR).distinct()
    return joined.unionByName(none.withColumn(MATNR, F.lit(None).cast(joined.schema[MATNR].dataType)))


#: Parts into which each purchasing organisation is dealt for the join with the vendor data.
SPREAD = 64


def with_vendor(t: Tables, eine: DataFrame) -> DataFrame:
    """``eine`` with the vendors' confirmation keys (_VM_BSTAE) of the purchasing
    organisation. There are few organisations, so each one's rows are dealt to
    ``SPREAD`` parts, and the different (organisation, key) go to all of these."""
    vm = (t.lfm2.where("EKORG is not null").select("EKORG", col("BSTAE").alias("_VM_BSTAE")).distinct()
          .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))))
    eine = eine.select(SS, INFNR, "EKORG", "BSTAE", "UEBTK", F.pmod(F.xxhash64(INFNR, SS), F.lit(SPREAD)).cast("int").alias("_part"))
    return left_join(eine, vm, ["EKORG", "_part"])


def bstae_flags():
    """Completeness and accuracy of a row of ``with_vendor``."""
    bstae, vm_bstae = col("BSTAE"), col("_VM_BSTAE")
    return first_match(bstae.isNull()), first_match(bstae.isNull(), vm_bstae.isNotNull() & (bstae != vm_bstae))


def dq_bstae(t: Tables, as_of=None) -> DataFrame:
    """R05 confirmation control key against the vendor's purchasing-org data.

    The vendor master is matched on EKORG only and EINA on INFNR only; both
    are reduced to distinct (key, value) first.
    """
    c, a = bstae_flags()
    checked = material_of(t, with_vendor(t, t.eine.where(prefix_scope())), c.alias("_C"), a.alias("_A"))
    return result(checked, SS, MATNR, "BSTAE", "_C", "_A")


def effpr() -> PirCheck:
    """Completeness and accuracy of a single row: no price, price 0, any other."""
    p = col("EFFPR")
    return PirCheck(ACTIVE() & prefix_scope(), first_match(p.isNull()), F.when(p.isNotNull(), first_match(p == 0)))


def dq_effpr(t: Tables, as_of=None) -> DataFrame:
    """R06 effective price.

    Per (system, material): every completeness value seen, paired with every
    accuracy value seen over the priced rows; accuracy is NULL when the
    material has no priced row or the material number is NULL.
    """
    k = effpr()
    c, a = k.completeness, k.accuracy
    g = (_pir(t, MATNR, "EFFPR", "_HAS_EINA", "EINA_LOEKZ").where(k.where).withColumnRenamed(MATNR, "GMID")
         .groupBy(SS, "GMID").agg(*flag_presence(c == 1, c == 0, a == 1, a == 0)))
    df = expand_flag_pairs(g, accuracy_null=col("GMID").isNull() | ~(col("_a1") | col("_a0")))
    return result(df, SS, "GMID", "EFFPR", "COMPLETENESS", "ACCURACY", distinct=False)


def dq_loekz(t: Tables, as_of=None) -> DataFrame:
    """R09 deactivation flag of expired PIRs in active plants (disabled in
    the catalog). GMID carries the info record number.

    EINE joins MARC on (system, plant) only; MARC is first reduced to the
    distinct (system, plant, plant-flag-blank) values, at most two per plant.
    """
    expired = lambda d: col("PRDAT") < d
    eine = t.eine.where(any_date(as_of, expired)).select(SS, "WERKS", INFNR, "LOEKZ", per_date(as_of, expired).alias("_on"))
    plants = t.marc.select(SS, "WERKS", (F.coalesce(col("LVORM"), F.lit("")) == "").alias("_plant_open")).distinct()
    df = eine.join(plants, [SS, "WERKS"])
    infnr = F.coalesce(col(INFNR), F.lit(""))
    c = first_match(infnr == "")
    a = first_match((infnr != "") & col("_plant_open") & (col("LOEKZ") != "X"))
    return result(df, SS, INFNR, "deactivation flag", per_date(as_of, lambda d: c, "_on"), per_date(as_of, lambda d: a, "_on"))


def meprf() -> PirCheck:
    return PirCheck(ACTIVE() & prefix_scope(), first_match(is_blank("MEPRF")),
                    first_match(is_blank("MEPRF"), ~F.trim(col("MEPRF")).isin("1", "2")))


def dq_meprf(t: Tables, as_of=None) -> DataFrame:
    """R12 pricing date control: must be '1' or '2'."""
    return _checked(t, "MEPRF", meprf())


def mhdrz() -> PirCheck:
    m = col("MHDRZ")
    return PirCheck(ACTIVE() & contains_scope(), first_match(m.isNull(), m == 0), first_match(m.isNull(), m < 0, m == 0, m > 3650))


def dq_mhdrz_eine(t: Tables, as_of=None) -> DataFrame:
    """R13 minimum remaining shelf life: present, positive, at most 3650."""
    return _checked(t, "MHDRZ_EINE", mhdrz())


def dq_minbm(t: Tables, as_of=None) -> DataFrame:
    """R14 minimum order quantity: a multiple of the plant's rounding value.

    EINA is matched on INFNR only, MARA and MARC on the material number
    without system; each is reduced to the distinct values used. MARA, which
    only tells whether the material exists, is joined to the distinct flags of
    the materials and not to the longer EINE. MARC's rows of a material and plant
    (one for each system) are brought together once, for DISTINCT and join. Rows
    without an info record go past the join, those without a material or plant
    are spread.
    """
    eine = t.eine.select(SS, INFNR, "WERKS", "MINBM")
    return minbm_of(t, left_join(eine, record_materials(t), [INFNR]))


def with_rounding(t: Tables, rows: DataFrame) -> DataFrame:
    """``rows`` (with material and plant) with each rounding value (BSTRF) of their plant."""
    marc = (t.marc.where(col(MATNR).isNotNull() & col("WERKS").isNotNull())
            .select(MATNR, "WERKS", "BSTRF").repartition(MATNR, "WERKS").distinct())
    return spread_join(rows, marc, [MATNR, "WERKS"])


def minbm_flags(r: Column | None = None):
    """Completeness and accuracy of a row of ``with_rounding``, or against the rounding value ``r``."""
    q, r = col("MINBM"), col("BSTRF") if r is None else r
    return first_match(q.isNull()), ok_only_if(minbm_sound() & r.isNotNull() & (r != 0) & (F.abs(F.try_mod(q, r)) < F.lit(1e-9)))


def minbm_sound() -> Column:
    """Whether the quantity is right by itself, so that its plants decide."""
    q = col("MINBM")
    return q.isNotNull() & (F.abs(q) < 100000000) & (F.round(q, 3) == q)


def minbm_of(t: Tables, rows: DataFrame) -> DataFrame:
    """R14 of system, material, plant and minimum order quantity."""
    c, a = minbm_flags()
    return minbm_rows(t, with_rounding(t, rows).select(SS, MATNR, c.alias("_C"), a.alias("_A")).distinct())


def minbm_rows(t: Tables, flags: DataFrame) -> DataFrame:
    """R14 of the flags (_C, _A) that occur for a system and material."""
    mara = t.mara.where(col(MATNR).isNotNull()).select(MATNR).distinct().withColumn("GMID", col(MATNR))
    return result(flags.join(mara, MATNR, "left"), SS, "GMID", "MINBM", "_C", "_A")


def netpr() -> PirCheck:
    """The active test sits after an outer join, so PIRs without general data stay (GMID NULL)."""
    p = col("NETPR")
    return PirCheck(prefix_scope() & col("EINA_LOEKZ").isNull(), first_match(p.isNull()), first_match(p == 0))


def dq_netpr(t: Tables, as_of=None) -> DataFrame:
    """R15 net price."""
    return _checked(t, "NETPR", netpr())


def peinh() -> PirCheck:
    p, i = col("PEINH"), col(INFNR)
    return PirCheck(prefix_scope(), first_match(p.isNull()), ok_only_if(i.isNotNull() & (F.trim(i) != "") & (p > 0)))


def dq_peinh(t: Tables, as_of=None) -> DataFrame:
    """R17 price unit: positive on an existing PIR."""
    return _checked(t, "PEINH", peinh())


def marc_days(t: Tables) -> DataFrame:
    """Least and greatest goods-receipt time of a material over its plants (missing: 0)."""
    w = F.coalesce(col("WEBAZ"), F.lit(0))
    return t.marc.where(col(MATNR).isNotNull()).groupBy(SS, MATNR).agg(F.min(w).alias("_w0"), F.max(w).alias("_w1"))


def prdat_flag(as_of, value: int):
    """Accuracy ``value`` occurs among a material's dated prices at the as-of
    date: its first price date (for 1; its last for 0) against as-of + 5 days +
    the longest (shortest) goods-receipt time of its plants."""
    day = lambda d, w: F.date_add(d, (F.lit(5) + F.coalesce(col(w), F.lit(0))).cast("int"))
    if value:
        return per_date(as_of, lambda d: col("_p0") <= day(d, "_w1"))
    return per_date(as_of, lambda d: col("_p1") > day(d, "_w0"))


def dq_prdat(t: Tables, as_of=None) -> DataFrame:
    """R18 price valid until: later than as-of + 5 days + goods-receipt time.

    Each price date of a material is held against each of its plants. What can
    come out is known from the first and last date and the shortest and longest
    time, so both sides are one row per material before the join, and the join
    needs no shuffle of its own."""
    k = prdat()
    base = (_pir(t, MATNR, "PRDAT", "_HAS_EINA", "EINA_LOEKZ").where(k.where).groupBy(SS, MATNR)
            .agg(F.min("PRDAT").alias("_p0"), F.max("PRDAT").alias("_p1"), F.bool_or(col("PRDAT").isNull()).alias("_none")))
    df = base.join(marc_days(t), [SS, MATNR], "left")
    one, zero, many = prdat_flag(as_of, 1), prdat_flag(as_of, 0), isinstance(as_of, (list, tuple))
    flag = lambda yes, no: F.transform(yes, lambda x: F.when(x, F.lit(1)).otherwise(F.lit(0))) if no is None else F.when(yes, 1).otherwise(0)
    has1 = flag(one, None) if many else flag(one, 0)
    has0 = F.transform(zero, lambda x: F.when(x, F.lit(0)).otherwise(F.lit(1))) if many else F.when(zero, 0).otherwise(1)
    ones = per_date(as_of, lambda d: F.lit(1))
    row = lambda c, a: F.struct(F.lit(c).alias("_C"), a.alias("_A"))
    dated = col("_p0").isNotNull()
    rows = F.array(F.when(col("_none"), row(1, ones)), F.when(dated, row(0, has1)), F.when(dated, row(0, has0)))
    df = df.withColumn("_r", F.explode(F.array_distinct(F.array_compact(rows)))).select(SS, MATNR, "_r.*")
    return result(df, SS, MATNR, "PRDAT", "_C", "_A", distinct=False)


def prdat_worst(t: Tables, base: DataFrame, as_of) -> DataFrame:
    """R18 where only the worst flags count, at each of several dates, of the first
    price date (_p0) of a system and material (GMID) and whether one has none (_none)."""
    df = base.select(SS, "GMID", "_p0", "_none").join(marc_days(t).withColumnRenamed(MATNR, "GMID"), [SS, "GMID"], "left")
    late = F.transform(prdat_flag(as_of, 1), lambda x: F.when(col("_none") | x, 1).otherwise(0))
    return result(df.where(col("_none") | col("_p0").isNotNull()), SS, "GMID", "PRDAT", col("_none").cast("int"), late, distinct=False)


def prdat() -> PirCheck:
    """Scope of the rule; its accuracy needs the plants (``dq_prdat``)."""
    return PirCheck(ACTIVE() & prefix_scope(), first_match(col("PRDAT").isNull()), F.lit(None).cast("int"))


def uebtk_flags():
    i = col(INFNR)
    return first_match(is_blank("UEBTK")), ok_only_if(i.isNotNull() & (F.trim(i) != "") & (col("UEBTK") == "X"))


def dq_uebtk(t: Tables, as_of=None) -> DataFrame:
    """R19 unlimited overdelivery: KO unless set to 'X' on an existing PIR.
    (The reference also joins MARA without reading it; that join changes no
    row under DISTINCT and is left out.)"""
    c, a = uebtk_flags()
    return result(material_of(t, t.eine, c.alias("_C"), a.alias("_A")), SS, MATNR, "UEBTK", "_C", "_A")


def uebto_flags():
    u = col("UEBTO")
    return first_match(u.isNull()), first_match(u.isNull() | (u < 5) | (u > 10))


def dq_uebto(t: Tables, as_of=None) -> DataFrame:
    """R20 overdelivery tolerance between 5 and 10 inclusive (bag)."""
    eine = t.eine.where(prefix_scope()).select(SS, INFNR, "UEBTO")
    eina = t.eina.where(active_pir() & prefix_scope()).select(SS, INFNR, MATNR)
    return result(left_join(eine, eina, [INFNR, SS]), SS, MATNR, "UEBTO", *uebto_flags(), distinct=False)


def untto_counts(t: Tables) -> DataFrame:
    """R23 without multiplicities: SOURCE_SYSTEM, GMID, flags and how many
    rows of the bag have them (column _n).

    The rule joins the active general data twice on the same key, so a PIR
    with k active rows yields each (PIR, EINA) pair k times. Every input is
    counted per value before it is joined; no pair is ever produced twice and
    a hot info record or material is combined before the shuffle.
    """
    eine = t.eine.where(prefix_scope()).groupBy(SS, INFNR, "UNTTO").agg(F.count("*").alias("_e"))
    act = (t.eina.where(active_pir() & prefix_scope())
           .groupBy(SS, INFNR, col(MATNR).alias("GMID")).agg(F.count("*").alias("_p")))
    k = act.groupBy(SS, INFNR).agg(F.sum("_p").alias("_k"))
    pairs = (eine.join(act, [INFNR, SS]).join(k, [INFNR, SS])
             .groupBy(SS, "GMID", "UNTTO").agg(F.sum(col("_e") * col("_p") * col("_k")).alias("_n")))
    return untto_of(t, pairs)


def untto_of(t: Tables, pairs: DataFrame) -> DataFrame:
    """R23 of the different tolerances of a material and how many rows have them."""
    marc = (t.marc.where(prefix_scope()).groupBy(SS, col(MATNR).alias("GMID"), col("UNETO").alias("_MM_UNETO"))
            .agg(F.count("*").alias("_m")))
    df = pairs.join(marc, ["GMID", SS], "left")
    u, m = col("UNTTO"), col("_MM_UNETO")
    c = first_match(u.isNull())
    a = first_match(u.isNull(), (u < 5) | (u > 10), m.isNull(), u != m)
    return (result(df.withColumn("_C", c).withColumn("_A", a).withColumn("_n", col("_n") * F.coalesce(col("_m"), F.lit(1))),
                   SS, "GMID", "UNTTO", "_C", "_A", distinct=False, also=("_n",))
            .groupBy("SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "COMPLETENESS", "ACCURACY").agg(F.sum("_n").alias("_n")))


def dq_untto(t: Tables, as_of=None) -> DataFrame:
    """R23 underdelivery tolerance against the plant value (bag): the counted rows, expanded."""
    return expand_copies(untto_counts(t), "_n")
