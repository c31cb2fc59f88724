"""Rules that read the same rows, evaluated together.

Nine rules decide rows of the join of EINE and EINA, four the rows of the
transport lanes, two the same conversion factors, two an info record by itself.
Run one by one, each repeats scan, join and shuffle. Here the rows carry the
flags of all rules of their family, one aggregation by (system, material)
keeps which flags occur (as bits of one number, or counts where duplicates
matter), and these are unfolded into the rules' rows:

``suite_rows``      the rows that the rules give (duplicates kept where a rule keeps them)
``conformed_rows``  the worst flags of each rule per (system, material)

Both give exactly what the rules give one by one. APLFZ compares every value of
a material with every plant value; which pairs of flags occur needs the values
themselves, so in ``suite_rows`` it stays a rule of its own, while its worst
flags follow from the least and greatest values (``conformed_rows``). So do
those of UNTTO, whose rows in the bag need its counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdq.functions import kinaxis
from mdq.functions.scope import contains_scope, prefix_scope
from mdq.operators import bod, material, pir
from mdq.operators.joins import expand_copies
from mdq.plans.catalog import OK_IS_ONE
from mdq.sources.tables import Tables

col = F.col
SS, GMID, MATNR = "SOURCE_SYSTEM", "GMID", "MATNR"
ROW = "struct<ATTRIBUTE:string,COMPLETENESS:int,ACCURACY:int,_n:bigint>"

#: Rules of the shared join that decide a row by itself, and where they are defined.
ROWWISE = {"dq_bpumn": pir.bpumn, "dq_bpumz": pir.bpumz, "dq_effpr": pir.effpr, "dq_meprf": pir.meprf,
           "dq_mhdrz_eine": pir.mhdrz, "dq_netpr": pir.netpr, "dq_peinh": pir.peinh}
SITES = {"dq_from_site": ("FROM_SITE", "FROM_SITE_UID"), "dq_to_site": ("SITE", "SITE_UID")}
BY_RECORD = ("dq_bstae", "dq_uebtk")
CONVERSION = ("dq_umren", "dq_umrez")
PIR_FAMILY = (*ROWWISE, "dq_prdat", "dq_aplfz")
LANES = (*SITES, "dq_effective_end_date", "dq_to_gmid")


def _count(where: Column, c: Column, a: Column, name: str) -> list[Column]:
    """A count for each pair of flags (accuracy 2 stands for NULL), named <name>_<c><a>."""
    a = F.coalesce(a, F.lit(2))
    return [F.count_if(where & (c == i) & (a == j)).alias(f"{name}_{i}{j}") for i in (0, 1) for j in (0, 1, 2)]


def _facts(named: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
    """(one number for each row, the columns by which its bits, once they were
    brought together by ``bit_or``, are read): a bit for each condition."""
    bits = [F.when(cond, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, cond in enumerate(named.values())]
    return reduce(lambda x, y: x.bitwiseOR(y), bits), {n: F.shiftright("_bits", i).bitwiseAND(F.lit(1).cast("bigint")) for i, n in enumerate(named)}


def _pair_facts(where: Column, c: Column, a: Column, name: str) -> dict[str, Column]:
    """A condition for each pair of flags, named as ``_count`` names them."""
    a = F.coalesce(a, F.lit(2))
    return {f"{name}_{i}{j}": where & (c == i) & (a == j) for i in (0, 1) for j in (0, 1, 2)}


def _n(name: str, c=(0, 1), a=(0, 1, 2)) -> Column:
    """How many rows have one of these flags."""
    return reduce(lambda x, y: x + y, [col(f"{name}_{i}{j}") for i in c for j in a])


def _row(label: str, c, a, n) -> Column:
    lit = lambda x: x.cast("int") if isinstance(x, Column) else F.lit(x).cast("int")
    return F.struct(F.lit(label).alias("ATTRIBUTE"), lit(c).alias("COMPLETENESS"), lit(a).alias("ACCURACY"), n.cast("bigint").alias("_n"))


def _pairs(name: str, label: str, bag: bool) -> list[Column]:
    """A row for each pair of flags that occurs, with its count where it matters."""
    out = []
    for i in (0, 1):
        for j in (0, 1, 2):
            n = col(f"{name}_{i}{j}")
            out.append(F.when(n > 0, _row(label, i, None if j == 2 else j, n if bag else F.lit(1))))
    return out


def _effpr_pairs(name: str, label: str) -> list[Column]:
    """R06: every completeness value that occurs with every accuracy value that
    does; NULL accuracy where no row has a price or the material is NULL."""
    priced = (_n(name, a=(0, 1)) > 0) & col(GMID).isNotNull()
    out = []
    for i in (0, 1):
        some = _n(name, c=(i,)) > 0
        out += [F.when(some & priced & (_n(name, a=(j,)) > 0), _row(label, i, j, F.lit(1))) for j in (0, 1)]
        out.append(F.when(some & ~priced, _row(label, i, None, F.lit(1))))
    return out


def _worst(name: str, label: str, flip: bool = False) -> Column:
    """The greatest flags that occur (of flags counted by ``_count``)."""
    top = lambda yes, no: F.when(yes > 0, 1).when(no > 0, 0)
    c = top(_n(name, c=(1,)), _n(name, c=(0,)))
    a = top(_n(name, a=(1,)), _n(name, a=(0,)))
    return F.when(c.isNotNull(), _row(label, c, a, F.lit(1)))


def _unfold(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(SS, GMID, F.explode(F.array_compact(F.array(*[r.cast(ROW) for r in rows]))).alias("r")).select(SS, GMID, "r.*")


# -- the rules on the shared join --------------------------------------------
def _pir_matrix(t: Tables, rules, conformed: bool) -> DataFrame:
    """Which flags of the row-wise rules occur (of bags, how often) and, where
    wanted, the first and last price date and the least and greatest delivery
    time and tolerance, per (system, material). A row of the shuffle has one
    number for all that occurs; only bags need counts of their own."""
    keys, checks = {r.key for r in rules}, {r.key: ROWWISE[r.key]() for r in rules if r.key in ROWWISE}
    counted = {key for key, k in checks.items() if k.bag and not conformed}
    scope = [k.where for k in checks.values()]
    aggs = [x for key in counted for x in _count(checks[key].where, checks[key].completeness, checks[key].accuracy, key)]
    facts = {n: x for key, k in checks.items() if key not in counted for n, x in _pair_facts(k.where, k.completeness, k.accuracy, key).items()}
    active = pir.ACTIVE() & prefix_scope()
    ends = lambda c, n: [F.min(F.when(active, col(c))).alias(f"_{n}0"), F.max(F.when(active, col(c))).alias(f"_{n}1")]
    if keys & {"dq_prdat", "dq_aplfz", "dq_untto"}:
        facts["_rows"] = active
        scope.append(active)
    if "dq_prdat" in keys:
        aggs += ends("PRDAT", "p")
        facts["_none"] = active & col("PRDAT").isNull()
    if "dq_aplfz" in keys:
        aggs += ends("APLFZ", "z")
        facts["_unset"] = active & (col("APLFZ").isNull() | (col("APLFZ") == 0))
    if "dq_untto" in keys:
        aggs += ends("UNTTO", "u")
        facts["_open"] = active & col("UNTTO").isNull()
    bits, read = _facts(facts) if facts else (F.lit(0), {})
    # Every rule's scope lies within the wider one, by which both sides of the join are cut down.
    rows = t.pir.where(contains_scope() & reduce(lambda a, b: a | b, scope))
    return rows.groupBy(SS, col(MATNR).alias(GMID)).agg(F.bit_or(bits).alias("_bits"), *aggs).withColumns(read)


def _plants(t: Tables, keys) -> DataFrame:
    """What APLFZ, PRDAT and UNTTO read of a material's plants, one row for each material."""
    w = F.coalesce(col("WEBAZ"), F.lit(0))
    aggs = [F.min(w).alias("_w0"), F.max(w).alias("_w1")] if "dq_prdat" in keys else []
    if "dq_aplfz" in keys:
        aggs += [F.min("PLIFZ").alias("_l0"), F.max("PLIFZ").alias("_l1"), F.bool_or(col("BESKZ") == "F").alias("_ext")]
    if "dq_untto" in keys:
        aggs += [F.min("UNETO").alias("_m0"), F.max("UNETO").alias("_m1"), F.bool_and(col("UNETO").isNotNull()).alias("_given")]
    return t.marc.where(col(MATNR).isNotNull()).groupBy(SS, col(MATNR).alias(GMID)).agg(*aggs)


def _pir_rows(t: Tables, as_of, rules, conformed: bool, matrix: DataFrame | None = None) -> DataFrame:
    """``matrix``: in place of that of the shared join; it may have more rules (``records``)."""
    keys, labels = {r.key for r in rules}, {r.key: r.attribute if conformed else r.label for r in rules}
    df = _pir_matrix(t, rules, conformed) if matrix is None else matrix
    if keys & {"dq_prdat", "dq_aplfz", "dq_untto"}:
        df = df.join(_plants(t, keys), [SS, GMID], "left")
    rows: list[Column] = []
    for key in ROWWISE:
        if key not in keys:
            continue
        if conformed and key == "dq_effpr":
            a = F.when(col(GMID).isNotNull() & (_n(key, a=(1,)) > 0), 1).when(col(GMID).isNotNull() & (_n(key, a=(0,)) > 0), 0)
            c = F.when(_n(key, c=(1,)) > 0, 1).when(_n(key, c=(0,)) > 0, 0)
            rows.append(F.when(c.isNotNull(), _row(labels[key], c, a, F.lit(1))))
        elif conformed:
            rows.append(_worst(key, labels[key]))
        elif key == "dq_effpr":
            rows += _effpr_pairs(key, labels[key])
        else:
            rows += _pairs(key, labels[key], ROWWISE[key]().bag)
    for key in (*BY_RECORD, "dq_uebto"):
        if key in keys:
            rows += [_worst(key, labels[key])] if conformed else _pairs(key, labels[key], key == "dq_uebto")
    if "dq_prdat" in keys:
        none, dated = col("_none") > 0, col("_p0").isNotNull()
        late, fine = pir.prdat_flag(as_of, 1), pir.prdat_flag(as_of, 0)
        if conformed:
            worst = F.when(none | F.coalesce(late, F.lit(False)), 1).otherwise(0)
            rows.append(F.when(none | dated, _row(labels["dq_prdat"], none.cast("int"), worst, F.lit(1))))
        else:
            rows += [F.when(none, _row(labels["dq_prdat"], 1, 1, F.lit(1))), F.when(late, _row(labels["dq_prdat"], 0, 1, F.lit(1))),
                     F.when(fine, _row(labels["dq_prdat"], 0, 0, F.lit(1)))]
    if "dq_aplfz" in keys:                                   # worst flags only: some value of the material against some plant
        differs = (col("_l0") != col("_z1")) | (col("_l1") != col("_z0")) | (col("_l0") != col("_l1")) | (col("_z0") != col("_z1"))
        ko = (col("_z0") <= 0) | (col("_l0").isNotNull() & col("_z0").isNotNull() & differs) | (col("_ext") & (col("_z0") < 1))
        rows.append(F.when(col("_rows") > 0, _row(labels["dq_aplfz"], (col("_unset") > 0).cast("int"), F.coalesce(ko, F.lit(False)).cast("int"), F.lit(1))))
    if "dq_untto" in keys:                                   # likewise; without a plant, or with one that has no value, KO
        differs = (col("_m0") != col("_u1")) | (col("_m1") != col("_u0")) | (col("_m0") != col("_m1")) | (col("_u0") != col("_u1"))
        ko = (col("_open") > 0) | (col("_u0") < 5) | (col("_u1") > 10) | ~F.coalesce(col("_given"), F.lit(False)) | differs
        rows.append(F.when(col("_rows") > 0, _row(labels["dq_untto"], (col("_open") > 0).cast("int"), F.coalesce(ko, F.lit(False)).cast("int"), F.lit(1))))
    return _unfold(df, rows)


# -- other families ----------------------------------------------------------
def _lane_rows(t: Tables, rules, conformed: bool) -> DataFrame:
    """Rules that a lane's own values decide. Two of them take only some
    materials; these are looked up once the lanes are one row for each material."""
    facts, rows, keys = {}, [], {r.key for r in rules}
    for r in rules:
        c, a = bod.site_flags(*SITES[r.key]) if r.key in SITES else bod.end_date_flags() if r.key == "dq_effective_end_date" else bod.receiver_flags()
        facts |= _pair_facts(F.lit(True), c, a, r.key)
        own = [_worst(r.key, r.attribute)] if conformed else _pairs(r.key, r.label, False)
        rows += own if r.key in SITES else [F.when(col(f"_in_{r.key}"), x) for x in own]
    bits, read = _facts(facts)
    df = t.bod.where(kinaxis()).groupBy(SS, GMID).agg(F.bit_or(bits).alias("_bits")).withColumns(read)
    if "dq_effective_end_date" in keys:
        df = df.join(bod.relevant_parts(t).withColumn("_in_dq_effective_end_date", F.lit(True)), GMID, "left")
    if "dq_to_gmid" in keys:
        df = df.withColumn("_key", bod.receiver_key()).join(bod.active_receivers(t).withColumn("_in_dq_to_gmid", F.lit(True)), "_key", "left")
    return _unfold(df, rows)


def _conversion_rows(t: Tables, rules, conformed: bool) -> DataFrame:
    """R21 and R22 have the same flags; they differ in name."""
    worst = material.conversion_checks(t).groupBy(SS, col(MATNR).alias(GMID)).agg(F.max("_C").alias("_c"), F.max("_A").alias("_a"))
    return _unfold(worst, [_row(r.attribute if conformed else r.label, col("_c"), col("_a"), F.lit(1)) for r in rules])


def _record_rows(t: Tables, rules, conformed: bool) -> DataFrame:
    """R05 and R19 find the material by the info record alone: one reading of
    EINE and one join for both."""
    facts = _pair_facts(F.lit(True), *pir.uebtk_flags(), "dq_uebtk") | _pair_facts(prefix_scope(), *pir.bstae_flags(), "dq_bstae")
    bits, read = _facts(facts)
    found = pir.material_of(t, pir.with_vendor(t, t.eine), bits.alias("_f"))
    df = found.groupBy(SS, col(MATNR).alias(GMID)).agg(F.bit_or("_f").alias("_bits")).withColumns(read)
    return _unfold(df, [x for r in rules for x in ([_worst(r.key, r.attribute)] if conformed else _pairs(r.key, r.label, False))])


def families(rules, conformed: bool) -> tuple[list[tuple], list]:
    """(families, the rest): each family a function and two or more of its rules."""
    joint = (*PIR_FAMILY, "dq_untto") if conformed else tuple(k for k in PIR_FAMILY if k != "dq_aplfz")
    out, left = [], [r for r in rules if r.attribute not in OK_IS_ONE]
    rest = [r for r in rules if r.attribute in OK_IS_ONE]
    for build, keys in ((_pir_rows, joint), (_lane_rows, LANES), (_conversion_rows, CONVERSION), (_record_rows, BY_RECORD)):
        own = [r for r in left if r.key in keys]
        if len(own) > 1:
            out.append((build, own))
            left = [r for r in left if r not in own]
    return out, left + rest


def _shaped(df: DataFrame) -> DataFrame:
    return df.select(col(SS).cast("string").alias(SS), col(GMID).cast("string").alias(GMID), "ATTRIBUTE", "COMPLETENESS", "ACCURACY", "_n")


def pir_rows(t: Tables, as_of, rules, conformed: bool, matrix: DataFrame) -> DataFrame:
    """The rows of ``rules`` by what ``matrix`` says of each material."""
    return _shaped(_pir_rows(t, as_of, rules, conformed, matrix))


def _rows(t: Tables, as_of, rules, conformed: bool, counted: bool = False) -> tuple[list[DataFrame], list]:
    (found, rest), out = families(rules, conformed), []
    for f, own in found:
        df = f(t, as_of, own, conformed) if f is _pir_rows else f(t, own, conformed)
        df = _shaped(df)
        out.append(df if counted else expand_copies(df, "_n") if f is _pir_rows and not conformed else df.drop("_n"))
    return out, rest


def suite_rows(t: Tables, as_of, rules, counted: bool = False) -> tuple[list[DataFrame], list]:
    """(rows of the families among ``rules``, the rules that are in none);
    ``counted``: each different row once, with its count in column _n."""
    return _rows(t, as_of, rules, False, counted)


def conformed_rows(t: Tables, as_of, rules) -> tuple[list[DataFrame], list]:
    """As ``suite_rows``, one row of worst flags (1 = KO) per key and attribute."""
    return _rows(t, as_of, rules, True)
