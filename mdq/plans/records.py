"""The rules on info records over one join of EINE and EINA.

Fourteen rules bring EINE and EINA together by info record: nine by record and
system (``views.pir``), three by the record alone, UEBTO and UNTTO with the
active general data of the same system. ``records`` shuffles both tables once,
by the record, and gives for each record, system, material, plant and value
which flags occur (bits of one number) or how often. The query writes these
rows and every rule goes on from them to its materials (``record_parts``). The
conformed view, where only the worst flags count, takes the rows on without
writing them: one shuffle by material, by which MINBM finds its plant data,
carries all bits, and what is written is one row for each material. The four
rules on EINA's units share one shuffle by the material.

What goes through these shuffles is cut to what the flags ask: values that only
systems in scope need are NULL elsewhere, numbers that are only compared
with fixed ones go as any value that answers alike, and short texts go together
as one (``functions.texts``).

An EINE row without partner in its own system counts for the rules by record
and system with a NULL material, whatever other systems have: it gets such a row
beside those of the other systems.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdq.functions import is_blank
from mdq.functions.scope import active_pir, contains_scope, prefix_scope
from mdq.functions.texts import packed, unpacked
from mdq.operators import material, pir
from mdq.operators.joins import left_join, spread_join
from mdq.plans import fused
from mdq.session import parts_by_size, write_shared
from mdq.sources.tables import Tables

col = F.col
SS, INFNR, MATNR = "SOURCE_SYSTEM", "INFNR", "MATNR"
BAGS = ("dq_bpumn", "dq_bpumz", "dq_uebto")
#: The rules that take systems outside the prefix scope, too.
ANY_SYSTEM = ("dq_uebtk_", "dq_mhdrz_eine_")
#: Of the bits of the conformed view, those that any system asks for; the shelf life takes systems that contain the name.
ALL_SYSTEMS = ("dq_uebtk_", "dq_minbm_", "_any")
#: Bits of the price units in the conformed view, in an order by which two of them are moved at once.
PRICE_UNITS = ("_same_n", "_same_z", "dq_bpumn_10", "dq_bpumz_10", "dq_bpumn_01", "dq_bpumz_01", "_other_n", "_other_z", "dq_bpumn_00", "dq_bpumz_00")
#: The rules of the shared join whose flags EINE's row alone decides.
OWN = tuple(k for k in fused.ROWWISE if k not in BAGS)
MATRIX = (*fused.ROWWISE, "dq_prdat", *fused.BY_RECORD, "dq_uebto")
RULES = (*MATRIX, "dq_aplfz", "dq_untto", "dq_minbm")
UNITS = ("dq_lmein", "dq_meins", *fused.CONVERSION)
#: From so many purchasing organisations on, their rows are dealt and not broadcast.
MANY_ORGS = 10_000


def _pairs(key: str, c: Column, a: Column, worst: bool = False) -> dict[str, Column]:
    """A condition for each pair of flags; accuracy 2 (NULL) only where it can occur.
    ``worst``: where only the worst flags count, fewer conditions that have the
    same ones: some row, a KO completeness, a KO accuracy."""
    if worst and key != "dq_effpr":
        return {f"{key}_10": c == 1, f"{key}_01": a == 1, f"{key}_00": F.lit(True)}
    found = fused._pair_facts(F.lit(True), c, a, key)
    return found if key == "dq_effpr" else {n: x for n, x in found.items() if not n.endswith("2")}


def _with_vendors(t: Tables, eine: DataFrame) -> DataFrame:
    """``eine`` with the different confirmation keys (_keys) of the purchasing
    organisation's vendors and whether one has none (_blank); one row each."""
    found = t.lfm2.where(col("EKORG").isNotNull()).groupBy("EKORG").agg(F.collect_set("BSTAE").alias("_keys"), F.bool_or(col("BSTAE").isNull()).alias("_blank"))
    found = write_shared(found, "mdq-vendors")
    if found.count() <= MANY_ORGS:
        return eine.join(F.broadcast(found), "EKORG", "left")
    parts = F.explode(F.sequence(F.lit(0), F.lit(pir.SPREAD - 1)))
    dealt = eine.withColumn("_part", F.pmod(F.xxhash64(INFNR, SS), F.lit(pir.SPREAD)).cast("int"))
    return left_join(dealt, found.withColumn("_part", parts), ["EKORG", "_part"])


def _eine_facts(conformed: bool) -> dict[str, Column]:
    """What EINE's row says by itself, without the scope of any rule."""
    out: dict[str, Column] = {}
    for key in OWN:
        k = fused.ROWWISE[key]()
        out |= _pairs(key, k.completeness, k.accuracy, conformed)
    out |= _pairs("dq_uebto", *pir.uebto_flags(), conformed) | _pairs("dq_uebtk", *pir.uebtk_flags(), conformed)
    own, keys = col("BSTAE"), col("_keys")
    # The lambda also keeps all these conditions out of the one method of their stage, which would be too long for the JVM to compile (8,000 bytes).
    other = F.coalesce(F.exists(keys, lambda x: x != own), F.lit(False))
    agrees = keys.isNull() | col("_blank") | F.array_contains(keys, own)
    if conformed:
        out |= _pairs("dq_bstae", own.isNull().cast("int"), (own.isNull() | other).cast("int"), True)
    else:
        out |= {"dq_bstae_00": own.isNotNull() & agrees, "dq_bstae_01": own.isNotNull() & other,
                "dq_bstae_10": F.lit(False), "dq_bstae_11": own.isNull()}
    n, z = col("BPUMN"), col("BPUMZ")
    out |= {"_none": col("PRDAT").isNull(), "_unset": col("APLFZ").isNull() | (col("APLFZ") == 0), "_open": col("UNTTO").isNull()}
    out |= {"_n_given": n.isNotNull(), "_n_1": n == 1, "_z_given": z.isNotNull(), "_z_1": z == 1, "_z_0": z == 0, "_z_low": z < 0}
    always = {"_rows": F.lit(True), "_any": F.lit(True)} if conformed else {}
    # What says the same of every row stands last, so that the bits that differ are in few bytes.
    return {n: (out | always)[n] for n in sorted(out | always, key=lambda n: n in always or (conformed and n.endswith("_00") and n != "dq_effpr_00"))}


def _late_facts(said) -> dict[str, Column]:
    """The rest of what EINE's row says by itself in the conformed view, of the
    values that are shuffled: MINBM without the plant, the price units whatever
    EINA's unit is, and what is wrong if that is the same (_same) or another one."""
    n, z, blank = said("_n_given"), said("_z_given"), is_blank("BPRME")
    n_1, z_1 = said("_n_1"), said("_z_1")
    units = {"_same_n": n & (~n_1 | (z & ~z_1)), "_same_z": z & ~z_1, "dq_bpumn_10": n & (blank | ~z), "dq_bpumz_10": z & blank, "dq_bpumn_01": n & said("_z_0"),
             "dq_bpumz_01": said("_z_0") | said("_z_low"), "_other_n": n_1 & z_1, "_other_z": n_1 & z_1, "dq_bpumn_00": n, "dq_bpumz_00": z}
    units = {k: said("_rows") & units[k] for k in PRICE_UNITS}
    return {"dq_minbm_10": col("MINBM").isNull(), "dq_minbm_01": ~F.coalesce(pir.minbm_sound(), F.lit(False)), "dq_minbm_00": F.lit(True), **units}


def _number(facts: dict[str, Column], names: list[str]) -> Column:
    """The conditions as bits, each at its name's place."""
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(c, F.lit(1 << names.index(k)).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for k, c in facts.items()])


def _mask(names: list[str], start: tuple[str, ...]) -> Column:
    return F.lit(sum(1 << i for i, n in enumerate(names) if n.startswith(start))).cast("bigint")


def _general(t: Tables, n: int, conformed: bool) -> DataFrame:
    """EINA's rows by record, each with the systems that have rows (_sys), active
    rows (_act) of the record, and how many active rows its own system has (_k)."""
    loekz = F.when(col("LOEKZ") != "", "X").otherwise(col("LOEKZ"))      # the rules ask whether it is NULL or empty
    rows = t.eina.where(col(INFNR).isNotNull()).select(MATNR, INFNR, packed(loekz, F.when(prefix_scope(), col("MEINS")), SS).alias("_t"))
    # One shuffle for both windows and the join, which the windows' own keys would not give.
    rows, active = rows.repartition(*([n] if n else []), INFNR), col("EINA_LOEKZ").isNull()
    rows = rows.select(INFNR, MATNR, *[c.alias(k) for k, c in unpacked("_t", EINA_LOEKZ="string", MEINS="string", _sys_a="string").items()], F.lit(True).alias("_found"))
    if conformed:
        # The rows of a material as one before they meet EINE's: bits (1: some active row, 2: one that price units count, 4: such a one without unit) and the units of these.
        counts, unit = active | (col("EINA_LOEKZ") == ""), F.trim("MEINS")
        state = F.when(active, 1).otherwise(0) + F.when(counts, 2).otherwise(0) + F.when(counts & is_blank("MEINS"), 4).otherwise(0)
        rows = (rows.groupBy(INFNR, MATNR, "_sys_a").agg(F.bit_or(state.cast("int")).alias("_state"), F.collect_set(F.when(counts, unit)).alias("_units"))
                .withColumn("_found", F.lit(True)))
        active = col("_state").bitwiseAND(F.lit(1)) != 0
    by = Window.partitionBy(INFNR).orderBy(INFNR)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if not conformed:
        rows = rows.withColumn("_k", F.count_if(active).over(Window.partitionBy(INFNR, "_sys_a")))
    return rows.withColumns({"_sys": F.collect_set("_sys_a").over(whole), "_act": F.collect_set(F.when(active, col("_sys_a"))).over(whole),
                             "_first": F.row_number().over(by) == 1})


def records(t: Tables, conformed: bool) -> tuple[DataFrame, list[str]]:
    """(the rows, the names of the bits of their number _b)."""
    facts = _eine_facts(conformed)
    said = lambda n: col("_e").bitwiseAND(F.lit(1 << names.index(n)).cast("bigint")) != 0
    names = [*facts]
    names += [*_late_facts(lambda n: F.lit(True))] if conformed else ["_rows", "_any"]
    n = max(parts_by_size(t.eine), parts_by_size(t.eina))
    bits = _number(facts, names)
    if conformed:
        wide, any_system = _mask(names, ("dq_uebtk_", "_any", "dq_mhdrz_eine_")), _mask(names, ("dq_uebtk_", "_any"))
        bits = bits.bitwiseAND(F.when(prefix_scope(), F.lit(-1).cast("bigint")).when(contains_scope(), wide).otherwise(any_system))
    else:
        bits = F.when(prefix_scope(), bits).otherwise(bits.bitwiseAND(_mask(names, ANY_SYSTEM)))
    in_scope = lambda c: F.when(prefix_scope(), col(c))
    texts = packed("WERKS", in_scope("BPRME"), SS, in_scope("APLFZ"), in_scope("UNTTO")).alias("_texts")
    eine = _with_vendors(t, t.eine).select(INFNR, texts, bits.alias("_e"), in_scope("PRDAT").alias("PRDAT"), "MINBM")
    types = {c: t.eine.schema[c].dataType for c in ("WERKS", "BPRME", SS, "APLFZ", "UNTTO")}
    read = lambda df: df.withColumns(unpacked("_texts", **types)).drop("_texts")
    general, whole = _general(t, n, conformed), eine.where(col(INFNR).isNotNull())
    whole, past = whole.repartition(*([n] if n else []), INFNR), eine.where(col(INFNR).isNull())
    if conformed:
        sound, late = F.coalesce(pir.minbm_sound(), F.lit(False)), _number(_late_facts(said), names)
        read_short = read
        read = lambda df: read_short(df).withColumns({"_e": col("_e").bitwiseOR(late), "MINBM": F.when(sound, col("MINBM")), "_unit": F.trim("BPRME")}).drop("BPRME")
        past = past.drop(INFNR).distinct().withColumn(INFNR, F.lit(None).cast(t.eine.schema[INFNR].dataType))
    # Read back before the join, which repeats rows.
    joined = read(whole).join(general, INFNR, "left")
    past = read(past).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in general.schema if f.name != INFNR])
    if conformed:
        return _worst_bits(joined, names).unionByName(_worst_bits(past, names)), names
    return _flags(joined, names, True).unionByName(_flags(past, names, False)), names


def _worst_bits(df: DataFrame, names: list[str]) -> DataFrame:
    """The rows of the conformed view: which of the bits of an EINE row count for
    the material beside it (_b), and its values where they do. All that the row
    says by itself is in its bits, so that little is left to do for each pair."""
    at = {n: i for i, n in enumerate(names)}
    bits = lambda *keys: _mask(names, keys)
    none = F.lit(0).cast("bigint")
    both = lambda x, *more: reduce(lambda a, b: a.bitwiseOR(b), more, x)
    has = lambda c: F.coalesce(F.array_contains(col(c), col(SS)), F.lit(False))
    state, same = (lambda b: col("_state").bitwiseAND(F.lit(b)) != 0), F.coalesce(col("_sys_a") == col(SS), F.lit(False))
    ever, own, tol = ("dq_bstae_", *ALL_SYSTEMS), ("dq_netpr_", "dq_peinh_"), ("dq_uebto_",)
    active = ("dq_effpr_", "dq_meprf_", "dq_mhdrz_eine_", "dq_netpr_", "_none", "_unset", "_open", "_rows", *tol)
    here = F.when(col("_found").isNull(), bits(*ever, *own, *tol)).when(~same, bits(*ever)).otherwise(both(
        bits(*ever, "dq_peinh_"), F.when(state(1), bits(*active)).otherwise(none), F.when(state(2), bits("dq_bpumn_", "dq_bpumz_")).otherwise(none)))
    past = both(F.when(has("_sys"), none).otherwise(bits(*own)), F.when(has("_act"), none).otherwise(bits(*tol)))
    # A row that no partner of its own system answers counts once more, without a material.
    df = df.withColumn("_m", F.explode(F.when(col("_first") & (past != 0), F.array(here, past)).otherwise(F.array(here))))
    e, m, unit, with_ = col("_e"), col("_m"), col("_unit"), lambda n: col("_m").bitwiseAND(_mask(names, (n,))) != 0
    other = (F.size("_units") > 1) | (F.get("_units", F.lit(0)) != unit)
    moved = lambda start, to: F.shiftleft(e.bitwiseAND(bits(*start)), at[to] - at[start[0]]) if at[to] > at[start[0]] else F.shiftright(e.bitwiseAND(bits(*start)), at[start[0]] - at[to])
    wrong = both(F.when(state(4), moved(("dq_bpumn_00", "dq_bpumz_00"), "dq_bpumn_10")).otherwise(none),
                 F.when(F.array_contains("_units", unit), moved(("_same_n", "_same_z"), "dq_bpumn_01")).otherwise(none),
                 F.when(unit.isNotNull() & other, moved(("_other_n", "_other_z"), "dq_bpumn_01")).otherwise(none))
    b = both(e.bitwiseAND(m), F.when(with_("dq_bpumn_00"), wrong).otherwise(none))
    on = lambda c, n: F.when(with_(n), col(c))
    return df.select(SS, on(MATNR, "_any").alias(MATNR), on("WERKS", "_any").alias("WERKS"), on("MINBM", "_any").alias("MINBM"), b.alias("_b"),
                     on("PRDAT", "_rows").alias("_p0"), on("APLFZ", "_rows").alias("_z0"), on("UNTTO", "_rows").alias("_u0")).where("_b <> 0")


def _ends(c: Column, s: str) -> list[Column]:
    """The least (_<s>0) and greatest value (_<s>1; NULL if they are the same)."""
    return [F.min(c).alias(f"_{s}0"), F.nullif(F.max(c), F.min(c)).alias(f"_{s}1")]


def _flags(df: DataFrame, names: list[str], by_record: bool) -> DataFrame:
    """The rows of the suite, with counts."""
    has = lambda c: F.coalesce(F.array_contains(col(c), col(SS)), F.lit(False))
    alone = col("_found") & col("_first") & ~(has("_sys") & has("_act"))
    df = df.withColumn("_x", F.explode(F.when(alone, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    found, same = F.coalesce(col("_found"), F.lit(False)), F.coalesce(col("_sys_a") == col(SS), F.lit(False))
    df = df.withColumns({"_own": F.when(col("_x"), ~has("_sys")).otherwise(~found | same),
                         "_tol": F.when(col("_x"), ~has("_act")).otherwise(~found | (same & col("EINA_LOEKZ").isNull())),
                         "_HAS_EINA": ~col("_x") & same})
    df = df.withColumns({c: F.when(~col("_x"), col(c)) for c in (MATNR, "EINA_LOEKZ", "MEINS")})
    said = lambda n: col("_e").bitwiseAND(F.lit(1 << names.index(n)).cast("bigint")) != 0
    # The rules on price units ask whether the factors are given, 1, 0 or below: any value that answers alike will do.
    df = df.withColumns({"BPUMN": F.when(said("_n_given"), F.when(said("_n_1"), 1).otherwise(2)),
                         "BPUMZ": F.when(said("_z_given"), F.when(said("_z_1"), 1).when(said("_z_0"), 0).when(said("_z_low"), -1).otherwise(2))})
    yes = lambda c: F.coalesce(c, F.lit(False))
    active = yes(col("_own") & pir.ACTIVE() & prefix_scope())
    df = df.withColumns({"_active": active, "_in_tol": yes(col("_tol") & prefix_scope())})
    part = lambda cond, *keys: F.when(cond, col("_e").bitwiseAND(_mask(names, keys))).otherwise(F.lit(0).cast("bigint"))
    bit = lambda n: F.lit(1 << names.index(n)).cast("bigint")
    marks = [part(yes(col("_own") & fused.ROWWISE[k]().where), f"{k}_") for k in OWN]
    marks += [part(col("_active"), "_none", "_unset", "_open"), part(col("_in_tol"), "dq_uebto_"), part(~col("_x") & yes(prefix_scope()), "dq_bstae_"),
             part(~col("_x"), "dq_uebtk_"), F.when(col("_active"), bit("_rows")).otherwise(F.lit(0).cast("bigint")),
             F.when(col("_x"), F.lit(0).cast("bigint")).otherwise(bit("_any"))]
    counts = {}
    for key in ("dq_bpumn", "dq_bpumz"):
        k = fused.ROWWISE[key]()
        counts |= {name: yes(col("_own") & k.where & c) for name, c in _pairs(key, k.completeness, k.accuracy).items()}
    counts |= {n: col("_in_tol") & (col("_e").bitwiseAND(bit(n)) != 0) for n in names if n.startswith("dq_uebto_")}
    on = lambda c: F.when(col("_active"), col(c))
    keys = [col(SS), col(MATNR)] + [F.when(~col("_x"), col(c)).alias(c) for c in ("WERKS", "MINBM")]
    aggs = [F.bit_or(reduce(lambda x, y: x.bitwiseOR(y), marks)).alias("_b")] + [F.count_if(c).alias(name) for name, c in counts.items()]
    keys += [on("APLFZ").alias("APLFZ"), on("UNTTO").alias("UNTTO")]
    aggs += [*_ends(on("PRDAT"), "p"), F.sum(on("_k")).alias("_u")]
    return df.groupBy(*([col(INFNR)] if by_record else []), *keys).agg(*aggs).drop(INFNR)


def _matrix(rows: DataFrame, names: list[str], conformed: bool) -> DataFrame:
    """What the rows of a material say together, with the columns that ``fused`` reads."""
    counts = [c for c in rows.columns if c.startswith("dq_")]
    aggs = [F.bit_or("_b").alias("_b"), *[F.sum(c).alias(c) for c in counts], F.min("_p0").alias("_p0")]
    if conformed:                                            # of price dates it asks for the first alone
        aggs += [f(f"_{s}0").alias(f"_{s}{i}") for s in ("z", "u") for i, f in enumerate((F.min, F.max))]
    else:
        aggs.append(F.max(F.coalesce("_p1", "_p0")).alias("_p1"))
    read = {n: F.shiftright("_b", i).bitwiseAND(F.lit(1).cast("bigint")) for i, n in enumerate(names) if n not in counts}
    flags = [f"{k}_{i}{j}" for k in (*fused.ROWWISE, *fused.BY_RECORD, "dq_uebto", "dq_minbm") for i in (0, 1) for j in (0, 1, 2)]
    never = {n: F.lit(0).cast("bigint") for n in flags if n not in names and n not in counts}
    return rows.groupBy(SS, col(MATNR).alias("GMID")).agg(*aggs).withColumns(read | never)


def _with_minbm(t: Tables, rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the flags of MINBM among their bits, by one shuffle by the
    material, to all plants of it with their different rounding values."""
    plants = t.marc.where(col(MATNR).isNotNull() & col("WERKS").isNotNull()).groupBy(MATNR).agg(F.collect_set(F.struct("WERKS", "BSTRF")).alias("_plants"))
    short = (SS, "WERKS", "_z0", "_u0")
    df = spread_join(rows.select(MATNR, packed(*short).alias("_texts"), "_b", "_p0", "MINBM"), plants, [MATNR], keep=True)
    df = df.withColumns(unpacked("_texts", **{c: rows.schema[c].dataType for c in short}))
    # Right if the plant is there and with each of its values; of rows that are wrong or asked for nothing the quantity is NULL.
    at, fine = (lambda p: p["WERKS"] == col("WERKS")), lambda p: pir.minbm_flags(p["BSTRF"])[1] == 0
    right = F.exists("_plants", lambda p: at(p) & fine(p)) & ~F.exists("_plants", lambda p: at(p) & ~fine(p))
    wrong = F.when(col("MINBM").isNotNull() & ~F.coalesce(right, F.lit(False)), F.lit(1 << names.index("dq_minbm_01")).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return df.withColumn("_b", col("_b").bitwiseOR(wrong)).drop("_texts", "_plants", "WERKS", "MINBM", "_spread")


def _unit_rows(t: Tables, rules, conformed: bool) -> DataFrame:
    """LMEIN, MEINS, UMREN and UMREZ: one shuffle of EINA, by the material, to
    MARA's different rows and MARM's units of it. Rows without a material, which
    find nothing, go past."""
    mara = (t.mara.where(col(MATNR).isNotNull()).groupBy(MATNR, col(SS).alias("_sys_m"), col("MEINS").alias("_BASE"))
            .agg(F.bool_or(col("LVORM").isNull()).alias("_kept")))
    marm = t.marm.where(col(MATNR).isNotNull()).groupBy(MATNR).agg(F.collect_set("MEINH").alias("_units"))
    counted = F.coalesce(contains_scope() & active_pir(), F.lit(False))
    eina = t.eina.select(MATNR, packed(material.ratio_kind(), counted.cast("int"), "LMEIN", "MEINS", SS).alias("_texts"))
    df = left_join(eina, mara.join(marm, MATNR, "full"), [MATNR])
    df = df.withColumns(unpacked("_texts", _ratio="int", _in="int", LMEIN="string", MEINS="string", **{SS: "string"})).withColumns(material.ratio_of("_ratio"))
    names, facts = {r.key for r in rules}, {}
    if "dq_lmein" in names:
        facts |= _pairs("dq_lmein", *material.lmein_flags())
    if "dq_meins" in names:
        facts |= _pairs("dq_meins", *material.meins_flags(F.array_contains("_units", col("MEINS"))))
    c, a = material.conversion_flags(col("LMEIN"), col("_BASE"))
    own = F.coalesce((col("_in") == 1) & col("_kept") & (col("_sys_m") == col(SS)), F.lit(False))
    facts |= {"_conv": own, "_conv_c": own & (c == 1), "_conv_a": own & (a == 1)}
    bits, read = fused._facts(facts)
    never = {f"{k}_{i}2": F.lit(0).cast("bigint") for k in ("dq_lmein", "dq_meins") for i in (0, 1)}
    df = df.groupBy(SS, col(MATNR).alias("GMID")).agg(F.bit_or(bits).alias("_bits")).withColumns(read | never)
    rows = []
    for r in rules:
        label, flip = (r.attribute if conformed else r.label), [col("_conv_c"), col("_conv_a")]
        if r.key in fused.CONVERSION:
            rows.append(F.when(col("_conv") > 0, fused._row(label, *flip, F.lit(1))))
        else:
            rows += [fused._worst(r.key, label)] if conformed else fused._pairs(r.key, label, False)
    return fused._shaped(fused._unfold(df, rows))


def record_parts(t: Tables, as_of, rules, conformed: bool, worst=None) -> tuple[list[DataFrame], list]:
    """(a frame for each step from the written records to materials, the rules
    that do not read them). Frames of the bag have column _n; conformed ones do
    not, ``worst`` (frame, rule) makes them of a rule's rows. For several dates
    (conformed only) PRDAT is a frame of its own, with its flags at each."""
    units = [r for r in rules if r.key in UNITS]
    parts = [_unit_rows(t, units, conformed)] if units else []
    parts = [df.drop("_n") for df in parts] if conformed else parts
    own = {r.key: r for r in rules if r.key in RULES}
    left = [r for r in rules if r.key not in RULES and r.key not in UNITS]
    if not own:
        return parts, left
    rows, names = records(t, conformed)
    holds = lambda n: col("_b").bitwiseAND(F.lit(1 << names.index(n)).cast("bigint")) != 0
    if conformed:
        matrix = write_shared(_matrix(_with_minbm(t, rows, names) if "dq_minbm" in own else rows, names, True), "mdq-materials")
    else:
        rows = write_shared(rows, "mdq-records")
        matrix = _matrix(rows, names, False)
    at_dates = ("dq_prdat",) if isinstance(as_of, (list, tuple)) else ()
    joint = [r for k, r in own.items() if (k in MATRIX or (conformed and k in ("dq_aplfz", "dq_untto"))) and k not in at_dates]
    parts += [worst(pir.prdat_worst(t, matrix.withColumn("_none", col("_none") > 0), as_of), own[k]) for k in at_dates if k in own]
    if joint:
        df = fused.pir_rows(t, as_of, joint, conformed, matrix)
        parts.append(df.drop("_n") if conformed else df)
    once = F.lit(1).cast("bigint")
    if "dq_minbm" in own and conformed:
        flags = matrix.select(SS, col("GMID").alias(MATNR), fused._worst("dq_minbm", "MINBM").alias("r")).where("r is not null")
        parts.append(worst(pir.minbm_rows(t, flags.select(SS, MATNR, col("r.COMPLETENESS").alias("_C"), col("r.ACCURACY").alias("_A"))), own["dq_minbm"]))
    elif "dq_minbm" in own:
        parts.append(pir.minbm_of(t, rows.where(holds("_any")).select(SS, MATNR, "WERKS", "MINBM")).withColumn("_n", once))
    if "dq_aplfz" in own and not conformed:
        parts.append(pir.aplfz_of(t, rows.where(holds("_rows")).select(SS, MATNR, "APLFZ").distinct()).withColumn("_n", once))
    if "dq_untto" in own and not conformed:
        pairs = rows.where(holds("_rows")).groupBy(SS, col(MATNR).alias("GMID"), "UNTTO").agg(F.sum("_u").alias("_n"))
        parts.append(pir.untto_of(t, pairs))
    return parts, left
