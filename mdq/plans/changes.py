"""X2 and X3 by changed keys: the conformed view of a day from the day before.

``ChangeStore.run`` gives what ``conformed_suite`` gives, but evaluates only
the materials that a change can have reached:

1. Each source has an index of its rows: for each value of the column by which
   its rows reach a material, how many rows there are, and the sum and the
   exclusive or of two hashes of the whole rows (NULLs are part of a hash). Two
   days' indexes tell the changed values, whatever kind of change it was.
2. If the date moved, rows on which a dated rule's condition turned between the
   two dates count as changed (``turned``).
3. The changed values are carried through the joins of the rules to the
   materials they reach. The tables of today suffice for it: where a joined row
   went away, that row is a change itself and has its own way to its material.
4. Each family of rules runs over its sources cut down to what the materials
   reached read. Rows of other materials come along with joined rows; what they
   give is dropped, and the earlier snapshot's rows of the family's other
   materials stay.

A result without a material (NULL) is one key for each system, made of all rows
that find no partner. A change of a joined source may touch it, so it is
evaluated anew, from the rows that may have no partner, whenever one did.

A run writes index, changed keys, reached materials and snapshot to a folder of
its own and commits a manifest; a run that breaks off leaves nothing that counts.
Another list of rules, or another ``version`` (to be given with changed rules),
evaluates everything.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.functions.scope import active_pir
from mdq.plans.catalog import enabled_rules
from mdq.plans.conform import conformed_suite
from mdq.plans.manifest import Manifest
from mdq.sources.tables import TABLE_NAMES, Tables

col = F.col
SS, INFNR, MATNR = "SOURCE_SYSTEM", "INFNR", "MATNR"
GMID = "GMID"
SNAPSHOT = "SOURCE_SYSTEM string, GMID string, ATTRIBUTE string, COMPLETENESS int, ACCURACY int"
INDEX = "TABLE_NAME string, KEY string, N bigint, S decimal(38,0), X bigint"
CHANGED = "TABLE_NAME string, KEY string"

#: The column by which the rows of a source reach a material.
KEY_COLUMN = {"eine": INFNR, "eina": MATNR, "marc": MATNR, "mara": MATNR, "marm": MATNR, "eord": MATNR, "lfm2": "EKORG",
              "kako": "KAPID", "crca": "KAPID", "pp_tabs": "MARA_MATNR", "crhd": "WERKS", "bod": GMID, "part_dim": GMID,
              "material": "GMID_CODE", "demand": GMID, "forecast": GMID}


# -- what changed ------------------------------------------------------------
def row_index(df: DataFrame, name: str) -> DataFrame:
    """A row for each key of a source: how many rows, and two digests of them
    that do not depend on their order. Repeated rows count; a value that moves
    to another column, or from NULL to an empty text, is a change. Hot keys are
    combined before the shuffle."""
    cells = [x for c in df.columns for x in (col(c).isNull(), col(c))]
    rows = df.select(col(KEY_COLUMN[name]).cast("string").alias("KEY"), F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(name), *cells).alias("g"))
    return (rows.groupBy("KEY").agg(F.count("*").alias("N"), F.sum(col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("S"), F.bit_xor("g").alias("X"))
            .select(F.lit(name).alias("TABLE_NAME"), "KEY", "N", "S", "X"))


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """TABLE_NAME and KEY of the keys whose rows are not the same in both indexes."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, (col("o.TABLE_NAME") == col("n.TABLE_NAME")) & col("o.KEY").eqNullSafe(col("n.KEY")), "full")
    same = reduce(lambda a, b: a & b, [col(f"o.{c}").eqNullSafe(col(f"n.{c}")) for c in ("N", "S", "X")])
    return j.where(~same).select(F.coalesce("o.TABLE_NAME", "n.TABLE_NAME").alias("TABLE_NAME"), F.coalesce("o.KEY", "n.KEY").alias("KEY"))


def turned(t: Tables, before: str, as_of: str) -> DataFrame | None:
    """Keys (as ``changed_keys``) of rows on which a condition of a dated rule
    is not the same at both dates; None where the dates are equal."""
    if before == as_of:
        return None
    lo, hi = (F.lit(d).cast("date") for d in sorted((before, as_of)))
    from_lo = lambda c, f: (c >= f(lo)) & (c < f(hi))  # noqa: E731  turns conditions c < f(date)
    past_lo = lambda c, f: (c > f(lo)) & (c <= f(hi))  # noqa: E731  turns conditions c <= f(date)
    same = lambda d: d
    # Price dates are held against as-of + 5 + a plant's days: between the least and the most days of any plant.
    least, most = t.marc.select((F.lit(5) + F.coalesce(col("WEBAZ"), F.lit(0))).cast("int").alias("d")).agg(
        F.least(F.min("d"), F.lit(5)), F.greatest(F.max("d"), F.lit(5))).first()
    prices = t.eine.where((col("PRDAT") > F.date_add(lo, least)) & (col("PRDAT") <= F.date_add(hi, most)))
    end, start = col("EFFECTIVE_OUT_DATE"), col("EFFECTIVE_IN_DATE")
    rows = {"eine": prices,
            "eord": t.eord.where(from_lo(col("BDATU"), same) | from_lo(col("BDATU"), lambda d: F.date_sub(d, 365))),
            "bod": t.bod.where(from_lo(end, same) | past_lo(start, same) | past_lo(start, lambda d: F.add_months(d, 36))),
            "forecast": t.forecast.where(past_lo(col("FORECAST_DATE"), same))}
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("TABLE_NAME"), col(KEY_COLUMN[n]).cast("string").alias("KEY")) for n, df in rows.items()])


# -- from changed keys to materials, and back to rows -------------------------
def _of(changed: DataFrame, *names: str) -> DataFrame:
    return changed.where(col("TABLE_NAME").isin(*names)).select(col("KEY").alias("_k"))


def _materials(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [p.select(p.columns[0]) for p in parts]).toDF(GMID).distinct()


def _reached(df: DataFrame, key, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose value ``key`` is among the (one) column of ``keys``; NULL is a value."""
    k = keys.toDF("_k")
    return df.join(k, (col(key) if isinstance(key, str) else key).eqNullSafe(col("_k")), "left_semi")


def _none_if_any(changed: DataFrame, *names: str) -> DataFrame:
    """The material NULL, if one of these sources has a change."""
    return changed.where(col("TABLE_NAME").isin(*names)).limit(1).select(F.lit(None).cast("string").alias("_k"))


def _purchasing(t: Tables, changed: DataFrame) -> DataFrame:
    orgs = _reached(t.eine.where("EKORG is not null"), "EKORG", _of(changed, "lfm2")).select(INFNR)
    records = _of(changed, "eine").union(orgs).distinct()
    return _materials(_of(changed, "eina", "marc", "mara", "marm", "eord"), _reached(t.eina.where("INFNR is not null"), INFNR, records).select(MATNR),
                      _none_if_any(changed, "eine", "eina", "marc", "mara", "lfm2"))


def _purchasing_rows(t: Tables, m: DataFrame, with_null: bool) -> dict[str, DataFrame]:
    """Info records of the materials, with all their rows, and what is joined to these."""
    own = _reached(t.eina, MATNR, m)
    records = own.where("INFNR is not null").select(INFNR).distinct()
    eine = _reached(t.eine, INFNR, records)
    if with_null:
        # A record without partner, or with one that a rule may not take, may give a result without a material.
        known = t.mara.where("MATNR is not null").select(col(MATNR).alias("_m")).distinct().withColumn("_known", F.lit(True))
        eina = t.eina.where("INFNR is not null").join(known, col(MATNR) == col("_m"), "left").withColumn("_solid", active_pir() & col("_known").isNotNull())
        by_record = eina.groupBy(INFNR).agg(F.bool_and("_solid").alias("_all")).where(~col("_all")).select(INFNR)
        solid = eina.where("_solid").select(INFNR, SS).distinct()
        rest = t.eine.join(records, INFNR, "left_anti")
        unsure = rest.join(by_record, INFNR, "left_semi")
        alone = rest.join(by_record, INFNR, "left_anti").join(solid, [INFNR, SS], "left_anti")
        eine = eine.unionByName(unsure).unionByName(alone)
    taken = eine.where("INFNR is not null").select(INFNR).distinct()
    partners = t.eina.join(taken, INFNR, "left_semi").unionByName(own.join(taken, INFNR, "left_anti"))
    return {"eine": eine, "eina": partners}


def _purchasing_tables(t: Tables, m: DataFrame, with_null: bool) -> Tables:
    rows = _registry(t, _purchasing_rows(t, m, with_null), shared=False)
    wide = _materials(m, rows.eina.select(MATNR))
    cut = {n: _reached(t[n], MATNR, wide) for n in ("marc", "mara", "marm")}
    return _registry(t, {"eine": rows.eine, "eina": rows.eina, **cut, "eord": _reached(t.eord, MATNR, m), "lfm2": t.lfm2})


def _capacities(t: Tables, changed: DataFrame) -> DataFrame:
    links = _reached(t.pp_tabs, "KAKO_KAPID", _of(changed, "kako", "crca").distinct()).select("MARA_MATNR")
    return _materials(_of(changed, "pp_tabs"), links, _none_if_any(changed, "kako", "crca", "pp_tabs"))


def _capacity_tables(t: Tables, m: DataFrame, with_null: bool) -> Tables:
    links = _reached(t.pp_tabs, "MARA_MATNR", m)
    pair = lambda df: df.select(col("KAKO_KAPID").alias("KAPID"), col("MARA_SOURCE_SYSTEM").alias(SS)).distinct()
    kako = t.kako.join(pair(links), ["KAPID", SS], "left_semi")
    if with_null:                                            # capacities that no link names, in the whole table
        kako = kako.unionByName(t.kako.join(pair(t.pp_tabs), ["KAPID", SS], "left_anti"))
    return _registry(t, {"pp_tabs": links, "kako": kako, "crca": t.crca.join(kako.select("KAPID", SS).distinct(), ["KAPID", SS], "left_semi")})


def _work_centres(t: Tables, changed: DataFrame) -> DataFrame:
    return _materials(_of(changed, "marc", "mara"), _reached(t.marc.where("WERKS is not null"), "WERKS", _of(changed, "crhd")).select(MATNR))


def _work_centre_tables(t: Tables, m: DataFrame, with_null: bool) -> Tables:
    marc = _reached(t.marc, MATNR, m)
    return _registry(t, {"marc": marc, "mara": _reached(t.mara, MATNR, m), "crhd": _reached(t.crhd, "WERKS", marc.select("WERKS").distinct())})


def _no_zeros(c):
    return F.ltrim(c, F.lit("0"))


def _number(c):
    return c.try_cast("decimal(38,0)")


def _part(c):
    return F.split_part(c, F.lit("|"), F.lit(1))


def _lanes(t: Tables, changed: DataFrame) -> DataFrame:
    k = col("_k")
    codes = _of(changed, "material").where(k.isNotNull())
    senders = _reached(t.bod.where("FROM_GMID is not null"), "FROM_GMID", codes.select(_no_zeros(k)).distinct()).select(GMID)
    receivers = _reached(t.bod.where(_number(col(GMID)).isNotNull()), _number(col(GMID)), codes.select(_number(k)).distinct()).select(GMID)
    return _materials(_of(changed, "bod", "part_dim"), _of(changed, "demand", "forecast").select(_part(k)), _of(changed, "marc", "mara").select(_no_zeros(k)),
                      senders, receivers)


def _lane_tables(t: Tables, m: DataFrame, with_null: bool) -> Tables:
    lanes = _reached(t.bod, GMID, m)
    codes = t.material.where(col("GMID_CODE").isNotNull())
    sent = _reached(codes, _no_zeros(col("GMID_CODE")), lanes.select("FROM_GMID").distinct())
    known = _reached(codes, _number(col("GMID_CODE")), lanes.select(_number(col(GMID))).where(_number(col(GMID)).isNotNull()).distinct())
    return _registry(t, {"bod": lanes, "part_dim": _reached(t.part_dim, GMID, m), "material": sent.unionByName(known).distinct(),
                         **{n: _reached(t[n], _part(col(GMID)), m) for n in ("demand", "forecast")},
                         **{n: _reached(t[n], _no_zeros(col(MATNR)), m) for n in ("marc", "mara")}})


def _registry(t: Tables, frames: dict[str, DataFrame], shared: bool = True) -> Tables:
    """The cut tables, written once: several rules read each of them, and the
    join of EINE and EINA where they have both (and ``shared`` views are wanted)."""
    names = tuple(frames) + (("pir",) if shared and {"eine", "eina"} <= set(frames) else ())
    return Tables(t.spark, {n: (lambda df=df: df) for n, df in frames.items()}).materialize(names=names)


@dataclass(frozen=True)
class Family:
    """Rules whose results are reached from their sources in one way."""
    name: str
    rules: tuple[str, ...]
    reached: object             # (tables, changed keys) -> materials
    tables: object              # (tables, materials, NULL among them) -> the tables cut down


FAMILIES = (
    Family("purchasing", ("dq_aplfz", "dq_bpumn", "dq_bpumz", "dq_bstae", "dq_effpr", "dq_meprf", "dq_mhdrz_eine", "dq_minbm", "dq_netpr",
                          "dq_peinh", "dq_prdat", "dq_uebtk", "dq_uebto", "dq_untto", "dq_lmein", "dq_meins", "dq_umren", "dq_umrez",
                          "dq_bdatu", "dq_notkz", "dq_vdatu"), _purchasing, _purchasing_tables),
    Family("capacity", ("dq_kapid",), _capacities, _capacity_tables),
    Family("work_centre", ("dq_lvorm",), _work_centres, _work_centre_tables),
    Family("lanes", ("dq_dock_to_stock", "dq_effective_end_date", "dq_from_gmid", "dq_from_site", "dq_order_policy", "dq_to_gmid", "dq_to_site"),
           _lanes, _lane_tables),
)


# -- the stored state ----------------------------------------------------------
class ChangeStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, root)

    def _read(self, run: str, what: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{run}/{what}")

    def _write(self, df: DataFrame, run: str, what: str, schema: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{run}/{what}")
        return self._read(run, what, schema)

    def snapshot(self) -> DataFrame:
        """The conformed view that the last finished run left."""
        _, state = self.manifest.read()
        if not state:
            raise ValueError(f"no finished run under {self.root}")
        return self._read(state["run"], "snapshot", SNAPSHOT)

    def reached(self, family: str) -> DataFrame | None:
        """The materials that the last run evaluated for a family; None if it evaluated all."""
        _, state = self.manifest.read()
        return self._read(state["run"], f"reached/{family}", "GMID string") if family in state.get("reached", []) else None

    def run(self, t: Tables, as_of: str, rules=None, version: str = "") -> DataFrame:
        """The conformed view of ``t`` at ``as_of``, equal to ``conformed_suite``;
        sources should be written tables, as ``materialize`` gives. ``version``
        stands for the rules' definitions: another one than the last run's
        evaluates everything, as do other rules and the first run. A rule that
        is in no family is always evaluated as a whole."""
        rules = enabled_rules() if rules is None else rules
        number, state = self.manifest.read()
        run, names = f"run-{uuid.uuid4().hex[:12]}", sorted(r.key for r in rules)
        index = self._write(reduce(DataFrame.unionByName, [row_index(t[n], n) for n in TABLE_NAMES]), run, "index", INDEX)
        went = []
        if state and state["rules"] == names and state["version"] == version:
            result = self._advance(t, as_of, rules, state, index, run, went)
        else:
            result = conformed_suite(t, as_of, rules)
        snap = self._write(result, run, "snapshot", SNAPSHOT)
        self.manifest.commit(number, {"run": run, "as_of": as_of, "rules": names, "version": version, "reached": went})
        return snap

    def _advance(self, t: Tables, as_of: str, rules, state: dict, index: DataFrame, run: str, went: list[str]) -> DataFrame:
        changed = changed_keys(self._read(state["run"], "index", INDEX), index)
        by_date = turned(t, state["as_of"], as_of) if any(r.uses_as_of for r in rules) else None
        if by_date is not None:
            changed = changed.unionByName(by_date).distinct()
        changed = self._write(changed, run, "changed", CHANGED)
        before = self._read(state["run"], "snapshot", SNAPSHOT)
        parts, rest = [], list(rules)
        for f in FAMILIES:
            own = [r for r in rules if r.key in f.rules]
            if not own:
                continue
            rest = [r for r in rest if r not in own]
            m = self._write(f.reached(t, changed), run, f"reached/{f.name}", "GMID string")
            went.append(f.name)
            kept = before.where(col("ATTRIBUTE").isin(*[r.attribute for r in own]))
            with_null, some = bool(m.where("GMID is null").take(1)), bool(m.take(1))
            if some:
                fresh = conformed_suite(f.tables(t, m, with_null), as_of, own)
                parts.append(_reached(fresh, GMID, m))
                kept = kept.join(m.toDF("_m"), col(GMID).eqNullSafe(col("_m")), "left_anti")
            parts.append(kept)
        if rest:
            parts.append(conformed_suite(t, as_of, rest))
        return reduce(DataFrame.unionByName, parts)

    def clean(self, older_than_hours: float = 24.0) -> list[str]:
        """Delete run folders that the newest state does not name and that were left alone for some hours."""
        _, state = self.manifest.read()
        used = self.manifest.name(f"{self.root}/{state['run']}") if state else None
        gone = [p for p in self.manifest.folders("run-*") if p != used and self.manifest.age_hours(p) >= older_than_hours]
        for p in gone:
            self.manifest.remove(p)
        return gone
