"""Oracle SQL (DuckDB) for the suite, conformed view, scorecard, KO listing and history.

The catalog values here are written from the rule metadata by themselves, not
taken from the engine's catalog."""

from __future__ import annotations

from mdq.oracle.rules_sql import RULE_KEYS, rule_sql

# What the 31 rules have in common, and the exceptions.
CATALOG = """
SELECT attribute,
  CASE attribute WHEN 'LOEKZ' THEN 'deactivation flag' WHEN 'MEINS' THEN 'MEINS_EINA'
                 WHEN 'to_gmid code' THEN 'to_gmid_code' ELSE attribute END AS label,
  CASE attribute WHEN 'MEINS' THEN 'Customer Fulfillment' ELSE 'Planning' END AS class,
  CASE attribute WHEN 'dock to stock lead time' THEN 'Medium' ELSE 'High' END AS criticality,
  CAST(1.0 AS DOUBLE) AS criticality_number,
  CASE attribute WHEN 'LVORM' THEN 'OK=1' ELSE 'KO=1' END AS polarity
FROM (VALUES ('APLFZ'), ('BDATU'), ('BPUMN'), ('BPUMZ'), ('BSTAE'), ('EFFPR'), ('KAPID'), ('LMEIN'), ('LOEKZ'), ('LVORM'),
  ('MEINS'), ('MEPRF'), ('MHDRZ_EINE'), ('MINBM'), ('NETPR'), ('NOTKZ'), ('PEINH'), ('PRDAT'), ('UEBTK'), ('UEBTO'),
  ('UMREN'), ('UMREZ'), ('UNTTO'), ('VDATU'), ('dock to stock lead time'), ('effective end date'), ('from_gmid code'),
  ('from_site'), ('order policy'), ('to_gmid code'), ('to_site')) AS names(attribute)"""
DISABLED = ("dq_loekz",)


def suite_sql(as_of: str) -> str:
    parts = [f"SELECT * FROM (\n{rule_sql(k, as_of)}\n) AS q{i}" for i, k in enumerate(RULE_KEYS) if k not in DISABLED]
    return "\nUNION ALL\n".join(parts)


def ko_listing_sql(as_of: str) -> str:
    return f"""
WITH conf AS ({conformed_sql(as_of)}), cat AS ({CATALOG})
SELECT cat.class AS CLASS, cat.criticality AS CRITICALITY, conf.ATTRIBUTE, SOURCE_SYSTEM, GMID, COMPLETENESS, ACCURACY
FROM conf JOIN cat ON conf.ATTRIBUTE = cat.attribute
WHERE COMPLETENESS = 1 OR ACCURACY = 1"""


def conformed_sql(as_of: str, snapshot: bool = False) -> str:
    snap = f"DATE '{as_of}' AS SNAPSHOT_DATE, " if snapshot else ""
    return f"""
WITH suite AS ({suite_sql(as_of)}),
cat AS ({CATALOG})
SELECT {snap}s.SOURCE_SYSTEM, s.GMID, c.attribute AS ATTRIBUTE,
  CAST(MAX(CASE WHEN c.polarity = 'OK=1' THEN 1 - s.COMPLETENESS ELSE s.COMPLETENESS END) AS INTEGER) AS COMPLETENESS,
  CAST(MAX(CASE WHEN c.polarity = 'OK=1' THEN 1 - s.ACCURACY ELSE s.ACCURACY END) AS INTEGER) AS ACCURACY
FROM suite s JOIN cat c ON s.ATTRIBUTE = c.label
GROUP BY s.SOURCE_SYSTEM, s.GMID, c.attribute"""


def _rate(ko: str, n: str) -> str:
    return f"CAST(CAST(((({n}) - ({ko})) * 20000 + ({n})) // (2 * ({n})) AS DECIMAL(9,0)) / 10000 AS DECIMAL(9,4))"


def scorecard_sql(as_of: str) -> str:
    return f"""
WITH conf AS ({conformed_sql(as_of)}),
cat AS ({CATALOG}),
x AS (SELECT conf.*, cat.class AS CLASS, cat.criticality AS CRITICALITY, CAST(ROUND(cat.criticality_number * 1000) AS BIGINT) AS w,
             GREATEST(conf.COMPLETENESS, COALESCE(conf.ACCURACY, 0)) AS ko_any
      FROM conf JOIN cat ON conf.ATTRIBUTE = cat.attribute),
g AS (SELECT CLASS, CRITICALITY, ATTRIBUTE, CAST(GROUPING(CLASS, CRITICALITY, ATTRIBUTE) AS INTEGER) AS LEVEL,
             COUNT(*) AS N_KEYS,
             CAST(SUM(COMPLETENESS) AS BIGINT) AS COMPLETENESS_KO,
             CAST(SUM(ACCURACY) AS BIGINT) AS ACCURACY_KO,
             COUNT(ACCURACY) AS ACCURACY_CHECKED,
             CAST(SUM(ko_any) AS BIGINT) AS ANY_KO,
             CAST(SUM(w) AS BIGINT) AS W_TOTAL,
             CAST(SUM(w * ko_any) AS BIGINT) AS W_KO
      FROM x GROUP BY GROUPING SETS ((CLASS, CRITICALITY, ATTRIBUTE), (CLASS), (CRITICALITY), ()))
SELECT CLASS, CRITICALITY, ATTRIBUTE, LEVEL, N_KEYS, COMPLETENESS_KO, ACCURACY_KO, ACCURACY_CHECKED, ANY_KO,
  {_rate('COMPLETENESS_KO', 'N_KEYS')} AS COMPLETENESS_RATE,
  {_rate('ACCURACY_KO', 'NULLIF(ACCURACY_CHECKED, 0)')} AS ACCURACY_RATE,
  {_rate('W_KO', 'W_TOTAL')} AS WEIGHTED_OK_RATE
FROM g"""


def materials_sql(as_of: str) -> str:
    material = "COALESCE(SOURCE_SYSTEM, '-') || CASE WHEN GMID IS NULL THEN '?' ELSE '=' || GMID END"
    return f"""
WITH conf AS ({conformed_sql(as_of)}),
x AS (SELECT cat.class AS CLASS, cat.criticality AS CRITICALITY, conf.ATTRIBUTE, {material} AS m,
             (COMPLETENESS = 1 OR COALESCE(ACCURACY, 0) = 1) AS ko
      FROM conf JOIN ({CATALOG}) AS cat ON conf.ATTRIBUTE = cat.attribute)
SELECT CLASS, CRITICALITY, ATTRIBUTE, CAST(GROUPING(CLASS, CRITICALITY, ATTRIBUTE) AS INTEGER) AS LEVEL,
       COUNT(DISTINCT m) AS MATERIALS, COUNT(DISTINCT m) FILTER (WHERE ko) AS KO_MATERIALS
FROM x GROUP BY GROUPING SETS ((CLASS, CRITICALITY, ATTRIBUTE), (CLASS), (CRITICALITY), ())"""


def history_sql(dates=None) -> str:
    from mdq.plans.history import HISTORY_DATES
    dates = sorted(dates or HISTORY_DATES)
    snaps = "\nUNION ALL\n".join(f"SELECT * FROM ({conformed_sql(d, snapshot=True)}) AS s{i}"
                                 for i, d in enumerate(dates))
    idx = ", ".join(f"(DATE '{d}', {i})" for i, d in enumerate(dates))
    key = "SOURCE_SYSTEM, GMID, ATTRIBUTE"
    return f"""
WITH snaps AS ({snaps}),
idx AS (SELECT * FROM (VALUES {idx}) AS t(SNAPSHOT_DATE, i)),
s AS (SELECT snaps.*, idx.i FROM snaps JOIN idx ON snaps.SNAPSHOT_DATE = idx.SNAPSHOT_DATE),
l AS (SELECT *, LAG(i) OVER w AS pi, LAG(COMPLETENESS) OVER w AS pc, LAG(ACCURACY) OVER w AS pa
      FROM s WINDOW w AS (PARTITION BY {key} ORDER BY i)),
r AS (SELECT *, SUM(CASE WHEN pi IS NULL OR pi <> i - 1 OR COMPLETENESS IS DISTINCT FROM pc
                              OR ACCURACY IS DISTINCT FROM pa THEN 1 ELSE 0 END)
                OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM l),
g AS (SELECT {key}, run, MIN(i) AS fi, MAX(i) AS li, MAX(COMPLETENESS) AS COMPLETENESS, MAX(ACCURACY) AS ACCURACY
      FROM r GROUP BY {key}, run)
SELECT g.SOURCE_SYSTEM, g.GMID, g.ATTRIBUTE, CAST(g.COMPLETENESS AS INTEGER) AS COMPLETENESS,
  CAST(g.ACCURACY AS INTEGER) AS ACCURACY, a.SNAPSHOT_DATE AS VALID_FROM, b.SNAPSHOT_DATE AS VALID_TO
FROM g JOIN idx a ON a.i = g.fi LEFT JOIN idx b ON b.i = g.li + 1"""
