"""Sixteen ERP master-data tables derived from the driver's parquet.

The reference reads warehouse views that are not public. For tests and
benchmarks each view is derived from ``part``, ``supplier`` and ``lineitem``
with integer arithmetic (see FIXTURES.md). Every column is one SQL expression
that Spark and DuckDB evaluate alike, so the same text feeds the Spark
``selectExpr`` and the DuckDB oracle. Row bases are built with DataFrame
operators on the Spark side (``explode`` of a literal array instead of a cross
join with a VALUES list) and with UNION ALL on the DuckDB side.

Fixed values: system names by ``x % 6`` are ATHENA, ATHENA_EU, P08, SHIFT,
XX_ATHENA, LEGACY; units by ``x % 3`` are EA, KG, L.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdq.session import write_shared


def SYS(x: str) -> str:
    return (f"CASE ({x}) % 6 WHEN 0 THEN 'ATHENA' WHEN 1 THEN 'ATHENA_EU' WHEN 2 THEN 'P08' "
            f"WHEN 3 THEN 'SHIFT' WHEN 4 THEN 'XX_ATHENA' ELSE 'LEGACY' END")


def UNIT(x: str) -> str:
    return f"CASE ({x}) % 3 WHEN 0 THEN 'EA' WHEN 1 THEN 'KG' ELSE 'L' END"


def STR(x: str) -> str:
    return f"CAST(({x}) AS STRING)"


def PAD(x: str, n: int) -> str:
    return f"lpad({STR(x)}, {n}, '0')"


def DEC(x: str, p: int, s: int) -> str:
    return f"CAST(({x}) AS DECIMAL({p},{s}))"


def SITE(p: str, s: str) -> str:
    return f"'W0' || {STR(f'({p} + {s}) % 5')} || '_' || {STR(f'{s} % 3')}"


def DAYS(base: str, n: str) -> str:
    return f"DATE '{base}' + CAST(({n}) AS INT)"


COLUMNS: dict[str, list[tuple[str, str]]] = {
    "eine": [
        ("SOURCE_SYSTEM", SYS("p")),
        ("INFNR", PAD("p * 100000 + s", 10)),
        ("EKORG", "'P' || " + STR("(k + j) % 4")),
        ("WERKS", "'W0' || " + STR("(p + s + j) % 5")),
        ("LOEKZ", "CASE k % 6 WHEN 0 THEN 'X' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE ' ' END"),
        ("APLFZ", f"CASE WHEN k % 25 = 0 THEN NULL WHEN k % 25 = 1 THEN {DEC('-2', 3, 0)} "
                  f"ELSE {DEC('(p + s % 2) % 5', 3, 0)} END"),
        ("BPRME", f"CASE WHEN k % 43 = 0 THEN NULL WHEN k % 43 = 1 THEN ' ' WHEN k % 4 = 0 THEN 'BOX' "
                  f"ELSE {UNIT('p')} END"),
        ("BPUMN", f"CASE k % 13 WHEN 0 THEN NULL WHEN 1 THEN {DEC('10', 5, 0)} ELSE {DEC('1', 5, 0)} END"),
        ("BPUMZ", f"CASE k % 17 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 5, 0)} WHEN 2 THEN {DEC('-1', 5, 0)} "
                  f"WHEN 3 THEN {DEC('12', 5, 0)} ELSE {DEC('1', 5, 0)} END"),
        ("BSTAE", "CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN '0002' ELSE '0001' END"),
        ("EFFPR", f"CASE (k + j) % 12 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 11, 2)} "
                  f"ELSE {DEC('k % 900 + 1', 11, 2)} END"),
        ("NETPR", f"CASE (k + j) % 14 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 11, 2)} "
                  f"ELSE {DEC('k % 700 + 1', 11, 2)} END"),
        ("PEINH", f"CASE k % 15 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 5, 0)} ELSE {DEC('100', 5, 0)} END"),
        ("PRDAT", f"CASE WHEN k % 21 = 0 THEN NULL WHEN k % 21 = 1 THEN {DAYS('1998-07-05', 's % 5')} "
                  f"ELSE {DAYS('1996-01-01', 'k % 1800')} END"),
        ("MEPRF", "CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '5' WHEN 3 THEN ' 2' ELSE '1' END"),
        ("MHDRZ", f"CASE k % 11 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 4, 0)} WHEN 2 THEN {DEC('-5', 4, 0)} "
                  f"WHEN 3 THEN {DEC('3651', 4, 0)} WHEN 4 THEN {DEC('3650', 4, 0)} ELSE {DEC('180', 4, 0)} END"),
        ("MINBM", f"CASE k % 18 WHEN 0 THEN NULL WHEN 1 THEN {DEC('1.2345', 15, 4)} "
                  f"WHEN 2 THEN {DEC('100000000', 15, 4)} ELSE {DEC('k % 12 + 1', 15, 4)} END"),
        ("UEBTO", f"CASE k % 16 WHEN 0 THEN NULL WHEN 1 THEN {DEC('4.9', 4, 1)} WHEN 2 THEN {DEC('10.1', 4, 1)} "
                  f"ELSE {DEC('5 + k % 6', 4, 1)} END"),
        ("UNTTO", f"CASE k % 14 WHEN 0 THEN NULL WHEN 1 THEN {DEC('4.9', 3, 1)} WHEN 2 THEN {DEC('10.1', 3, 1)} "
                  f"ELSE {DEC('5 + p % 3', 3, 1)} END"),
        ("UEBTK", "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'X' ELSE 'N' END"),
    ],
    "eina": [
        ("SOURCE_SYSTEM", SYS("y")),
        ("INFNR", PAD("p * 100000 + s", 10)),
        ("MATNR", f"CASE WHEN k % 61 = 0 THEN NULL ELSE {PAD('y', 18)} END"),
        ("LIFNR", PAD("s", 10)),
        ("LOEKZ", "CASE k % 10 WHEN 0 THEN 'X' WHEN 1 THEN '' ELSE NULL END"),
        ("MEINS", f"CASE WHEN k % 41 = 0 THEN NULL WHEN k % 41 = 1 THEN ' ' WHEN k % 3 = 0 THEN 'BOX' "
                  f"ELSE {UNIT('y')} END"),
        ("LMEIN", f"CASE WHEN k % 37 = 0 THEN NULL WHEN k % 37 = 1 THEN '' WHEN k % 8 = 0 THEN 'BOX' "
                  f"ELSE {UNIT('y')} END"),
        ("UMREZ", f"CASE k % 23 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 5, 0)} WHEN 2 THEN {DEC('20001', 5, 0)} "
                  f"WHEN 3 THEN {DEC('-1', 5, 0)} ELSE {DEC('1', 5, 0)} END"),
        ("UMREN", f"CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN {DEC('0', 5, 0)} WHEN 2 THEN {DEC('10001', 5, 0)} "
                  f"WHEN 3 THEN {DEC('-1', 5, 0)} ELSE {DEC('1', 5, 0)} END"),
    ],
    "marc": [
        ("SOURCE_SYSTEM", SYS("p")),
        ("MATNR", PAD("p", 18)),
        ("WERKS", "'W0' || " + STR("(p + j) % 5")),
        ("PLIFZ", f"CASE WHEN p % 16 = 0 THEN NULL ELSE {DEC('(p + j) % 5', 3, 0)} END"),
        ("BESKZ", "CASE (p + j) % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'E' ELSE 'X' END"),
        ("MMSTA", "CASE (p + j) % 7 WHEN 0 THEN 'XX' WHEN 1 THEN 'MC' WHEN 2 THEN NULL ELSE '01' END"),
        ("LVORM", "CASE WHEN (p + j) % 17 = 0 THEN 'X' END"),
        ("DISMM", "CASE p % 8 WHEN 0 THEN 'ND' WHEN 1 THEN NULL ELSE 'PD' END"),
        ("BSTRF", f"CASE (p + j) % 8 WHEN 0 THEN {DEC('0', 13, 3)} WHEN 1 THEN NULL "
                  f"ELSE {DEC('p % 4 + 1', 13, 3)} END"),
        ("WEBAZ", f"CASE WHEN p % 19 = 0 THEN NULL ELSE {DEC('p % 4', 3, 0)} END"),
        ("UNETO", f"CASE WHEN p % 23 = 0 THEN NULL ELSE {DEC('5 + p % 3', 3, 1)} END"),
    ],
    "mara": [
        ("SOURCE_SYSTEM", SYS("y")),
        ("MATNR", PAD("p", 18)),
        ("MEINS", f"CASE WHEN p % 97 = 0 THEN NULL ELSE {UNIT('p')} END"),
        ("MSTAE", "CASE p % 11 WHEN 0 THEN 'XX' WHEN 1 THEN 'WF' WHEN 2 THEN NULL ELSE '01' END"),
        ("ZMTAR", "CASE p % 4 WHEN 0 THEN 'PM' WHEN 1 THEN 'RM' WHEN 2 THEN 'AI' ELSE 'FG' END"),
        ("MTART", "CASE p % 5 WHEN 0 THEN 'SF' WHEN 1 THEN 'AI' WHEN 2 THEN 'ROH' WHEN 3 THEN 'FERT' ELSE 'HALB' END"),
        ("LVORM", "CASE WHEN p % 13 = 0 THEN 'X' END"),
    ],
    "eord": [
        ("SOURCE_SYSTEM", SYS("p")),
        ("MATNR", PAD("p", 18)),
        ("WERKS", "'W0' || " + STR("(p + s) % 5")),
        ("LIFNR", PAD("s", 10)),
        ("VDATU", f"CASE WHEN p % 40 = 0 THEN NULL ELSE {DAYS('1995-01-01', 'k % 1500')} END"),
        ("ERDAT", f"CASE WHEN p % 44 = 0 THEN NULL WHEN p % 2 = 0 AND k % 8 = 0 "
                  f"THEN {DAYS('1995-01-02', 'k % 1500')} ELSE {DAYS('1995-01-01', 'k % 1500')} END"),
        ("BDATU", f"CASE WHEN k % 25 = 0 THEN NULL WHEN k % 4 = 0 THEN DATE '9999-12-31' "
                  f"ELSE {DAYS('1996-01-01', 'k % 1800')} END"),
        ("NOTKZ", "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'X' WHEN 2 THEN ' ' WHEN 3 THEN 'X' ELSE 'Z' END"),
        ("AUTET", "CASE k % 7 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN NULL ELSE '0' END"),
        ("FLIFN", "CASE WHEN k % 11 = 0 THEN 'X' END"),
    ],
    "lfm2": [
        ("LIFNR", PAD("s", 10)),
        ("EKORG", "'P' || " + STR("j")),
        ("BSTAE", "CASE WHEN j = 0 AND s % 2 = 0 THEN '0002' WHEN j = 1 THEN NULL ELSE '0001' END"),
    ],
    "marm": [
        ("MATNR", PAD("p", 18)),
        ("MEINH", f"CASE WHEN j = 1 THEN 'BOX' ELSE {UNIT('p')} END"),
    ],
    "kako": [
        ("SOURCE_SYSTEM", SYS("s")),
        ("KAPID", f"CASE s % 12 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE {PAD('s', 8)} END"),
    ],
    "crca": [
        ("SOURCE_SYSTEM", SYS("s")),
        ("KAPID", PAD("s", 8)),
    ],
    "crhd": [
        ("SOURCE_SYSTEM", f"CASE s % 7 WHEN 0 THEN 'athena_x' WHEN 1 THEN 'shift' ELSE {SYS('s')} END"),
        ("OBJTY", "CASE WHEN s % 4 = 0 THEN 'K' ELSE 'A' END"),
        ("OBJID", PAD("s", 8)),
        ("WERKS", "'W0' || " + STR("s % 5")),
        ("LVORM", "CASE s % 9 WHEN 0 THEN 'X' WHEN 1 THEN '' ELSE NULL END"),
        ("BEGDA", DAYS("1995-01-01", "s")),
        ("ENDDA", f"CASE WHEN s % 2 = 0 THEN DATE '9999-12-31' ELSE {DAYS('1997-01-01', 's % 1000')} END"),
    ],
    "pp_tabs": [
        ("MARA_SOURCE_SYSTEM", SYS("w")),
        ("MARA_MATNR", PAD("p", 18)),
        ("KAKO_KAPID", PAD("w", 8)),
    ],
    "bod": [
        ("SOURCE_SYSTEM", "CASE s % 4 WHEN 0 THEN 'kinaxis' WHEN 1 THEN 'KINAXIS' WHEN 2 THEN 'Kinaxis' ELSE 'kinaxis' END"),
        ("GMID", f"CASE WHEN k % 53 = 0 THEN NULL ELSE {STR('p')} END"),
        ("FROM_GMID", f"CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN {STR('p + 1')} ELSE {STR('p')} END"),
        ("SITE", f"CASE WHEN k % 47 = 0 THEN NULL ELSE {SITE('p', 's')} END"),
        ("SITE_UID", f"CASE k % 8 WHEN 0 THEN 'KINAXIS_WRONG' WHEN 1 THEN 'rapid_W09' WHEN 2 THEN {SITE('p', 's')} "
                     f"WHEN 4 THEN NULL ELSE 'kinaxis_' || {SITE('p', 's')} END"),
        ("FROM_SITE", f"CASE WHEN k % 39 = 0 THEN NULL ELSE 'W0' || {STR('s % 5')} END"),
        ("FROM_SITE_UID", f"CASE k % 10 WHEN 0 THEN 'Kinaxis_ZZ' WHEN 1 THEN 'kinaxis' WHEN 2 THEN NULL "
                          f"ELSE 'kinaxis_W0' || {STR('s % 5')} END"),
        ("TYPE", "CASE k % 11 WHEN 0 THEN 'Make' WHEN 1 THEN 'Buy' WHEN 2 THEN 'Other' WHEN 3 THEN NULL "
                 "WHEN 4 THEN 'TransferCMO' WHEN 5 THEN 'Transfer P2P' ELSE 'Transfer' END"),
        ("ORDER_POLICY", "CASE k % 6 WHEN 0 THEN 'NoOrders' WHEN 1 THEN NULL WHEN 2 THEN ' ' ELSE 'LotForLot' END"),
        ("EFFECTIVE_IN_DATE", f"CASE k % 12 WHEN 0 THEN NULL WHEN 1 THEN DATE '2002-01-01' "
                              f"WHEN 6 THEN DATE '2001-06-30' ELSE {DAYS('1996-01-01', 'k % 900')} END"),
        ("EFFECTIVE_OUT_DATE", f"CASE WHEN s % 13 = 0 THEN NULL ELSE {DAYS('1997-06-01', 'k % 1500')} END"),
        ("DOCK_TO_STOCK_LEAD_TIME", f"CASE k % 15 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '9' "
                                    f"ELSE {STR('p % 4')} END"),
    ],
    "part_dim": [
        ("GMID", STR("p")),
        ("RELEVANCYKNX", "CASE WHEN p % 4 = 0 THEN '0' ELSE '1' END"),
    ],
    "material": [
        ("GMID_CODE", f"CASE WHEN p % 50 = 0 THEN 'X' || {STR('p')} ELSE {PAD('p', 18)} END"),
        ("IS_ACTIVE", "p % 5 <> 0"),
    ],
    "demand": [
        ("GMID", f"{STR('p')} || '|' || {SITE('p', 's')}"),
        ("BALANCE_DELTA", DEC("CASE WHEN n % 2 = 0 THEN q ELSE -q END", 15, 3)),
    ],
    "forecast": [
        ("GMID", f"{STR('p')} || '|' || {SITE('p', 's')}"),
        ("EFFECTIVE_QUANTITY", DEC("CASE WHEN n % 3 = 0 THEN -q ELSE q END", 15, 3)),
        ("FORECAST_DATE", "d"),
    ],
}

NAMES = tuple(COLUMNS)

# Row bases in DuckDB SQL (UNION ALL in place of VALUES cross joins).
_SQL_BASE = {
    "pairs": "SELECT DISTINCT l_partkey AS p, l_suppkey AS s, l_partkey * 7 + l_suppkey AS k FROM lineitem",
    "eine": "SELECT p, s, k, 0 AS j FROM pairs UNION ALL SELECT p, s, k, 1 AS j FROM pairs WHERE k % 5 = 0",
    "eina": "SELECT p, s, k, p AS y FROM pairs WHERE k % 31 <> 0 "
            "UNION ALL SELECT p, s, k, p + 1 AS y FROM pairs WHERE k % 29 = 0",
    "marc": "SELECT p_partkey AS p, 0 AS j FROM part UNION ALL SELECT p_partkey AS p, 1 AS j FROM part",
    "mara": "SELECT p_partkey AS p, p_partkey AS y FROM part "
            "UNION ALL SELECT p_partkey AS p, p_partkey + 1 AS y FROM part WHERE p_partkey % 7 = 0",
    "eord": "SELECT p, s, k FROM pairs WHERE k % 3 = 0",
    "lfm2": "SELECT s_suppkey AS s, 0 AS j FROM supplier UNION ALL SELECT s_suppkey, 1 FROM supplier "
            "UNION ALL SELECT s_suppkey, 2 FROM supplier",
    "marm": "SELECT p_partkey AS p, 0 AS j FROM part "
            "UNION ALL SELECT p_partkey AS p, 1 AS j FROM part WHERE p_partkey % 2 = 0",
    "kako": "SELECT s_suppkey AS s FROM supplier",
    "crca": "SELECT s_suppkey AS s FROM supplier WHERE s_suppkey % 7 <> 3",
    "crhd": "SELECT s_suppkey AS s FROM supplier",
    "pp_tabs": "SELECT p_partkey AS p, p_partkey % 100 AS w FROM part WHERE p_partkey % 100 % 5 <> 4",
    "bod": "SELECT p, s, k FROM pairs WHERE k % 4 <> 3",
    "part_dim": "SELECT p_partkey AS p FROM part",
    "material": "SELECT p_partkey AS p FROM part WHERE p_partkey % 8 <> 7",
    "demand": "SELECT l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_quantity AS q, "
              "CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_partkey % 3 < 2",
    "forecast": "SELECT l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_quantity AS q, "
                "CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_partkey % 3 > 0",
}
_USES_PAIRS = {"eine", "eina", "eord", "bod"}


def sql_ctes(names) -> str:
    """DuckDB CTE definitions (without the leading WITH) for ``names``."""
    names = [n for n in NAMES if n in set(names)]
    parts = []
    if any(n in _USES_PAIRS for n in names):
        parts.append(f"pairs AS ({_SQL_BASE['pairs']})")
    for n in names:
        cols = ", ".join(f"{expr} AS {col}" for col, expr in COLUMNS[n])
        parts.append(f"{n} AS (SELECT {cols} FROM ({_SQL_BASE[n]}) AS b)")
    return ",\n".join(parts)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _lit_array(*vals):
    return F.array(*[F.lit(v) for v in vals])


def spark_bases(spark: SparkSession, sf_dir: str, share: bool = False) -> dict:
    """Lazy DataFrame builders for the row base of each table. ``share``: the
    distinct (part, supplier) pairs, which four tables are made of, are written
    once to the shared folder when the first of these is asked for; otherwise
    each use of them shuffles ``lineitem`` anew."""
    def read(name, *cols):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)

    memo = {}

    def pairs():
        # One DataFrame object, so that tables built from it share its plan
        # (and its cache while the registry is materialized).
        if "pairs" not in memo:
            rows = (read("lineitem", "l_partkey", "l_suppkey")
                    .select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
                    .distinct())
            # Each file in order: rows that are alike stand together, in it and in what is shuffled from it, and compress better.
            rows = write_shared(rows.sortWithinPartitions("p", "s"), "mdq-pairs") if share else rows
            memo["pairs"] = rows.withColumn("k", F.col("p") * 7 + F.col("s"))
        return memo["pairs"]

    def part():
        return read("part", "p_partkey").select(F.col("p_partkey").alias("p"))

    def supplier():
        return read("supplier", "s_suppkey").select(F.col("s_suppkey").alias("s"))

    def lines(cond):
        return (read("lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
                .where(cond)
                .select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
                        F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"),
                        F.col("l_shipdate").cast("date").alias("d")))

    k, p, s = F.col("k"), F.col("p"), F.col("s")
    return {
        "pairs": pairs,
        "eine": lambda: pairs().withColumn(
            "j", F.explode(F.when(k % 5 == 0, _lit_array(0, 1)).otherwise(_lit_array(0)))),
        "eina": lambda: pairs().withColumn(
            "y", F.explode(F.array_compact(F.array(F.when(k % 31 != 0, p), F.when(k % 29 == 0, p + 1))))),
        "marc": lambda: part().withColumn("j", F.explode(_lit_array(0, 1))),
        "mara": lambda: part().withColumn(
            "y", F.explode(F.array_compact(F.array(p, F.when(p % 7 == 0, p + 1))))),
        "eord": lambda: pairs().where(k % 3 == 0),
        "lfm2": lambda: supplier().withColumn("j", F.explode(_lit_array(0, 1, 2))),
        "marm": lambda: part().withColumn(
            "j", F.explode(F.when(p % 2 == 0, _lit_array(0, 1)).otherwise(_lit_array(0)))),
        "kako": supplier,
        "crca": lambda: supplier().where(s % 7 != 3),
        "crhd": supplier,
        "pp_tabs": lambda: part().where(p % 100 % 5 != 4).withColumn("w", p % 100),
        "bod": lambda: pairs().where(k % 4 != 3),
        "part_dim": part,
        "material": lambda: part().where(p % 8 != 7),
        "demand": lambda: lines(F.col("l_partkey") % 3 < 2),
        "forecast": lambda: lines(F.col("l_partkey") % 3 > 0),
    }


def derive(base: DataFrame, name: str) -> DataFrame:
    return base.selectExpr(*[f"{expr} AS {col}" for col, expr in COLUMNS[name]])
