"""X1: the rule catalog (one row per rule), from the rules' metadata files.

People, ownership and sign-off fields of the metadata are left out. The
catalog is fixed and tiny (31 rows); it is joined by broadcast. Versions of it
can be stored by the date from which they hold; scorecards of stored snapshots
then use, for each snapshot, the version of its date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdq.operators import RULES

CATALOG_SCHEMA = T.StructType([
    T.StructField("attribute", T.StringType(), False),
    T.StructField("attribute_name", T.StringType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("criticality", T.StringType(), False),
    T.StructField("criticality_number", T.DoubleType(), False),
    T.StructField("class", T.StringType(), False),
    T.StructField("area", T.StringType(), True),
    T.StructField("phase", T.StringType(), False),
    T.StructField("run_in_engine", T.BooleanType(), False),
    T.StructField("in_md_play_book", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("polarity", T.StringType(), False),
])

PB = "Attribute in PB Scope"
BOD = "Bill of Distribution"

# Fixed values (from the rule metadata): attribute, attribute name, source
# table, criticality, criticality number, class, area, phase, run in engine,
# in play book.
_METADATA = [
    ("APLFZ", "planned delivery time", "EINE", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("BDATU", "effective end date", "EORD", "High", 1.0, "Planning", "GSP", "UAT", True, PB),
    ("BPUMN", "denominator for conversion of order price unit into order unit", "EINE", "High", 1.0,
     "Planning", "Procurement", "UAT", True, PB),
    ("BPUMZ", "numerator for conversion of order price unit into order unit", "EINE", "High", 1.0,
     "Planning", "Procurement", "UAT", True, PB),
    ("BSTAE", "confirmation control key", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("EFFPR", "effective price", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("KAPID", "capacity ID", "KAKO", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("LMEIN", "base unit of measure", "EINA", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("LOEKZ", "deactivation flag", "EINE", "High", 1.0, "Planning", None, "DEV", False, PB),
    ("LVORM", "deactivation flag", "CRHD", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("MEINS", "MARA- Base Unit of measure", "MARA", "High", 1.0, "Customer Fulfillment", None, "UAT", True, "No"),
    ("MEPRF", "pricing date control", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("MHDRZ_EINE", "minimum remaining shelf life", "EINE", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("MINBM", "minimum order quantity", "EINE", "High", 1.0, "Planning", "Global Supply Planning", "UAT", True, PB),
    ("NETPR", "net price", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("NOTKZ", "blocked supplier", "EORD", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("PEINH", "price unit", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("PRDAT", "price valid until", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("UEBTK", "unlimited overdelivery allowed", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("UEBTO", "overdelivery tolerance limit", "EINE", "High", 1.0, "Planning", "Procurement", "UAT", True, PB),
    ("UMREN", "denominator for conversion order unit to base unit", "EINA", "High", 1.0,
     "Planning", "Procurement", "UAT", True, PB),
    ("UMREZ", "numerator for conversion order unit to base unit", "EINA", "High", 1.0,
     "Planning", None, "UAT", True, PB),
    ("UNTTO", "underdelivery tolerance limit", "EINE", "High", 1.0, "Planning", "Procurement", "DEV", True, PB),
    ("VDATU", "effective start date", "EORD", "High", 1.0, "Planning", None, "UAT", True, PB),
    ("dock to stock lead time", "Transit DockToStock", BOD, "Medium", 1.0, "Planning",
     "Production Planning / Material Planning", "UAT", True, PB),
    ("effective end date", "Effective Out", BOD, "High", 1.0, "Planning", "GSP", "UAT", True, PB),
    ("from_gmid code", "From_GMID", BOD, "High", 1.0, "Planning", "GSP", "UAT", True, PB),
    ("from_site", "From_Site", BOD, "High", 1.0, "Planning", "GSP", "UAT", True, PB),
    ("order policy", "Order Policy", BOD, "High", 1.0, "Planning", "Local SC", "UAT", True, PB),
    ("to_gmid code", "To_GMID", BOD, "High", 1.0, "Planning", "GSP", "UAT", True, PB),
    ("to_site", "To_Site", BOD, "High", 1.0, "Planning", "GSP", "UAT", True, PB),
]

# The work-centre rule reports 1 = OK on both flags; all others 1 = KO.
OK_IS_ONE = {"LVORM"}


def catalog_rows() -> list[tuple]:
    by_attr = {r.attribute: r for r in RULES.values()}
    return [m + (by_attr[m[0]].label, "OK=1" if m[0] in OK_IS_ONE else "KO=1") for m in _METADATA]


def catalog_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(catalog_rows(), CATALOG_SCHEMA)


#: The first version of a dated catalog holds from here on.
ALWAYS = "0001-01-01"


def publish_catalog(catalog: DataFrame, root: str, valid_from: str = ALWAYS) -> None:
    """Store ``catalog`` as the version that holds from ``valid_from`` on.
    Earlier versions stay; publishing a date again replaces that version."""
    catalog.write.mode("overwrite").parquet(f"{root.rstrip('/')}/VALID_FROM={valid_from}")


def dated_catalog(spark: SparkSession, root: str) -> DataFrame:
    """All versions of the catalog under ``root`` with VALID_FROM and VALID_TO
    (the next version's date, NULL for the last). A version is the whole
    catalog: an attribute that it lacks is not catalogued while it holds."""
    rows = spark.read.schema(T.StructType([*CATALOG_SCHEMA.fields, T.StructField("VALID_FROM", T.DateType())])).parquet(root)
    dates = rows.select("VALID_FROM").distinct()
    ends = dates.select("VALID_FROM", F.lead("VALID_FROM").over(Window.orderBy("VALID_FROM")).alias("VALID_TO"))   # a row per version
    return rows.join(F.broadcast(ends), "VALID_FROM").select(*CATALOG_SCHEMA.names, "VALID_FROM", "VALID_TO")


def enabled_rules():
    on = {m[0] for m in _METADATA if m[8]}
    return [r for r in RULES.values() if r.attribute in on]
