"""What each source table must provide: columns, types, and other names.

A reader may find a column under another name (its own mapping, or one of
``OTHER_NAMES``) or as text. Text is read as the contract's type: blank text,
and text that is no such value, becomes NULL, which the rules count as missing;
values lost in this way are counted and kept aside (``quarantine``).
Numbers of another precision are left as they are. Columns beyond the contract
are dropped; a missing one is an error that names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column types by table.
COLUMNS: dict[str, str] = {
    "eine": "SOURCE_SYSTEM string, INFNR string, EKORG string, WERKS string, LOEKZ string, APLFZ decimal(38,10), BPRME string, "
            "BPUMN decimal(38,10), BPUMZ decimal(38,10), BSTAE string, EFFPR decimal(38,10), NETPR decimal(38,10), PEINH decimal(38,10), "
            "PRDAT date, MEPRF string, MHDRZ decimal(38,10), MINBM decimal(38,10), UEBTO decimal(38,10), UNTTO decimal(38,10), UEBTK string",
    "eina": "SOURCE_SYSTEM string, INFNR string, MATNR string, LIFNR string, LOEKZ string, MEINS string, LMEIN string, "
            "UMREZ decimal(38,10), UMREN decimal(38,10)",
    "marc": "SOURCE_SYSTEM string, MATNR string, WERKS string, PLIFZ decimal(38,10), BESKZ string, MMSTA string, LVORM string, "
            "DISMM string, BSTRF decimal(38,10), WEBAZ decimal(38,10), UNETO decimal(38,10)",
    "mara": "SOURCE_SYSTEM string, MATNR string, MEINS string, MSTAE string, ZMTAR string, MTART string, LVORM string",
    "eord": "SOURCE_SYSTEM string, MATNR string, WERKS string, LIFNR string, VDATU date, ERDAT date, BDATU date, NOTKZ string, "
            "AUTET string, FLIFN string",
    "lfm2": "LIFNR string, EKORG string, BSTAE string",
    "marm": "MATNR string, MEINH string",
    "kako": "SOURCE_SYSTEM string, KAPID string",
    "crca": "SOURCE_SYSTEM string, KAPID string",
    "crhd": "SOURCE_SYSTEM string, OBJTY string, OBJID string, WERKS string, LVORM string, BEGDA date, ENDDA date",
    "pp_tabs": "MARA_SOURCE_SYSTEM string, MARA_MATNR string, KAKO_KAPID string",
    "bod": "SOURCE_SYSTEM string, GMID string, FROM_GMID string, SITE string, SITE_UID string, FROM_SITE string, FROM_SITE_UID string, "
           "TYPE string, ORDER_POLICY string, EFFECTIVE_IN_DATE date, EFFECTIVE_OUT_DATE date, DOCK_TO_STOCK_LEAD_TIME string",
    "part_dim": "GMID string, RELEVANCYKNX string",
    "material": "GMID_CODE string, IS_ACTIVE boolean",
    "demand": "GMID string, BALANCE_DELTA decimal(38,10)",
    "forecast": "GMID string, EFFECTIVE_QUANTITY decimal(38,10), FORECAST_DATE date",
}
OTHER_NAMES = {"forecast": {"FORECAST_DATE": "DATE"}}


def columns(name: str) -> T.StructType:
    return T.StructType.fromDDL(COLUMNS[name])


def _kind(t: T.DataType) -> type:
    return T.NumericType if isinstance(t, T.NumericType) else T.DateType if isinstance(t, T.TimestampType) else type(t)


def _resolved(df: DataFrame, name: str, mapping: dict[str, str] | None):
    """(wanted field, column as it comes, column as the contract has it, whether
    it had to be read from another type) of each column of the contract."""
    have = {f.name.upper(): f for f in df.schema.fields}
    other = {**OTHER_NAMES.get(name, {}), **(mapping or {})}
    out, missing = [], []
    for want in columns(name).fields:
        f = have.get(want.name.upper()) if want.name not in (mapping or {}) else None
        f = f or have.get(other.get(want.name, "").upper())
        if f is None:
            missing.append(want.name)
            continue
        raw = c = F.col(f"`{f.name}`")
        read = False
        if _kind(f.dataType) is not _kind(want.dataType):
            if not isinstance(want.dataType, T.StringType):
                text = F.trim(c.cast("string"))
                c = F.when(text != "", text).try_cast(want.dataType)
                read = True
            else:
                c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("date")
        out.append((want, raw, c, read))
    if missing:
        raise ValueError(f"source {name!r} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return out


def _unreadable(raw, read):
    """There is text, and it is no value of the contract's type."""
    return (F.trim(raw.cast("string")) != "") & read.isNull()


def apply(df: DataFrame, name: str, mapping: dict[str, str] | None = None, observation: Observation | None = None) -> DataFrame:
    """``df`` with the contract's columns; names match regardless of case.

    ``observation`` counts the rows (``rows``) and, for each column read from
    another type, the values that could not be read, while some action runs over
    the result; it costs no pass of its own. ``quarantine`` gives the values."""
    if name not in COLUMNS:
        return df                                   # a derived view
    found = _resolved(df, name, mapping)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        *[F.count_if(_unreadable(raw, c)).alias(w.name) for w, raw, c, read in found if read])
    return df.select(*[c.alias(w.name) for w, _, c, _ in found])


def quarantine(df: DataFrame, name: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """The unreadable values of a source: SOURCE, COLUMN_NAME, VALUE (the text
    as it came), REASON, and ROW_KEY, a map of the row's text columns of the
    contract by which the row can be found. The rules see NULL in their place."""
    schema = "SOURCE string, COLUMN_NAME string, VALUE string, REASON string, ROW_KEY map<string,string>"
    found = _resolved(df, name, mapping) if name in COLUMNS else []
    cells = [F.when(_unreadable(raw, c), F.struct(F.lit(w.name).alias("COLUMN_NAME"), raw.cast("string").alias("VALUE"),
                                                  F.lit(f"not a {w.dataType.simpleString()}").alias("REASON"))) for w, raw, c, read in found if read]
    if not cells:
        return df.sparkSession.createDataFrame([], schema)
    key = F.map_from_arrays(F.array(*[F.lit(w.name) for w, _, _, _ in found if isinstance(w.dataType, T.StringType)]),
                            F.array(*[c for w, _, c, _ in found if isinstance(w.dataType, T.StringType)]))
    return (df.select(key.alias("ROW_KEY"), F.explode(F.array_compact(F.array(*cells))).alias("r"))
            .select(F.lit(name).alias("SOURCE"), "r.*", "ROW_KEY"))
