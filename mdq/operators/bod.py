"""Rules on the bill of distribution (planning system extract)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.functions import any_date, dates_of, first_match, is_blank, is_missing, ok_only_if, per_date, result
from mdq.functions.scope import kinaxis
from mdq.sources.tables import Tables

SS = "SOURCE_SYSTEM"
col = F.col

# Lane types that need an effective-out date (R26).
LANE_TYPES_NEEDING_END = ("Make", "TransferCMO_PUSH", "Transfer", "Transfer_PUSH", "Buy",
                          "TransferCMO", "Transfer P2P", "Transfer P2P_PUSH")
NO_ORDERS = "NoOrders"


def _strip_zeros(c):
    return F.ltrim(c, F.lit("0"))


def dq_dock_to_stock(t: Tables, as_of=None) -> DataFrame:
    """R25 transit dock-to-stock lead time equals the plant's goods-receipt
    processing time (MARC.WEBAZ) for transfer lanes.

    The plant data is matched on the material number without leading zeros
    and the site prefix; both keys are computed as columns so the join stays
    an equi-join.
    """
    bod = (t.bod.where(col("TYPE").contains("Transfer") & kinaxis())
           .select(SS, "GMID", "DOCK_TO_STOCK_LEAD_TIME",
                   F.split_part(col("SITE"), F.lit("_"), F.lit(1)).alias("_site")))
    marc = t.marc.where(col("LVORM").isNull()).select(SS, "MATNR", "WERKS", "WEBAZ")
    mara = t.mara.select(SS, "MATNR", "MTART")
    plant = (marc.join(mara, ["MATNR", SS], "left")
             .select(_strip_zeros(col("MATNR")).alias("_mkey"), col("WERKS").alias("_werks"), "WEBAZ",
                     col("MTART").isin("SF", "AI").alias("_sf_ai"))
             .distinct())
    df = bod.join(plant, (bod["GMID"] == plant["_mkey"]) & (bod["_site"] == plant["_werks"]), "left")
    is_number = col("DOCK_TO_STOCK_LEAD_TIME").try_cast("decimal(38,0)").isNotNull()
    dts = col("DOCK_TO_STOCK_LEAD_TIME").try_cast("decimal(38,10)")     # fractions count in the comparison
    webaz = col("WEBAZ")
    c = first_match(col("DOCK_TO_STOCK_LEAD_TIME").isNull())
    a = ok_only_if(is_number & webaz.isNotNull() & ~(col("_sf_ai") & (webaz == 0)) & (dts == webaz))
    return result(df, bod[SS], "GMID", "dock to stock lead time", c, a)


def relevant_parts(t: Tables) -> DataFrame:
    """GMID of the planning-relevant parts."""
    return t.part_dim.where(col("RELEVANCYKNX") == "1").select("GMID").distinct()


def end_date_flags():
    missing = is_missing("EFFECTIVE_OUT_DATE")
    return (first_match(missing),
            first_match(col("TYPE").isin(*LANE_TYPES_NEEDING_END) & missing, (col("ORDER_POLICY") != NO_ORDERS) & missing))


def dq_effective_end_date(t: Tables, as_of=None) -> DataFrame:
    """R26 effective-out date of lanes of planning-relevant parts."""
    df = t.bod.where(kinaxis()).join(relevant_parts(t), "GMID", "left_semi")
    return result(df, SS, "GMID", "effective end date", *end_date_flags())


def dq_from_gmid(t: Tables, as_of=None) -> DataFrame:
    """R27 sending material of lanes active at as-of: present and active in
    the material dimension (matched without leading zeros)."""
    ein, eout = col("EFFECTIVE_IN_DATE"), col("EFFECTIVE_OUT_DATE")
    active = lambda d: (ein.isNull() | (ein <= d)) & (eout.isNull() | (eout >= d))
    bod = (t.bod.where(any_date(as_of, active))
           .select(SS, "GMID", "FROM_GMID", per_date(as_of, active).alias("_on")))
    mat = t.material.select(_strip_zeros(col("GMID_CODE")).alias("FROM_GMID"), "IS_ACTIVE").distinct()
    df = bod.join(mat, "FROM_GMID", "left")
    c = first_match(is_blank("FROM_GMID"))
    a = ok_only_if(col("FROM_GMID").isNotNull() & (col("IS_ACTIVE") == F.lit(True)))
    return result(df, SS, "GMID", "from_gmid code", per_date(as_of, lambda d: c, "_on"), per_date(as_of, lambda d: a, "_on"))


def site_flags(site: str, uid: str):
    """Completeness and accuracy of a site against the text after '_' of its uid."""
    u = col(uid)
    after_bar = F.substr(u, F.instr(u, "_") + 1)
    return (first_match(col(site).isNull()),
            first_match((F.lower(F.split_part(u, F.lit("_"), F.lit(1))) == "kinaxis") & (col(site) != after_bar)))


def _site_checks(t: Tables, site: str, uid: str, label: str) -> DataFrame:
    c, a = site_flags(site, uid)
    return result(t.bod.where(kinaxis()), SS, "GMID", label, c, a)


def dq_from_site(t: Tables, as_of=None) -> DataFrame:
    """R28 sending site agrees with the text after '_' of its uid."""
    return _site_checks(t, "FROM_SITE", "FROM_SITE_UID", "from_site")


def dq_to_site(t: Tables, as_of=None) -> DataFrame:
    """R31 receiving site agrees with the text after '_' of its uid."""
    return _site_checks(t, "SITE", "SITE_UID", "to_site")


def active_lanes(t: Tables, as_of=None) -> DataFrame:
    """(part, site) pairs that are in use: their demand adds up to more than
    nothing, or their forecast after the as-of date does; ``_on`` says it for
    each of several dates. One aggregation over all quantities."""
    zero, later = F.lit(0), lambda d: col("FORECAST_DATE") > d
    planned = [f"planned{i}" for i in range(len(dates_of(as_of)))]
    moves = t.demand.select("GMID", col("BALANCE_DELTA").alias("needed"), *[zero.alias(p) for p in planned]).unionByName(
        t.forecast.where(any_date(as_of, later))
        .select("GMID", zero.alias("needed"), *[F.when(later(d), col("EFFECTIVE_QUANTITY")).otherwise(zero).alias(p)
                                                for p, d in zip(planned, dates_of(as_of))]))
    used = [(col("needed") > 0) | (col(p) > 0) for p in planned]
    part = lambda i: F.split_part(col("GMID"), F.lit("|"), F.lit(i))
    return (moves.groupBy(part(1).alias("PART"), part(2).alias("SITE"))
            .agg(F.sum("needed").alias("needed"), *[F.sum(p).alias(p) for p in planned])
            .where(reduce(lambda a, b: a | b, used)).select("PART", "SITE", F.array(*used).alias("_on")))


def dq_order_policy(t: Tables, as_of=None) -> DataFrame:
    """R29 order policy of the lanes in use (bag). Accuracy is KO only for a
    'NoOrders' lane that is current and starts within 3 years."""
    # A lane's own flags go through the join in place of what they are made of.
    policy = F.coalesce(F.trim(col("ORDER_POLICY")), F.lit(""))
    stopped = lambda d: ((policy == NO_ORDERS) & F.coalesce(col("EFFECTIVE_OUT_DATE") >= d, F.lit(True))
                         & F.coalesce(col("EFFECTIVE_IN_DATE") <= F.add_months(d, 36), F.lit(True)))
    lanes = t.bod.select(col("GMID").alias("PART"), "SITE", SS, first_match(policy == "").cast("tinyint").alias("_C"),
                         per_date(as_of, lambda d: first_match(stopped(d)).cast("tinyint")).alias("_A"))
    df = lanes.join(active_lanes(t, as_of), ["PART", "SITE"])
    at = iter(range(len(dates_of(as_of))))
    accuracy = per_date(as_of, lambda d: col("_A")[next(at)].cast("int"), "_on") if isinstance(as_of, (list, tuple)) else col("_A")
    return result(df, SS, "PART", "order policy", per_date(as_of, lambda d: col("_C").cast("int"), "_on"), accuracy, distinct=False)


def receiver_key(code: str = "GMID"):
    return col(code).try_cast("decimal(38,0)")


def active_receivers(t: Tables) -> DataFrame:
    """The active materials' numbers (_key)."""
    return t.material.where(col("IS_ACTIVE") == F.lit(True)).select(receiver_key("GMID_CODE").alias("_key")).distinct()


def receiver_flags():
    g = col("GMID")
    return first_match(g.isNull()), first_match(g.isNull(), g != col("FROM_GMID"))


def dq_to_gmid(t: Tables, as_of=None) -> DataFrame:
    """R30 receiving material exists and is active (integer match).

    The reference's WHERE on the outer-joined side makes the join inner; as
    no material column is output, it is a semi join on the active keys.
    """
    bod = t.bod.where(kinaxis()).withColumn("_key", receiver_key())
    df = bod.join(active_receivers(t), "_key", "left_semi")
    return result(df, SS, "GMID", "to_gmid_code", *receiver_flags())
