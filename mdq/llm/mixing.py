"""Mixing sources to target weights by Poisson replication (native).

Each document of source s is repeated Poisson(rate_s) times, where
rate_s = total * weight_s / (sum of weights) / size_s, so that the expected
size of each source in the mix is its share of ``total``. The Poisson number
is the inverse of its distribution function at a uniform number that is hashed
from a seed and the document's id, so a rerun repeats the same documents; for a
high rate it is the sum of several Poisson numbers of equal, bounded rates. The
copies are then dealt out by the hash of (seed, id, copy), which shuffles them
across all partitions. Only DataFrame functions are used.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mdq.llm.common import free_prefix, quoted, read_table, write_shared

SEED = "mix-1"
PART_RATE = 64          # largest rate of one Poisson number; a higher one is the sum of several


def _unit(*cols):
    """(first 13 hex digits of md5 + 0.5) / 2^52: strictly between 0 and 1."""
    digits = F.substring(F.md5(F.concat_ws("|", *cols)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))


def _id(col="doc_id"):
    return F.coalesce(F.col(col).cast("string"), F.lit("null"))


def rates(docs: DataFrame, weights: dict | None = None, group: str = "source",
          total: float | None = None) -> DataFrame:
    """One row per source: mx_group, mx_size (UTF-8 bytes plus one per
    document), mx_rate, mx_parts (the number of Poisson numbers that are added
    up for a document: each has a rate of at most ``PART_RATE``) and mx_cdf (the
    distribution function of one of them, an array of bounded length).
    ``weights`` maps a source (None: the null source) to its weight; None gives
    every source the same. A source missing from ``weights`` has weight 0.
    ``total`` defaults to the input's size."""
    size = docs.groupBy(F.col(quoted(group)).alias("mx_group")).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("mx_size"))
    if weights is None:
        w = F.lit(1.0)
    elif not weights:
        raise ValueError("weights must not be empty")
    else:
        named = {k: float(v) for k, v in weights.items() if k is not None}
        of = F.create_map(*[F.lit(x) for x in chain(*named.items())])[F.col("mx_group")] if named else F.lit(0.0)
        w = F.when(F.col("mx_group").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(F.coalesce(of, F.lit(0.0)))
    size = write_shared(size.withColumn("mx_weight", w), "mix-sizes")
    sums = size.agg(F.sum("mx_size").cast("double").alias("t"), F.sum("mx_weight").alias("w")).first()
    if sums["t"] is not None and not sums["w"]:
        raise ValueError("no source of the input has a positive weight")
    goal = float(total if total is not None else sums["t"] or 0.0)
    rate = F.lit(goal) * F.col("mx_weight") / F.lit(sums["w"] or 1.0) / F.col("mx_size").cast("double")
    lam = F.col("mx_part_rate")
    steps = (size.withColumn("mx_rate", rate)
             .withColumn("mx_parts", F.greatest(F.lit(1), F.ceil(F.col("mx_rate") / PART_RATE)).cast("bigint"))
             .withColumn("mx_part_rate", F.col("mx_rate") / F.col("mx_parts"))
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil(lam + 12 * F.sqrt(lam) + 40).cast("int")))))
    by = W.partitionBy("mx_group").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    term = F.when(F.col("k") == 0, -lam).otherwise(F.log(lam) - F.log(F.col("k").cast("double")))
    steps = steps.withColumn("mx_log", F.sum(F.when(lam > 0, term).otherwise(F.when(F.col("k") == 0, 0.0).otherwise(-1e300))).over(by))
    steps = steps.withColumn("mx_cdf", F.sum(F.exp("mx_log")).over(by))
    out = steps.groupBy("mx_group", "mx_size", "mx_rate", "mx_parts").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "mx_cdf"))), lambda x: x["mx_cdf"]).alias("mx_cdf"))
    return write_shared(out, "mix-rates")


def _blocks(n: str, p: str):
    """Numbers of the blocks of 1,024 that ``n`` copies or parts fill, and the
    range of one block: no array is longer, whatever the number."""
    first = F.col(f"{p}block") * 1024
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({n} - 1) div 1024"))), first, F.least(F.col(n), first + 1024)


def _counts(rows: DataFrame, p: str, seed: str) -> DataFrame:
    """Copies of each id of the sources of more than one part: the sum of its
    Poisson numbers, each at a hashed uniform number of its own. Ids, not texts,
    are exploded, and the numbers are added up before the shuffle."""
    ids = rows.filter(f"{p}parts > 1").select(f"{p}group", f"{p}id", f"{p}parts", f"{p}cdf").dropDuplicates([f"{p}group", f"{p}id"])
    blocks, first, end = _blocks(f"{p}parts", p)
    part = F.explode(F.sequence(first, end - 1))
    u = F.when(F.col(f"{p}part") == 0, _unit(F.lit(seed), F.col(f"{p}id"))).otherwise(
        _unit(F.lit(seed), F.col(f"{p}id"), F.lit("part"), F.col(f"{p}part").cast("string")))
    return (ids.withColumn(f"{p}block", blocks).withColumn(f"{p}part", part).withColumn(f"{p}u", u)
            .groupBy(f"{p}group", f"{p}id").agg(F.sum(F.size(F.filter(f"{p}cdf", lambda c: c < F.col(f"{p}u")))).alias(f"{p}n"))
            .select(F.col(f"{p}group").alias(f"{p}of"), F.col(f"{p}id").alias(f"{p}by"), f"{p}n"))


def mix(docs: DataFrame, weights: dict | None = None, group: str = "source",
        total: float | None = None, seed: str = SEED) -> DataFrame:
    """The documents, each repeated by its count and shuffled over all rows:
    the input's columns plus copy (long, from 1) and shuffle_key (hex), rows
    ordered by shuffle_key within a partition that the key's hash chooses.

    Null ids hash as 'null'; rows with the same id get the same count; null and
    empty texts have size 1; the null source is a source of its own; an empty
    table gives an empty table. Input columns named copy or shuffle_key are
    replaced; any other name is kept. The rates table has a row per source and
    is joined by whatever plan its measured size allows; a hot source only
    lengthens the split side. However high a source's rate (a few bytes beside a
    large corpus), no row holds more than some thousand numbers.
    """
    keep = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    p = free_prefix(docs.columns, "mx")
    r = rates(docs, weights, group, total)
    r = r.select(*[F.col(f"mx_{c}").alias(f"{p}{c}") for c in ("group", "cdf", "parts")])
    rows = (docs.select(*[F.col(quoted(c)) for c in keep], _id().alias(f"{p}id"))
            .join(r, F.col(quoted(group)).eqNullSafe(F.col(f"{p}group"))))
    n = F.size(F.filter(f"{p}cdf", lambda c: c < F.col(f"{p}u"))).cast("bigint")
    names = [F.col(quoted(c)) for c in keep] + [F.col(f"{p}id"), F.col(f"{p}n")]
    out = rows.filter(f"{p}parts = 1").withColumn(f"{p}u", _unit(F.lit(seed), F.col(f"{p}id"))).withColumn(f"{p}n", n).select(*names)
    if not r.filter(f"{p}parts > 1").isEmpty():
        counts = _counts(rows, p, seed)
        many = rows.filter(f"{p}parts > 1").join(counts, F.col(f"{p}group").eqNullSafe(F.col(f"{p}of")) & (F.col(f"{p}id") == F.col(f"{p}by")))
        out = out.unionByName(many.select(*names))
    blocks, first, end = _blocks(f"{p}n", p)
    out = (out.filter(f"{p}n > 0").withColumn(f"{p}block", blocks)
           .withColumn("copy", F.explode(F.sequence(first + 1, end)))
           .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(seed), F.col(f"{p}id"), F.col("copy").cast("string")))))
    return (out.select(*[F.col(quoted(c)) for c in keep], "copy", "shuffle_key")
            .repartition("shuffle_key").sortWithinPartitions("shuffle_key"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, sources mixed to equal shares of the corpus size."""
    return mix(read_table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH s AS (SELECT source AS g, SUM(COALESCE(octet_length(encode(text)), 0) + 1)::DOUBLE AS size
           FROM documents GROUP BY source),
     t AS (SELECT SUM(size) AS total, COUNT(*)::DOUBLE AS w FROM s),
     r AS (SELECT g, greatest(1, ceil(total * 1.0 / w / size / {PART_RATE}))::BIGINT AS parts, total * 1.0 / w / size / parts AS rate FROM s, t),
     p AS (SELECT g, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS pmf
           FROM (SELECT g, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r)),
     c AS (SELECT g, k, SUM(pmf) OVER (PARTITION BY g ORDER BY k) AS cdf FROM p),
     l AS (SELECT g, list(cdf ORDER BY k) AS cdfs FROM c GROUP BY g),
     i AS (SELECT DISTINCT source AS g, COALESCE(doc_id::VARCHAR, 'null') AS id FROM documents),
     u AS (SELECT i.g, id, unnest(range(0, parts)) AS part FROM i JOIN r ON i.g IS NOT DISTINCT FROM r.g),
     h AS (SELECT g, id, (('0x' || substr(md5('{SEED}|' || id || CASE WHEN part = 0 THEN '' ELSE '|part|' || part END), 1, 13))::BIGINT
                          + 0.5) / 4503599627370496.0 AS u FROM u),
     n AS (SELECT h.g, id, SUM(len(list_filter(cdfs, lambda z: z < u)))::BIGINT AS n
           FROM h JOIN l ON h.g IS NOT DISTINCT FROM l.g GROUP BY h.g, id),
     e AS (SELECT doc_id, text, lang, source, n_chars, id, unnest(range(1, n + 1))::BIGINT AS copy
           FROM documents JOIN n ON source IS NOT DISTINCT FROM g AND COALESCE(doc_id::VARCHAR, 'null') = id)
SELECT doc_id, text, lang, source, n_chars, copy, md5('{SEED}|' || id || '|' || copy) AS shuffle_key FROM e
"""
