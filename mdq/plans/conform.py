"""X3: conformed results - one row per (system, material, attribute), all
flags with 1 = KO.

``conformed`` works on any suite frame (for example results read back from
storage) by joining the catalog. ``conformed_suite`` builds the same rows
from the rules: those that read the same rows are aggregated together
(``fused``); any other's result is aggregated by (system, material) right away,
so Catalyst drops the rule's own DISTINCT under the MAX (one shuffle less per
rule). The catalog's polarity is applied as a constant.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from mdq.plans.catalog import OK_IS_ONE, enabled_rules
from mdq.plans.fused import conformed_rows
from mdq.plans.records import record_parts
from mdq.session import write_parts

KEY = ["SOURCE_SYSTEM", "GMID", "ATTRIBUTE"]


def _ko(c, flip) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(flip, bool):
        return (F.lit(1) - c) if flip else c
    return F.when(flip, F.lit(1) - c).otherwise(c)


def conformed(suite: DataFrame, catalog: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Map each label to its catalog attribute, flip rules that report
    1 = OK, and keep the worst flag per key (MAX). The catalog side is the
    fixed 31-row table, so it is broadcast."""
    cat = F.broadcast(catalog.select(F.col("label").alias("_label"), F.col("attribute").alias("_attribute"),
                                     (F.col("polarity") == "OK=1").alias("_flip")))
    s = suite.join(cat, suite["ATTRIBUTE"] == cat["_label"])
    flip = F.col("_flip")
    keys = [*extra_keys, "SOURCE_SYSTEM", "GMID", F.col("_attribute").alias("ATTRIBUTE")]
    return (s.groupBy(*keys)
            .agg(F.max(_ko("COMPLETENESS", flip)).cast("int").alias("COMPLETENESS"),
                 F.max(_ko("ACCURACY", flip)).cast("int").alias("ACCURACY")))


def conformed_rule(df: DataFrame, rule) -> DataFrame:
    flip = rule.attribute in OK_IS_ONE
    return (df.groupBy("SOURCE_SYSTEM", "GMID")
            .agg(F.max(_ko("COMPLETENESS", flip)).cast("int").alias("COMPLETENESS"),
                 F.max(_ko("ACCURACY", flip)).cast("int").alias("ACCURACY"))
            .select("SOURCE_SYSTEM", "GMID", F.lit(rule.attribute).alias("ATTRIBUTE"),
                    "COMPLETENESS", "ACCURACY"))


def conformed_rule_at(df: DataFrame, rule, dates) -> DataFrame:
    """``conformed_rule`` for flags given as arrays over ``dates``: the worst
    flag per key and date by one aggregation, then a row for each date at which
    the key has rows (completeness is never NULL in a dated rule)."""
    flip = rule.attribute in OK_IS_ONE
    flags = ("COMPLETENESS", "ACCURACY")
    arrays = {f.name for f in df.schema if isinstance(f.dataType, ArrayType)}
    worst = [F.max(_ko(F.col(c)[i] if c in arrays else c, flip)).cast("int").alias(f"{c}{i}")
             for c in flags for i in range(len(dates))]
    rows = F.array(*[F.struct(*[F.col(f"{c}{i}").alias(c) for c in flags], F.lit(d).cast("date").alias("SNAPSHOT_DATE"))
                     for i, d in enumerate(dates)])
    return (df.groupBy("SOURCE_SYSTEM", "GMID").agg(*worst)
            .select("SOURCE_SYSTEM", "GMID", F.lit(rule.attribute).alias("ATTRIBUTE"), F.explode(rows).alias("r"))
            .select("SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "r.*").where(F.col("COMPLETENESS").isNotNull()))


def conformed_parts(t, as_of=None, rules=None, written: bool = False) -> list[DataFrame]:
    """The conformed view as one frame for each family of rules and each other
    rule; ``written``: those on info records over their one written join."""
    rules = enabled_rules() if rules is None else rules
    first, others = record_parts(t, as_of, rules, True, conformed_rule) if written else ([], rules)
    parts, rest = conformed_rows(t, as_of, others)
    return [df.select(*KEY, "COMPLETENESS", "ACCURACY") for df in first + parts + [conformed_rule(r.rows(t, as_of), r) for r in rest]]


def conformed_suite(t, as_of=None, rules=None) -> DataFrame:
    return reduce(DataFrame.unionByName, conformed_parts(t, as_of, rules))


def conformed_written(t, as_of=None, rules=None) -> DataFrame:
    """``conformed_suite``, its parts written by jobs of their own to the shared folder."""
    return write_parts(t.spark, conformed_parts(t, as_of, rules, written=True), "mdq-conformed")


def conformed_at_dates(t, dates, rules=None) -> DataFrame:
    """Conformed flags at several as-of dates, with SNAPSHOT_DATE. Every rule
    is evaluated once: one that does not read the date is tagged with all
    dates, any other gives its flags as arrays over the dates."""
    rules = enabled_rules() if rules is None else rules
    fixed = [r for r in rules if not r.uses_as_of]
    dated = [r for r in rules if r.uses_as_of]
    parts = []
    if fixed:
        tags = F.array(*[F.lit(d).cast("date") for d in dates])
        parts.append(conformed_suite(t, None, fixed).withColumn("SNAPSHOT_DATE", F.explode(tags)))
    parts += [conformed_rule_at(r.fn(t, list(dates)), r, dates) for r in dated]
    return reduce(DataFrame.unionByName, parts)
