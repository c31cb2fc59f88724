"""Flag-set expansion, counted copies, and outer joins that leave NULL keys out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any(cond: Column) -> Column:
    return F.coalesce(F.bool_or(cond), F.lit(False))


def flag_presence(c1: Column, c0: Column, a1: Column, a0: Column) -> list[Column]:
    """Aggregates recording which flag values occur in a group."""
    return [_any(c1).alias("_c1"), _any(c0).alias("_c0"), _any(a1).alias("_a1"), _any(a0).alias("_a0")]


def expand_flag_pairs(df: DataFrame, accuracy_null: Column | None = None) -> DataFrame:
    """Turn the presence columns of ``flag_presence`` into one row per
    (completeness, accuracy) pair: the product of the values seen, as a
    join of two DISTINCT check sets on the group key would give.

    ``accuracy_null``: groups where the accuracy set is the single value NULL.
    """
    one, zero = F.lit(1), F.lit(0)
    c_vals = F.array_compact(F.array(F.when(F.col("_c1"), one), F.when(F.col("_c0"), zero)))
    a_vals = F.array_compact(F.array(F.when(F.col("_a1"), one), F.when(F.col("_a0"), zero)))
    if accuracy_null is not None:
        a_vals = F.when(accuracy_null, F.array(F.lit(None).cast("int"))).otherwise(a_vals)
    return (df.withColumn("COMPLETENESS", F.explode(c_vals))
              .withColumn("ACCURACY", F.explode(a_vals))
              .drop("_c1", "_c0", "_a1", "_a0"))


def expand_copies(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as its column ``count`` says (which is dropped), in
    blocks of 1,024 so that no row holds a long array."""
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({count} - 1) div 1024")))
    left = F.least(F.lit(1024), F.col(count) - F.col("_block") * 1024).cast("int")
    return (df.withColumn("_block", block).withColumn("_copy", F.explode(F.sequence(F.lit(1), left)))
            .drop(count, "_block", "_copy"))


#: Rows for a task that makes copies.
COPIES = 2_000_000


def spread_copies(df: DataFrame, count: str) -> DataFrame:
    """``expand_copies`` of a written ``df`` where the copies are many and may stand
    in few of its files: rows of more than one copy are dealt to tasks by blocks
    of up to 1,024 copies, as many tasks as all copies ask for."""
    total = df.agg(F.sum(count)).first()[0] or 0
    if total <= COPIES:
        return expand_copies(df, count)
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({count} - 1) div 1024")))
    left = F.least(F.lit(1024), F.col(count) - F.col("_block") * 1024).cast("bigint")
    many = df.where(F.col(count) > 1).withColumn("_block", block).withColumn(count, left).drop("_block").repartition(-(-total // COPIES))
    return df.where(F.col(count) <= 1).drop(count).unionByName(expand_copies(many, count))


def left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left outer join on columns of the same names, for keys that may be NULL
    in a large share of ``left``: such rows find nothing, so they go past the
    join, with NULL in the columns of ``right``, and are never dealt by the key
    (a shuffle would put all of them into one partition). Rows and columns are
    those of ``left.join(right, on, "left")``. ``left`` is read twice, so it
    should be a table; for a computed one there is ``spread_join``."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    added = [f for f in right.schema.fields if f.name not in on]
    joined = left.where(whole).join(right, on, "left")
    past = left.where(~whole).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return joined.unionByName(past.select(*joined.columns))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], keep: bool = False) -> DataFrame:
    """``left.join(right, on, "left")`` with the rows of a NULL key, which find
    nothing, dealt by a hash of the whole row, each to some partition. The
    number that does this is 0 for all other rows, on both sides; on the right
    it is written so that the optimizer cannot see that it is a constant.
    ``keep`` leaves it in column _spread, by which rows may be grouped, beside
    their key, in the partitions of the join."""
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    own = F.when(null, F.pmod(F.xxhash64("*"), F.lit(1 << 20)).cast("int")).otherwise(F.lit(0))
    zero = F.pmod(F.hash(*on), F.lit(1))
    df = left.withColumn("_spread", own).join(right.withColumn("_spread", zero), [*on, "_spread"], "left")
    return df if keep else df.drop("_spread")
