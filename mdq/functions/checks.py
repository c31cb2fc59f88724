"""Flag construction and the common result shape of every rule."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

RESULT_COLUMNS = ("SOURCE_SYSTEM", "GMID", "ATTRIBUTE", "COMPLETENESS", "ACCURACY")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_col(as_of=None) -> Column:
    """The evaluation date as a DATE column; ``None`` means today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.lit(str(as_of)).cast("date")


def dates_of(as_of=None) -> list[Column]:
    """The evaluation dates: those of a list, else the one date."""
    return [as_of_col(d) for d in as_of] if isinstance(as_of, (list, tuple)) else [as_of_col(as_of)]


def per_date(as_of, flag, on: str | None = None) -> Column:
    """``flag`` (a function of a date column) at the as-of date. For a list of
    dates an array with an element for each, NULL where the boolean array in
    column ``on`` says that the row does not count at that date."""
    dates = dates_of(as_of)
    if not isinstance(as_of, (list, tuple)):
        return flag(dates[0])
    return F.array(*[flag(d) if on is None else F.when(F.col(on)[i], flag(d)) for i, d in enumerate(dates)])


def any_date(as_of, cond) -> Column:
    """Whether ``cond`` (a function of a date column) holds at any of the dates."""
    return reduce(lambda a, b: a | b, map(cond, dates_of(as_of)))


def is_blank(c) -> Column:
    """NULL, or only spaces (string columns only)."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


def is_missing(c) -> Column:
    """NULL, or blank as text. A typed column is never blank; a date or number
    that arrives as text may be."""
    c = _c(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def first_match(*conditions: Column) -> Column:
    """Searched CASE that yields 1 at the first true condition, else 0.

    A condition that evaluates to NULL is not taken, as in SQL.
    """
    out = None
    for cond in conditions:
        out = F.when(cond, F.lit(1)) if out is None else out.when(cond, F.lit(1))
    return out.otherwise(F.lit(0))


def ok_only_if(cond: Column) -> Column:
    """0 when ``cond`` is true, 1 otherwise (false or NULL)."""
    return F.when(cond, F.lit(0)).otherwise(F.lit(1))


def result(df: DataFrame, ss, gmid, label: str, completeness, accuracy,
           distinct: bool = True, also: tuple[str, ...] = ()) -> DataFrame:
    """Project to the five-column result of a rule (and the columns ``also``).
    Flags given for several dates stay arrays."""
    flags = {"COMPLETENESS": _c(completeness), "ACCURACY": _c(accuracy)}
    kinds = df.select(*[c.alias(n) for n, c in flags.items()]).schema
    out = df.select(
        _c(ss).cast("string").alias("SOURCE_SYSTEM"),
        _c(gmid).cast("string").alias("GMID"),
        F.lit(label).alias("ATTRIBUTE"),
        *[(c if isinstance(kinds[n].dataType, ArrayType) else c.cast("int")).alias(n) for n, c in flags.items()],
        *also,
    )
    return out.distinct() if distinct else out
