"""X2: the suite - the union of all enabled rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdq.operators.joins import spread_copies
from mdq.plans.catalog import enabled_rules
from mdq.plans.fused import suite_rows
from mdq.plans.records import record_parts
from mdq.session import write_parts
from mdq.sources.tables import Tables


def run_suite(t: Tables, as_of=None, rules=None) -> DataFrame:
    """Union (bag) of the five-column results of ``rules`` (default: the
    enabled ones). Rules that read the same rows are evaluated together
    (``fused``)."""
    rules = enabled_rules() if rules is None else rules
    parts, rest = suite_rows(t, as_of, rules)
    return reduce(DataFrame.unionByName, parts + [r.fn(t, as_of) for r in rest])


def suite_written(t: Tables, as_of=None, rules=None) -> DataFrame:
    """``run_suite``, its parts written by jobs of their own to the shared folder.
    Rows that come as counts are written as such (column _n) and expanded, by
    tasks of like many copies, when they are read."""
    rules = enabled_rules() if rules is None else rules
    first, others = record_parts(t, as_of, rules, conformed=False)
    parts, rest = suite_rows(t, as_of, others, counted=True)
    frames = first + parts + [r.distinct_fn(t) if r.distinct_fn else r.fn(t, as_of).withColumn("_n", F.lit(1).cast("bigint")) for r in rest]
    return spread_copies(write_parts(t.spark, frames, "mdq-suite"), "_n")
