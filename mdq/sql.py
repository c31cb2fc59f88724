"""SQL surface: the rules, suite and conformed view as temporary views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from mdq.operators import RULES
from mdq.plans.conform import conformed_suite
from mdq.plans.suite import run_suite
from mdq.sources.tables import TABLE_NAMES, Tables


def register_views(spark: SparkSession, t: Tables, as_of=None, sources: bool = True) -> list[str]:
    """Create temp views ``dq_<rule>``, ``dqm_suite`` and ``dqm_conformed``
    (and, with ``sources``, one view per source table) for ``spark.sql``."""
    names = []
    if sources:
        for n in TABLE_NAMES:
            t[n].createOrReplaceTempView(n)
            names.append(n)
    for key, rule in RULES.items():
        rule.fn(t, as_of).createOrReplaceTempView(key)
        names.append(key)
    run_suite(t, as_of).createOrReplaceTempView("dqm_suite")
    conformed_suite(t, as_of).createOrReplaceTempView("dqm_conformed")
    return names + ["dqm_suite", "dqm_conformed"]
