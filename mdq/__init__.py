"""mdq: master-data quality checks as Spark DataFrame jobs.

Layout
------
sources/    table registry and readers (ERP views, or tables derived from the
            driver's parquet for tests)
functions/  column helpers: blank tests, system-scope predicates, flags
operators/  the 31 quality rules, one DataFrame function each
plans/      the pipeline around the rules: catalog, suite, conformed view,
            scorecard, dated history
oracle/     DuckDB SQL used only to check results
"""

from mdq.sources.tables import Tables  # noqa: F401

AS_OF_DEFAULT = "1998-06-30"
