"""Pipeline around the rules: catalog (X1), suite (X2), conformed view (X3),
scorecard (X4) and dated history (X5)."""

from __future__ import annotations

from mdq import AS_OF_DEFAULT


def pipeline_queries():
    from mdq.plans.conform import conformed_written
    from mdq.plans.history import history_query
    from mdq.plans.scorecard import ko_listing_query, materials_query, scorecard_query
    from mdq.plans.suite import suite_written
    from mdq.sources.tables import Tables

    def dqm_suite(spark, sf_dir):
        return suite_written(Tables.from_tpch(spark, sf_dir, share=True), AS_OF_DEFAULT)

    def dqm_conformed(spark, sf_dir):
        return conformed_written(Tables.from_tpch(spark, sf_dir, share=True), AS_OF_DEFAULT)

    return {
        "dqm_suite": dqm_suite,
        "dqm_conformed": dqm_conformed,
        "dqm_scorecard": scorecard_query,
        "dqm_ko_listing": ko_listing_query,
        "dqm_materials": materials_query,
        "dqm_history": history_query,
    }


def pipeline_oracle_sql():
    from mdq.oracle.pipeline_sql import conformed_sql, history_sql, ko_listing_sql, materials_sql, scorecard_sql, suite_sql
    return {
        "dqm_suite": suite_sql(AS_OF_DEFAULT),
        "dqm_conformed": conformed_sql(AS_OF_DEFAULT),
        "dqm_scorecard": scorecard_sql(AS_OF_DEFAULT),
        "dqm_ko_listing": ko_listing_sql(AS_OF_DEFAULT),
        "dqm_materials": materials_sql(AS_OF_DEFAULT),
        "dqm_history": history_sql(),
    }
