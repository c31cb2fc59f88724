"""DuckDB SQL used to check the Spark results (tests and the driver's gate).

Each query starts with the fixture CTEs of ``mdq.sources.erp_fixtures`` and
states the rule directly in SQL, without the join rewrites of the Spark
operators, so the two are written independently.
"""
