"""Command line: run rules or the daily pipeline as a Spark job.

    spark-submit mdq/__main__.py rule dq_aplfz --tables-root s3://.../erp --as-of 2024-01-31 --out s3://.../out
    python -m mdq daily --tables-root /data/erp --as-of 2024-01-31 --snapshots /data/dq/snapshots \
        --history /data/dq/history --out /data/dq/card

The first daily run takes --new-history. On a cluster, ship the package
(``--py-files``) and name ``spark.checkpoint.dir``.

Source tables come from parquet folders ``<tables-root>/<name>`` or, with
``--catalog-db``, from catalog tables ``<db>.<name>``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):                # run as a file by spark-submit
    sys.path[0] = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

from mdq.sources.tables import TABLE_NAMES, Tables


def _tables(spark, args) -> Tables:
    """``--sources`` (JSON: table -> {"table": full name, "columns": {contract
    column: its name}}) overrides where single tables are and how they name columns."""
    own = json.load(open(args.sources)) if args.sources else {}
    mapping = {n: x["columns"] for n, x in own.items() if "columns" in x}
    place = lambda n: own.get(n, {}).get("table")
    if args.catalog_db:
        return Tables.from_catalog(spark, {n: place(n) or f"{args.catalog_db}.{n}" for n in TABLE_NAMES}, mapping)
    return Tables.from_parquet(spark, {n: place(n) or f"{args.tables_root}/{n}" for n in TABLE_NAMES}, mapping)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="mdq")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("rule", "suite", "daily"):
        s = sub.add_parser(name)
        if name == "rule":
            s.add_argument("key")
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--tables-root")
        src.add_argument("--catalog-db")
        s.add_argument("--sources")
        s.add_argument("--as-of", default=None)
        s.add_argument("--out", required=name != "daily")
        if name == "daily":
            s.add_argument("--snapshots", required=True)
            s.add_argument("--history")
            s.add_argument("--new-history", action="store_true")
            s.add_argument("--reports", help="folder for the run's source counts, quarantine and material sketches")
            s.add_argument("--changes", help="folder of the last run's row index: evaluate only what a change has reached")
            s.add_argument("--late", action="store_true", help="the date may lie before the last run")
    args = p.parse_args(argv)

    from mdq.session import get_session
    spark = get_session()
    t = _tables(spark, args)
    if args.cmd == "rule":
        from mdq.operators import RULES
        RULES[args.key].fn(t, args.as_of).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "suite":
        from mdq.plans.suite import run_suite
        run_suite(t.materialize(), args.as_of).write.mode("overwrite").parquet(args.out)
    else:
        from mdq.plans.history import daily_run
        from mdq.plans.scorecard import in_report_order
        as_of = args.as_of or spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
        card = in_report_order(daily_run(t, as_of, args.snapshots, args.history, args.new_history, args.late, args.reports, args.changes))
        if args.out:
            card.write.mode("overwrite").parquet(args.out)
        else:
            card.show(card.count(), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
