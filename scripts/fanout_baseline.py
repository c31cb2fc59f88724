"""Time the two fan-out joins of SURVEY §4 with and without the dedupe.

Usage: python scripts/fanout_baseline.py [sf_dir]

'plain' is the rule written as the literal join (every vendor-org row, every
plant row), 'dedupe' is the operator in mdq.operators.pir. Both run on the
same materialized tables; results are compared for equality.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from mdq import AS_OF_DEFAULT  # noqa: E402
from mdq.functions import first_match, result  # noqa: E402
from mdq.functions.scope import prefix_scope  # noqa: E402
from mdq.operators import RULES  # noqa: E402


def plain_bstae(t):
    e, v, p = t.eine.alias("e"), t.lfm2.alias("v"), t.eina.alias("p")
    j = (e.where(prefix_scope("e.SOURCE_SYSTEM"))
         .join(v, F.col("v.EKORG") == F.col("e.EKORG"), "left")
         .join(p, F.col("p.INFNR") == F.col("e.INFNR"), "left"))
    b, vb = F.col("e.BSTAE"), F.col("v.BSTAE")
    return result(j, F.col("e.SOURCE_SYSTEM"), F.col("p.MATNR"), "BSTAE",
                  first_match(b.isNull()), first_match(b.isNull(), vb.isNotNull() & (b != vb)))


def plain_loekz(t):
    e, m = t.eine.alias("e"), t.marc.alias("m")
    j = e.where(F.col("e.PRDAT") < F.lit(AS_OF_DEFAULT).cast("date")).join(
        m, (F.col("e.SOURCE_SYSTEM") == F.col("m.SOURCE_SYSTEM")) & (F.col("e.WERKS") == F.col("m.WERKS")))
    i = F.coalesce(F.col("e.INFNR"), F.lit(""))
    return result(j, F.col("e.SOURCE_SYSTEM"), F.col("e.INFNR"), "deactivation flag", first_match(i == ""),
                  first_match((i != "") & (F.coalesce(F.col("m.LVORM"), F.lit("")) == "") & (F.col("e.LOEKZ") != "X")))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from mdq.session import get_session
    from mdq.sources.tables import Tables
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables.from_tpch(spark, sf_dir).materialize(names=("eine", "eina", "lfm2", "marc"))
    for name, plain, fast in [("BSTAE", plain_bstae, RULES["dq_bstae"].fn),
                              ("LOEKZ", plain_loekz, RULES["dq_loekz"].fn)]:
        for label, fn in [("dedupe", fast), ("plain", plain)]:
            t0 = time.time()
            rows = fn(t, AS_OF_DEFAULT).collect() if label == "dedupe" else fn(t).collect()
            print(f"{name} {label}: {len(rows)} rows, {time.time() - t0:.1f}s", flush=True)
            if label == "dedupe":
                ref = sorted(map(tuple, rows), key=str)
            else:
                print(f"{name} equal: {sorted(map(tuple, rows), key=str) == ref}", flush=True)


if __name__ == "__main__":
    main()
