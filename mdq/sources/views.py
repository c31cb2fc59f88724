"""Derived views shared by several rules.

``pir``: every EINE row left-joined to the EINA rows of the same info record
and system. Nine rules read this one join (with their own filters) instead
of each shuffling EINE and EINA again; when the registry is materialized the
join is computed once per run. EINA columns that clash with EINE are renamed
(``EINA_LOEKZ``); ``_HAS_EINA`` marks rows that found a partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pir(t) -> DataFrame:
    eina = t.eina.select("SOURCE_SYSTEM", "INFNR", "MATNR", F.col("LOEKZ").alias("EINA_LOEKZ"), "MEINS",
                         F.lit(True).alias("_HAS_EINA"))
    return t.eine.join(eina, ["INFNR", "SOURCE_SYSTEM"], "left")


DERIVED = {"pir": pir}
