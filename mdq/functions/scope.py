"""System-scope predicates used by the rules.

Fixed values (must equal the reference's scope lists):
  prefix scope   : system starts with 'ATHENA', or is 'P08' or 'SHIFT'
  contains scope : system contains 'ATHENA', or is 'P08' or 'SHIFT'
  planning scope : system is 'kinaxis' or 'KINAXIS' (exact case)
  active PIR     : EINA.LOEKZ is null
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ATHENA = "ATHENA"
EXTRA_SYSTEMS = ("P08", "SHIFT")
KINAXIS_SYSTEMS = ("kinaxis", "KINAXIS")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix_scope(ss="SOURCE_SYSTEM") -> Column:
    ss = _c(ss)
    return ss.startswith(ATHENA) | ss.isin(*EXTRA_SYSTEMS)


def contains_scope(ss="SOURCE_SYSTEM") -> Column:
    ss = _c(ss)
    return ss.contains(ATHENA) | ss.isin(*EXTRA_SYSTEMS)


def kinaxis(ss="SOURCE_SYSTEM") -> Column:
    return _c(ss).isin(*KINAXIS_SYSTEMS)


def active_pir(loekz="LOEKZ") -> Column:
    return _c(loekz).isNull()
