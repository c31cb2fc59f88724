"""The 31 quality rules as DataFrame operators.

``RULES`` maps the query key to the rule function and to the attribute name
under which the rule is catalogued (the catalog's primary key).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from mdq.operators import bod, capacity, material, pir, source_list


@dataclass(frozen=True)
class Rule:
    key: str
    attribute: str          # catalog attribute (rule folder name)
    label: str              # ATTRIBUTE value the rule emits
    fn: Callable
    uses_as_of: bool = False  # result depends on the evaluation date
    distinct_fn: Callable | None = None  # the same rows without their multiplicities, which column _n has

    def rows(self, t, as_of=None):
        """The rule's rows for uses that do not count duplicates."""
        return self.distinct_fn(t) if self.distinct_fn else self.fn(t, as_of)


_DATED = {"BDATU", "LOEKZ", "NOTKZ", "PRDAT", "from_gmid code", "order policy"}


def _r(key, attribute, label, fn, distinct_fn=None):
    return Rule(key, attribute, label, fn, attribute in _DATED, distinct_fn)


RULES: dict[str, Rule] = {r.key: r for r in [
    _r("dq_aplfz", "APLFZ", "APLFZ", pir.dq_aplfz),
    _r("dq_bdatu", "BDATU", "BDATU", source_list.dq_bdatu),
    _r("dq_bpumn", "BPUMN", "BPUMN", pir.dq_bpumn),
    _r("dq_bpumz", "BPUMZ", "BPUMZ", pir.dq_bpumz),
    _r("dq_bstae", "BSTAE", "BSTAE", pir.dq_bstae),
    _r("dq_effpr", "EFFPR", "EFFPR", pir.dq_effpr),
    _r("dq_kapid", "KAPID", "KAPID", capacity.dq_kapid),
    _r("dq_lmein", "LMEIN", "LMEIN", material.dq_lmein),
    _r("dq_loekz", "LOEKZ", "deactivation flag", pir.dq_loekz),
    _r("dq_lvorm", "LVORM", "LVORM", capacity.dq_lvorm),
    _r("dq_meins", "MEINS", "MEINS_EINA", material.dq_meins),
    _r("dq_meprf", "MEPRF", "MEPRF", pir.dq_meprf),
    _r("dq_mhdrz_eine", "MHDRZ_EINE", "MHDRZ_EINE", pir.dq_mhdrz_eine),
    _r("dq_minbm", "MINBM", "MINBM", pir.dq_minbm),
    _r("dq_netpr", "NETPR", "NETPR", pir.dq_netpr),
    _r("dq_notkz", "NOTKZ", "NOTKZ", source_list.dq_notkz),
    _r("dq_peinh", "PEINH", "PEINH", pir.dq_peinh),
    _r("dq_prdat", "PRDAT", "PRDAT", pir.dq_prdat),
    _r("dq_uebtk", "UEBTK", "UEBTK", pir.dq_uebtk),
    _r("dq_uebto", "UEBTO", "UEBTO", pir.dq_uebto),
    _r("dq_umren", "UMREN", "UMREN", material.dq_umren),
    _r("dq_umrez", "UMREZ", "UMREZ", material.dq_umrez),
    _r("dq_untto", "UNTTO", "UNTTO", pir.dq_untto, pir.untto_counts),
    _r("dq_vdatu", "VDATU", "VDATU", source_list.dq_vdatu),
    _r("dq_dock_to_stock", "dock to stock lead time", "dock to stock lead time", bod.dq_dock_to_stock),
    _r("dq_effective_end_date", "effective end date", "effective end date", bod.dq_effective_end_date),
    _r("dq_from_gmid", "from_gmid code", "from_gmid code", bod.dq_from_gmid),
    _r("dq_from_site", "from_site", "from_site", bod.dq_from_site),
    _r("dq_order_policy", "order policy", "order policy", bod.dq_order_policy),
    _r("dq_to_gmid", "to_gmid code", "to_gmid_code", bod.dq_to_gmid),
    _r("dq_to_site", "to_site", "to_site", bod.dq_to_site),
]}
