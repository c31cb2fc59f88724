"""One hand-made row per CASE branch for the rules not covered in
test_rule_cases.py. Expected values are worked out from the rule text."""

from test_rule_cases import run

S = "ATHENA"


def _pir(make_tables, eine_rows, eina_rows=None, **more):
    """EINE rows with one active EINA partner each (MATNR = 'M' + INFNR)."""
    if eina_rows is None:
        eina_rows = [dict(SOURCE_SYSTEM=r.get("SOURCE_SYSTEM", S), INFNR=r["INFNR"], MATNR="M" + r["INFNR"])
                     for r in eine_rows]
    eine_rows = [dict(SOURCE_SYSTEM=S, **r) if "SOURCE_SYSTEM" not in r else r for r in eine_rows]
    return make_tables(eine=eine_rows, eina=eina_rows, **more)


def test_bpumn_branches(make_tables):
    t = _pir(make_tables, [
        dict(INFNR="1", BPRME="KG", BPUMN=1, BPUMZ=1),
        dict(INFNR="2", BPRME="KG", BPUMN=10, BPUMZ=1),
        dict(INFNR="3", BPRME="KG", BPUMN=1, BPUMZ=1),
        dict(INFNR="4", BPRME=" ", BPUMN=1, BPUMZ=0),
        dict(INFNR="5", BPRME="KG", BPUMN=None, BPUMZ=1),
        dict(INFNR="6", BPRME="KG", BPUMN=1, BPUMZ=1)],
        eina_rows=[dict(SOURCE_SYSTEM=S, INFNR="1", MATNR="M1", MEINS="KG"),
                   dict(SOURCE_SYSTEM=S, INFNR="2", MATNR="M2", MEINS="KG "),
                   dict(SOURCE_SYSTEM=S, INFNR="3", MATNR="M3", MEINS="EA"),
                   dict(SOURCE_SYSTEM=S, INFNR="4", MATNR="M4", MEINS="EA", LOEKZ=""),
                   dict(SOURCE_SYSTEM=S, INFNR="5", MATNR="M5", MEINS="KG"),
                   dict(SOURCE_SYSTEM=S, INFNR="6", MATNR="M6", MEINS="KG", LOEKZ="X")])
    assert run("dq_bpumn", t) == [(S, "M1", "BPUMN", 0, 0), (S, "M2", "BPUMN", 0, 1),
                                  (S, "M3", "BPUMN", 0, 1), (S, "M4", "BPUMN", 1, 1)]


def test_bpumz_branches(make_tables):
    t = _pir(make_tables, [
        dict(INFNR="1", BPRME="KG", BPUMN=1, BPUMZ=1),
        dict(INFNR="2", BPRME="KG", BPUMN=1, BPUMZ=-1),
        dict(INFNR="3", BPRME="KG", BPUMN=1, BPUMZ=12),
        dict(INFNR="4", BPRME="EA", BPUMN=1, BPUMZ=1),
        dict(INFNR="5", BPRME="EA", BPUMN=10, BPUMZ=1)],
        eina_rows=[dict(SOURCE_SYSTEM=S, INFNR=i, MATNR="M" + i, MEINS="KG") for i in "12345"])
    assert run("dq_bpumz", t) == [(S, "M1", "BPUMZ", 0, 0), (S, "M2", "BPUMZ", 0, 1), (S, "M3", "BPUMZ", 0, 1),
                                  (S, "M4", "BPUMZ", 0, 1), (S, "M5", "BPUMZ", 0, 0)]


def test_bstae_vendor_values_and_cross_system_material(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM=S, INFNR="1", EKORG="P0", BSTAE="0001"),
              dict(SOURCE_SYSTEM=S, INFNR="2", EKORG="P9", BSTAE=None),
              dict(SOURCE_SYSTEM="LEGACY", INFNR="3", EKORG="P0", BSTAE=None)],
        lfm2=[dict(LIFNR="V1", EKORG="P0", BSTAE="0002"), dict(LIFNR="V2", EKORG="P0", BSTAE=None),
              dict(LIFNR="V3", EKORG="P0", BSTAE="0002")],
        eina=[dict(SOURCE_SYSTEM="LEGACY", INFNR="1", MATNR="M1")])
    assert run("dq_bstae", t) == sorted([(S, "M1", "BSTAE", 0, 0), (S, "M1", "BSTAE", 0, 1),
                                         (S, None, "BSTAE", 1, 1)], key=str)


def test_lmein_branches(make_tables):
    t = make_tables(
        eina=[dict(SOURCE_SYSTEM="S1", MATNR="M1", LMEIN="KG", UMREZ=1, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M2", LMEIN=""),
              dict(SOURCE_SYSTEM="S1", MATNR="M3", LMEIN="KG"),
              dict(SOURCE_SYSTEM="S1", MATNR="M1", LMEIN="KG", UMREZ=0, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M4", LMEIN="EA")],
        mara=[dict(SOURCE_SYSTEM="A", MATNR="M1", MEINS="KG"), dict(SOURCE_SYSTEM="A", MATNR="M2", MEINS="KG"),
              dict(SOURCE_SYSTEM="A", MATNR="M4", MEINS="EA"), dict(SOURCE_SYSTEM="B", MATNR="M4", MEINS="KG")])
    assert run("dq_lmein", t) == sorted([
        ("S1", "M1", "LMEIN", 0, 0), ("S1", "M1", "LMEIN", 0, 1), ("S1", "M2", "LMEIN", 1, 1),
        ("S1", "M3", "LMEIN", 0, 1), ("S1", "M4", "LMEIN", 0, 0), ("S1", "M4", "LMEIN", 0, 1)], key=str)


def test_meins_branches(make_tables):
    t = make_tables(
        eina=[dict(SOURCE_SYSTEM="S1", MATNR="M1", MEINS="KG", UMREZ=1, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M2", MEINS="BOX", UMREZ=12, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M3", MEINS="KG", UMREZ=1, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M1", MEINS=None, UMREZ=1, UMREN=1),
              dict(SOURCE_SYSTEM="S1", MATNR="M1", MEINS="KG", UMREZ=2, UMREN=1)],
        mara=[dict(SOURCE_SYSTEM="A", MATNR="M1", MEINS="KG"), dict(SOURCE_SYSTEM="A", MATNR="M2", MEINS="EA")],
        marm=[dict(MATNR="M1", MEINH="KG"), dict(MATNR="M2", MEINH="BOX")])
    assert run("dq_meins", t) == sorted([
        ("S1", "M1", "MEINS_EINA", 0, 0), ("S1", "M1", "MEINS_EINA", 1, 1), ("S1", "M1", "MEINS_EINA", 0, 1),
        ("S1", "M2", "MEINS_EINA", 0, 0), ("S1", "M3", "MEINS_EINA", 0, 1)], key=str)


def test_meprf_domain(make_tables):
    t = _pir(make_tables, [dict(INFNR="1", MEPRF="1"), dict(INFNR="2", MEPRF=" 2"), dict(INFNR="3", MEPRF="5"),
                           dict(INFNR="4", MEPRF=" "), dict(INFNR="5", MEPRF=None)])
    assert run("dq_meprf", t) == [(S, "M1", "MEPRF", 0, 0), (S, "M2", "MEPRF", 0, 0), (S, "M3", "MEPRF", 0, 1),
                                  (S, "M4", "MEPRF", 1, 1), (S, "M5", "MEPRF", 1, 1)]


def test_mhdrz_range_and_contains_scope(make_tables):
    vals = {"1": 180, "2": 0, "3": -5, "4": 3650, "5": 3651, "6": None}
    rows = [dict(SOURCE_SYSTEM="XX_ATHENA", INFNR=i, MHDRZ=v) for i, v in vals.items()]
    t = _pir(make_tables, rows)
    x = "XX_ATHENA"
    assert run("dq_mhdrz_eine", t) == [(x, "M1", "MHDRZ_EINE", 0, 0), (x, "M2", "MHDRZ_EINE", 1, 1),
                                       (x, "M3", "MHDRZ_EINE", 0, 1), (x, "M4", "MHDRZ_EINE", 0, 0),
                                       (x, "M5", "MHDRZ_EINE", 0, 1), (x, "M6", "MHDRZ_EINE", 1, 1)]


def test_notkz_branches_and_distinct_base(make_tables):
    base = dict(SOURCE_SYSTEM="P08", MATNR="M1", LIFNR="V", AUTET="0", BDATU="1999-01-01")
    rows = [dict(base, WERKS="W1", NOTKZ="X"), dict(base, WERKS="W1", NOTKZ="X"),
            dict(base, WERKS="W2", NOTKZ="X", AUTET="1"), dict(base, WERKS="W3", NOTKZ="X", FLIFN="X"),
            dict(base, WERKS="W4", NOTKZ="X", BDATU="1997-06-29"), dict(base, WERKS="W5", NOTKZ="X", BDATU="1997-06-30"),
            dict(base, WERKS="W6", NOTKZ="Z"), dict(base, WERKS="W7", NOTKZ=" "),
            dict(base, WERKS="W8", NOTKZ=" X", AUTET="1"), dict(base, SOURCE_SYSTEM="LEGACY", WERKS="W9", NOTKZ=None)]
    t = make_tables(eord=rows)
    got = run("dq_notkz", t)
    assert sorted((c, a) for _, _, _, c, a in got) == sorted(
        [(0, 0), (0, 1), (0, 1), (0, 1), (0, 0), (0, 1), (1, 1), (0, 0)])


def test_peinh_left_join_and_positive(make_tables):
    t = _pir(make_tables, [dict(INFNR="1", PEINH=100), dict(INFNR="2", PEINH=0), dict(INFNR="3", PEINH=None)],
             eina_rows=[dict(SOURCE_SYSTEM=S, INFNR="1", MATNR="M1"), dict(SOURCE_SYSTEM=S, INFNR="3", MATNR="M3")])
    assert run("dq_peinh", t) == sorted([(S, "M1", "PEINH", 0, 0), (S, None, "PEINH", 0, 1),
                                         (S, "M3", "PEINH", 1, 1)], key=str)


def test_prdat_lead_time_edge(make_tables):
    t = _pir(make_tables, [dict(INFNR="1", PRDAT="1998-07-05"), dict(INFNR="2", PRDAT="1998-07-06"),
                           dict(INFNR="3", PRDAT="1998-07-06"), dict(INFNR="4", PRDAT=None)],
             marc=[dict(SOURCE_SYSTEM=S, MATNR="M3", WERKS="W01", WEBAZ=1)])
    assert run("dq_prdat", t) == [(S, "M1", "PRDAT", 0, 1), (S, "M2", "PRDAT", 0, 0),
                                  (S, "M3", "PRDAT", 0, 1), (S, "M4", "PRDAT", 1, 1)]


def test_uebtk_cross_system_partners(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="LEGACY", INFNR="1", UEBTK="X"), dict(SOURCE_SYSTEM="LEGACY", INFNR="2", UEBTK="N"),
              dict(SOURCE_SYSTEM="LEGACY", INFNR="3", UEBTK=" ")],
        eina=[dict(SOURCE_SYSTEM="X1", INFNR="1", MATNR="M1"), dict(SOURCE_SYSTEM="X2", INFNR="1", MATNR="M1b")])
    L = "LEGACY"
    assert run("dq_uebtk", t) == sorted([(L, "M1", "UEBTK", 0, 0), (L, "M1b", "UEBTK", 0, 0),
                                         (L, None, "UEBTK", 0, 1), (L, None, "UEBTK", 1, 1)], key=str)


def test_vdatu_max_per_material(make_tables):
    d, d1 = "1996-01-01", "1996-01-02"
    t = make_tables(eord=[
        dict(SOURCE_SYSTEM=S, MATNR="M1", VDATU=d, ERDAT=d),
        dict(SOURCE_SYSTEM=S, MATNR="M2", VDATU=d, ERDAT=d), dict(SOURCE_SYSTEM=S, MATNR="M2", VDATU=d, ERDAT=d1),
        dict(SOURCE_SYSTEM=S, MATNR="M3", VDATU=None, ERDAT=d), dict(SOURCE_SYSTEM=S, MATNR="M4", VDATU=d, ERDAT=None)])
    assert run("dq_vdatu", t) == [(S, "M1", "VDATU", 0, 0), (S, "M2", "VDATU", 0, 1),
                                  (S, "M3", "VDATU", 1, 1), (S, "M4", "VDATU", 0, 1)]


def test_from_gmid_active_lanes_and_material_status(make_tables):
    t = make_tables(
        bod=[dict(SOURCE_SYSTEM="any", GMID="G1", FROM_GMID="12"), dict(SOURCE_SYSTEM="any", GMID="G2", FROM_GMID="13"),
             dict(SOURCE_SYSTEM="any", GMID="G3", FROM_GMID=""),
             dict(SOURCE_SYSTEM="any", GMID="G4", FROM_GMID="12", EFFECTIVE_IN_DATE="1999-01-01"),
             dict(SOURCE_SYSTEM="any", GMID="G5", FROM_GMID="14", EFFECTIVE_OUT_DATE="1998-06-30")],
        material=[dict(GMID_CODE="000000000000000012", IS_ACTIVE=True),
                  dict(GMID_CODE="000000000000000013", IS_ACTIVE=False),
                  dict(GMID_CODE="0014", IS_ACTIVE=True), dict(GMID_CODE="00014", IS_ACTIVE=False)])
    a = "any"
    assert run("dq_from_gmid", t) == [(a, "G1", "from_gmid code", 0, 0), (a, "G2", "from_gmid code", 0, 1),
                                      (a, "G3", "from_gmid code", 1, 1), (a, "G5", "from_gmid code", 0, 0),
                                      (a, "G5", "from_gmid code", 0, 1)]


def test_from_site_uid_prefix(make_tables):
    k = "kinaxis"
    t = make_tables(bod=[
        dict(SOURCE_SYSTEM=k, GMID="1", FROM_SITE="W01", FROM_SITE_UID="kinaxis_W01"),
        dict(SOURCE_SYSTEM=k, GMID="2", FROM_SITE="W01", FROM_SITE_UID="Kinaxis_W02"),
        dict(SOURCE_SYSTEM=k, GMID="3", FROM_SITE="W01", FROM_SITE_UID="rapid_W02"),
        dict(SOURCE_SYSTEM=k, GMID="4", FROM_SITE=None, FROM_SITE_UID="kinaxis_W01"),
        dict(SOURCE_SYSTEM="Kinaxis", GMID="5", FROM_SITE=None)])
    assert run("dq_from_site", t) == [(k, "1", "from_site", 0, 0), (k, "2", "from_site", 0, 1),
                                      (k, "3", "from_site", 0, 0), (k, "4", "from_site", 1, 0)]


def test_effective_end_date_branches(make_tables):
    k = "KINAXIS"
    t = make_tables(
        bod=[dict(SOURCE_SYSTEM=k, GMID="1", TYPE="Make"),
             dict(SOURCE_SYSTEM=k, GMID="1", TYPE="Other", ORDER_POLICY="NoOrders"),
             dict(SOURCE_SYSTEM=k, GMID="1", TYPE="Other", ORDER_POLICY=None),
             dict(SOURCE_SYSTEM=k, GMID="1", TYPE="Other", ORDER_POLICY="LotForLot"),
             dict(SOURCE_SYSTEM=k, GMID="1", TYPE="Make", EFFECTIVE_OUT_DATE="2000-01-01"),
             dict(SOURCE_SYSTEM=k, GMID="2", TYPE="Make")],
        part_dim=[dict(GMID="1", RELEVANCYKNX="1"), dict(GMID="1", RELEVANCYKNX="1"), dict(GMID="2", RELEVANCYKNX="0")])
    L = "effective end date"
    assert run("dq_effective_end_date", t) == [(k, "1", L, 0, 0), (k, "1", L, 1, 0), (k, "1", L, 1, 1)]
