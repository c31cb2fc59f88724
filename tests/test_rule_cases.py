"""Hand-made rows, one per CASE branch the volume data does not isolate."""

from mdq.operators import RULES

AS_OF = "1998-06-30"


def run(key, t):
    return sorted((tuple(r) for r in RULES[key].fn(t, AS_OF).collect()), key=str)


def test_aplfz_null_falls_to_else(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", APLFZ=None)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", PLIFZ=5, BESKZ="F")])
    assert run("dq_aplfz", t) == [("ATHENA", "M1", "APLFZ", 1, 0)]


def test_aplfz_two_plants_give_both_accuracy_values(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="P08", INFNR="1", APLFZ=5)],
        eina=[dict(SOURCE_SYSTEM="P08", INFNR="1", MATNR="M1")],
        marc=[dict(SOURCE_SYSTEM="P08", MATNR="M1", WERKS="W01", PLIFZ=5),
              dict(SOURCE_SYSTEM="P08", MATNR="M1", WERKS="W02", PLIFZ=7)])
    assert run("dq_aplfz", t) == [("P08", "M1", "APLFZ", 0, 0), ("P08", "M1", "APLFZ", 0, 1)]


def test_aplfz_out_of_scope_and_deleted_pir_dropped(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="LEGACY", INFNR="1", APLFZ=5), dict(SOURCE_SYSTEM="ATHENA", INFNR="2", APLFZ=5)],
        eina=[dict(SOURCE_SYSTEM="LEGACY", INFNR="1", MATNR="M1"),
              dict(SOURCE_SYSTEM="ATHENA", INFNR="2", MATNR="M2", LOEKZ="X")])
    assert run("dq_aplfz", t) == []


def _bdatu_tables(make_tables, mstae, eord=()):
    return make_tables(
        mara=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", MSTAE=mstae, ZMTAR="PM")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", BESKZ="F", DISMM="PD")],
        eord=list(eord))


def test_bdatu_null_status_drops_row(make_tables):
    assert run("dq_bdatu", _bdatu_tables(make_tables, None)) == []


def test_bdatu_without_source_list_is_ko(make_tables):
    assert run("dq_bdatu", _bdatu_tables(make_tables, "01")) == [("ATHENA", "M1", "BDATU", 1, 1)]


def test_bdatu_open_end_and_expired(make_tables):
    eord = [dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", BDATU="9999-12-31"),
            dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", BDATU="1998-06-29")]
    assert run("dq_bdatu", _bdatu_tables(make_tables, "01", eord)) == [
        ("ATHENA", "M1", "BDATU", 0, 0), ("ATHENA", "M1", "BDATU", 0, 1)]


def test_effpr_null_and_zero(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", EFFPR=None), dict(SOURCE_SYSTEM="ATHENA", INFNR="2", EFFPR=0)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1"), dict(SOURCE_SYSTEM="ATHENA", INFNR="2", MATNR="M1")])
    assert run("dq_effpr", t) == [("ATHENA", "M1", "EFFPR", 0, 1), ("ATHENA", "M1", "EFFPR", 1, 1)]


def test_effpr_only_null_gives_null_accuracy(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", EFFPR=None)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1")])
    assert run("dq_effpr", t) == [("ATHENA", "M1", "EFFPR", 1, None)]


def test_effpr_null_material_gives_null_accuracy(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", EFFPR=3)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR=None)])
    assert run("dq_effpr", t) == [("ATHENA", None, "EFFPR", 0, None)]


def test_lvorm_precedence_keeps_p08_work_centre(make_tables):
    t = make_tables(
        crhd=[dict(SOURCE_SYSTEM="P08", OBJTY="K", OBJID="1", WERKS="W01", LVORM="")],
        mara=[dict(SOURCE_SYSTEM="P08", MATNR="M1", LVORM=None)],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01")])
    assert run("dq_lvorm", t) == [("P08", "M1", "LVORM", 0, 1)]


def test_lvorm_pairs_all_values_per_material(make_tables):
    t = make_tables(
        crhd=[dict(SOURCE_SYSTEM="ATHENA", OBJTY="A", OBJID="1", WERKS="W01", LVORM="X"),
              dict(SOURCE_SYSTEM="ATHENA", OBJTY="A", OBJID="2", WERKS="W02", LVORM=None)],
        mara=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", LVORM="X")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01"),
              dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W02")])
    assert run("dq_lvorm", t) == [("ATHENA", "M1", "LVORM", c, a) for c in (0, 1) for a in (0, 1)]


def test_loekz_null_flag_is_not_flagged(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="I1", WERKS="W01", LOEKZ=None, PRDAT="1998-01-01"),
              dict(SOURCE_SYSTEM="ATHENA", INFNR="I2", WERKS="W01", LOEKZ="N", PRDAT="1998-01-01")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", LVORM=None)])
    assert run("dq_loekz", t) == [("ATHENA", "I1", "deactivation flag", 0, 0),
                                  ("ATHENA", "I2", "deactivation flag", 0, 1)]


def test_netpr_null_and_missing_general_data(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", NETPR=None), dict(SOURCE_SYSTEM="ATHENA", INFNR="2", NETPR=0)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1")])
    assert run("dq_netpr", t) == [("ATHENA", "M1", "NETPR", 1, 0), ("ATHENA", None, "NETPR", 0, 1)]


def test_uebto_edges_inclusive(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="SHIFT", INFNR="1", UEBTO=5), dict(SOURCE_SYSTEM="SHIFT", INFNR="2", UEBTO=10),
              dict(SOURCE_SYSTEM="SHIFT", INFNR="3", UEBTO=4.9)],
        eina=[dict(SOURCE_SYSTEM="SHIFT", INFNR="1", MATNR="M1"), dict(SOURCE_SYSTEM="SHIFT", INFNR="2", MATNR="M1"),
              dict(SOURCE_SYSTEM="SHIFT", INFNR="3", MATNR="M3")])
    assert run("dq_uebto", t) == [("SHIFT", "M1", "UEBTO", 0, 0)] * 2 + [("SHIFT", "M3", "UEBTO", 0, 1)]


def _conv_tables(make_tables, z, n, ou, bu):
    return make_tables(
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1", UMREZ=z, UMREN=n, LMEIN=ou)],
        mara=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", MEINS=bu)])


def test_umren_exact_ratio_bound(make_tables):
    assert run("dq_umren", _conv_tables(make_tables, 1, 10001, "KG", "EA")) == [("ATHENA", "M1", "UMREN", 0, 1)]
    assert run("dq_umren", _conv_tables(make_tables, 1, 10000, "KG", "EA")) == [("ATHENA", "M1", "UMREN", 0, 0)]
    assert run("dq_umrez", _conv_tables(make_tables, 10001, 1, "KG", "EA")) == [("ATHENA", "M1", "UMREZ", 0, 1)]


def test_umren_both_null_same_unit(make_tables):
    assert run("dq_umren", _conv_tables(make_tables, None, None, "EA", "EA")) == [("ATHENA", "M1", "UMREN", 0, 0)]
    assert run("dq_umren", _conv_tables(make_tables, None, None, "KG", "EA")) == [("ATHENA", "M1", "UMREN", 1, 1)]


def test_to_site_without_separator(make_tables):
    t = make_tables(bod=[dict(SOURCE_SYSTEM="kinaxis", GMID="1", SITE="W00_1", SITE_UID="kinaxis")])
    assert run("dq_to_site", t) == [("kinaxis", "1", "to_site", 0, 1)]


def test_to_gmid_integer_match_and_null(make_tables):
    t = make_tables(
        bod=[dict(SOURCE_SYSTEM="KINAXIS", GMID="120", FROM_GMID="120"),
             dict(SOURCE_SYSTEM="KINAXIS", GMID=None, FROM_GMID="120"),
             dict(SOURCE_SYSTEM="Kinaxis", GMID="120", FROM_GMID="7")],
        material=[dict(GMID_CODE="000000000000000120", IS_ACTIVE=True)])
    assert run("dq_to_gmid", t) == [("KINAXIS", "120", "to_gmid_code", 0, 0)]


def test_order_policy_blank(make_tables):
    t = make_tables(
        demand=[dict(GMID="7|W01_1", BALANCE_DELTA=5)],
        bod=[dict(SOURCE_SYSTEM="kinaxis", GMID="7", SITE="W01_1", ORDER_POLICY=" ")])
    assert run("dq_order_policy", t) == [("kinaxis", "7", "order policy", 1, 0)]


def test_order_policy_no_orders_window(make_tables):
    t = make_tables(
        forecast=[dict(GMID="7|W01_1", EFFECTIVE_QUANTITY=5, FORECAST_DATE="1999-01-01"),
                  dict(GMID="8|W01_1", EFFECTIVE_QUANTITY=5, FORECAST_DATE="1998-01-01")],
        bod=[dict(SOURCE_SYSTEM="kinaxis", GMID="7", SITE="W01_1", ORDER_POLICY="NoOrders",
                  EFFECTIVE_IN_DATE="2001-06-30", EFFECTIVE_OUT_DATE="1999-01-01"),
             dict(SOURCE_SYSTEM="kinaxis", GMID="7", SITE="W01_1", ORDER_POLICY="NoOrders",
                  EFFECTIVE_IN_DATE="2001-07-01"),
             dict(SOURCE_SYSTEM="kinaxis", GMID="8", SITE="W01_1", ORDER_POLICY="NoOrders")])
    assert run("dq_order_policy", t) == [("kinaxis", "7", "order policy", 0, 0),
                                         ("kinaxis", "7", "order policy", 0, 1)]


def test_untto_duplicate_active_pir_is_squared(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", UNTTO=6)],
        eina=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1"), dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1"),
              dict(SOURCE_SYSTEM="ATHENA", INFNR="1", MATNR="M1", LOEKZ="X")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", UNETO=6)])
    assert run("dq_untto", t) == [("ATHENA", "M1", "UNTTO", 0, 0)] * 4


def test_minbm_multiple_of_rounding_value(make_tables):
    t = make_tables(
        eine=[dict(SOURCE_SYSTEM="ATHENA", INFNR="1", WERKS="W01", MINBM=6),
              dict(SOURCE_SYSTEM="ATHENA", INFNR="2", WERKS="W01", MINBM=7),
              dict(SOURCE_SYSTEM="ATHENA", INFNR="3", WERKS="W02", MINBM=6)],
        eina=[dict(SOURCE_SYSTEM="X", INFNR=i, MATNR="M1") for i in ("1", "2", "3")],
        mara=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W01", BSTRF=3),
              dict(SOURCE_SYSTEM="ATHENA", MATNR="M1", WERKS="W02", BSTRF=0)])
    assert run("dq_minbm", t) == [("ATHENA", "M1", "MINBM", 0, 0), ("ATHENA", "M1", "MINBM", 0, 1)]


def test_dock_to_stock_numeric_match(make_tables):
    t = make_tables(
        bod=[dict(SOURCE_SYSTEM="kinaxis", GMID="12", SITE="W01_2", TYPE="Transfer", DOCK_TO_STOCK_LEAD_TIME="3"),
             dict(SOURCE_SYSTEM="kinaxis", GMID="13", SITE="W01_2", TYPE="Transfer", DOCK_TO_STOCK_LEAD_TIME="abc"),
             dict(SOURCE_SYSTEM="kinaxis", GMID="14", SITE="W01_2", TYPE="TransferCMO", DOCK_TO_STOCK_LEAD_TIME="0")],
        marc=[dict(SOURCE_SYSTEM="ATHENA", MATNR="000000000000000012", WERKS="W01", WEBAZ=3),
              dict(SOURCE_SYSTEM="ATHENA", MATNR="000000000000000013", WERKS="W01", WEBAZ=3),
              dict(SOURCE_SYSTEM="ATHENA", MATNR="000000000000000014", WERKS="W01", WEBAZ=0)],
        mara=[dict(SOURCE_SYSTEM="ATHENA", MATNR="000000000000000014", MTART="SF")])
    assert run("dq_dock_to_stock", t) == [("kinaxis", "12", "dock to stock lead time", 0, 0),
                                          ("kinaxis", "13", "dock to stock lead time", 0, 1),
                                          ("kinaxis", "14", "dock to stock lead time", 0, 1)]


def test_kapid_links_unlinked_and_blank(make_tables):
    t = make_tables(
        kako=[dict(SOURCE_SYSTEM="P08", KAPID="00000001"), dict(SOURCE_SYSTEM="P08", KAPID="00000002"),
              dict(SOURCE_SYSTEM="P08", KAPID=" "), dict(SOURCE_SYSTEM="P08", KAPID=None)],
        crca=[dict(SOURCE_SYSTEM="P08", KAPID="00000001")],
        pp_tabs=[dict(MARA_SOURCE_SYSTEM="P08", KAKO_KAPID="00000001", MARA_MATNR=f"M{i}") for i in range(5)]
        + [dict(MARA_SOURCE_SYSTEM="SHIFT", KAKO_KAPID="00000002", MARA_MATNR="MX")])
    assert run("dq_kapid", t) == sorted(
        [("P08", f"M{i}", "KAPID", 0, 0) for i in range(5)]
        + [("P08", None, "KAPID", 0, 1), ("P08", None, "KAPID", 1, 1)], key=str)
