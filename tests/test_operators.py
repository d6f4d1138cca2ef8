"""Operator tests on hand-made role tables (one February month, string keys)."""

import datetime as dt
from decimal import Decimal

import pytest

from cohortkit.operators import cohort as C
from cohortkit.operators import flags as FL
from cohortkit.params import RunParams
from cohortkit.plans.leads import build_stages
from tests.units import make_roles

P = RunParams(month_end=dt.date(2023, 2, 28), scorecard_month_end="2023-03-31", lifestage_month="2023-03",
              needs_month="2023-03", run_date=dt.date(2023, 4, 1))
D = dt.date


def _agent(code, ch, trmn=None, loc="L1", can=None):
    return dict(agt_code=code, agt_nm=f"Agent {code}", cntrct_eff_dt=D(2010, 1, 1), trmn_dt=trmn,
                stat_cd="99" if trmn else "01", comp_prvd_num=ch, loc_code=loc, mobl_phon_num="090",
                can_num=can or code)


def _cust(cli, typ="Individual", income=30000):
    return dict(cli_num=cli, cli_nm=f"Name {cli}", id_num=f"ID-{cli}", sex_code="F", birth_dt=D(1980, 1, 1),
                cur_age=43, prim_phon_num="1", mobl_phon_num="2", sms_ind="Y", email_addr=f"{cli}@x",
                sms_eservice_ind="Y", full_address="addr", city="Hà Nội", no_dpnd=1, occp_code="O",
                mthly_incm=Decimal(income), cli_typ=typ)


def _pol(pol, iss, wa, agt, wa2=None, status="1", mode=12):
    return dict(pol_num=pol, pmt_mode=mode, pol_iss_dt=iss, frst_iss_dt=None, pol_eff_dt=iss,
                pol_stat_cd=status, wa_cd_1=wa, wa_cd_2=wa2, agt_code=agt)


def _cvg(pol, plan, typ="B", reasn="O", prem="1000.00", iss=None):
    return dict(pol_num=pol, plan_code=plan, vers_num="1", cvg_stat_cd="1", cvg_typ=typ, cvg_reasn=reasn,
                cvg_prem=Decimal(prem), cvg_iss_dt=iss or D(2010, 1, 1))


@pytest.fixture(scope="module")
def roles(spark):
    agents = [_agent("W1", "01"), _agent("A1", "01"), _agent("A2", "01"), _agent("A3", "04"),
              _agent("B9", "02")]
    policies = [
        _pol("P1", D(2023, 2, 10), "W1", "A1", wa2="A1"),   # C1 first policy → Original (second writer)
        _pol("P2", D(2023, 2, 20), "W1", "A1"),             # C1 second policy of the month
        _pol("P3", D(2023, 2, 15), "W1", "A2"),             # C2: agent A2 is C2's relative
        _pol("P4", D(2023, 3, 10), "W1", "A2"),             # C2 repurchase inside the window
        _pol("P5", D(2023, 2, 5), "W1", "A3"),              # C3 corporate → leaves at the profile join
        _pol("P6", D(2023, 2, 5), "B9", "A1"),              # writing agent outside the channels
        _pol("P7", D(2023, 1, 31), "W1", "A1"),             # previous month
        _pol("P8", D(2023, 2, 11), "W1", "A1", status="9"),  # not in force
    ]
    coverages = [
        _cvg("P1", "BASE1"), _cvg("P1", "BASE2"), _cvg("P1", "RIDER", typ="R"),
        _cvg("P2", "BASE1"), _cvg("P3", "BASE1", prem="2500.00"), _cvg("P4", "BASE1"),
        _cvg("P5", "BASE1"), _cvg("P6", "BASE1"), _cvg("P7", "BASE1"), _cvg("P8", "BASE1"),
    ]
    links = []
    for pol, owner in (("P1", "C1"), ("P2", "C1"), ("P3", "C2"), ("P4", "C2"), ("P5", "C3"), ("P6", "C1"),
                       ("P7", "C1"), ("P8", "C1")):
        links.append(dict(pol_num=pol, cli_num=owner, link_typ="O"))
        links.append(dict(pol_num=pol, cli_num=owner, link_typ="I"))
    links.append(dict(pol_num="P1", cli_num="C4", link_typ="I"))   # second insured: fan-out
    links.append(dict(pol_num="P3", cli_num="C5", link_typ="B"))   # beneficiary
    return make_roles(
        spark,
        agents=agents,
        policy=policies,
        coverage=coverages,
        links=links,
        candidates=[dict(can_num="A1", email_addr="a1@x", id_num="ID-A1"),
                    dict(can_num="A2", email_addr="a2@x", id_num="ID-C5")],
        locations=[dict(loc_code="L1", city="City", region="North")],
        customers=[_cust("C1"), _cust("C2"), _cust("C3", typ="Corporate"), _cust("C4"), _cust("C5")],
        client_details=[dict(cli_num=c, id_num=f"ID-{c}") for c in ("C1", "C2", "C3", "C4", "C5")],
        targets=[dict(tgt_cust_id="C1", batch_start_date=D(2023, 1, 15)),
                 dict(tgt_cust_id="C2", batch_start_date=D(2022, 12, 31))],   # not after the cut-off
        need=[dict(cli_num="C1", decile_acc=9, decile_ci=2, decile_med=9, decile_inv=9, decile_lp=9, decile_lt=9,
                   hml_ci="H")],
    )


def test_cohort_grain_fanout_and_rank(spark, roles):
    df = C.active_cohort(roles, P, rank="split")
    rows = df.select("pol_num", "plan_code", "ins_num", "purchase_order_base", "cus_agt_rltnshp").collect()
    got = sorted((r.pol_num, r.plan_code, r.ins_num, r.purchase_order_base) for r in rows)
    # P1: 3 coverages × 2 insureds; P2, P3: one row each; P5 one row; P6/P7/P8 filtered out
    assert len([g for g in got if g[0] == "P1"]) == 6
    assert {g[0] for g in got} == {"P1", "P2", "P3", "P5"}
    ranks = {(g[0]): g[3] for g in got}
    assert ranks["P1"] == 1 and ranks["P2"] == 2 and ranks["P3"] == 1 and ranks["P5"] == 1
    rel = {r.pol_num: r.cus_agt_rltnshp for r in rows}
    assert rel["P1"] == "Original Agent" and rel["P3"] == "Reassigned Agent" and rel["P5"] == "Orphaned-Collector"


def test_insureds_join_the_first_contract_rows_only(spark, roles):
    base, insureds = C.cohort_base(roles, P)
    # a group policy: many insureds cost no rows before the first-contract filter
    many = insureds.unionByName(spark.range(50).selectExpr("'P2' AS pol_num", "CONCAT('G', id) AS ins_num"))
    assert "ins_num" not in base.columns
    kept = roles.coverage.join(base.select("pol_num").distinct(), "pol_num", "left_semi")
    assert dict(base.groupBy("pol_num").count().collect()) == dict(kept.groupBy("pol_num").count().collect())
    assert C.with_insured(base, many).where("pol_num = 'P2'").count() == 51 * base.where("pol_num = 'P2'").count()
    late = C.with_insured(C.first_contract(base), insureds)
    early = C.first_contract(C.active_cohort(roles, P, rank=None))
    early = early.select(*late.columns)
    assert sorted(map(tuple, late.collect()), key=str) == sorted(map(tuple, early.collect()), key=str)


def test_policies_without_insured_leave_the_base(spark, roles):
    from dataclasses import replace

    bare = replace(roles, links=roles.links.where("NOT (pol_num = 'P3' AND link_typ = 'I')"))
    base, _ = C.cohort_base(bare, P)
    got = {r.pol_num for r in base.collect()}
    assert got == {r.pol_num for r in C.active_cohort(bare, P, rank=None).collect()} and "P3" not in got


def test_first_contract_keeps_ties(spark, roles):
    first = C.first_contract(C.active_cohort(roles, P, rank=None)).collect()
    assert sorted((r.pol_num, r.plan_code, r.ins_num) for r in first) == [
        ("P1", "BASE1", "C1"), ("P1", "BASE1", "C4"), ("P1", "BASE2", "C1"), ("P1", "BASE2", "C4"),
        ("P3", "BASE1", "C2"), ("P5", "BASE1", "C3")]


def test_holdings_summary_counts_policies_once(spark, roles):
    owners = C.cohort_owners(C.active_cohort(roles, P, rank=None))
    summ = {r.po_num: r for r in C.holdings_summary(C.holdings(roles, P, owners), P).collect()}
    # C1 in force up to month end: P1 (3 coverages), P2, P7 → 3 policies; 5 coverages × 1000 × 12/12
    assert summ["C1"].pol_cnt == 3 and summ["C1"].total_ape == Decimal("5000.000000")
    assert summ["C1"]["10yr_pol_cnt"] == 3
    assert summ["C2"].pol_cnt == 1   # P4 is issued after month end


def test_tagged_and_published_rows(spark, roles):
    st = build_stages(roles, P, reuse=None)
    final = {(r.pol_num, r.plan_code, r.insrd_num): r for r in st.final.collect()}
    assert set(final) == {("P1", "BASE1", "C1"), ("P1", "BASE1", "C4"), ("P1", "BASE2", "C1"),
                          ("P1", "BASE2", "C4"), ("P3", "BASE1", "C2")}   # C3 is corporate
    c1 = final[("P1", "BASE1", "C1")]
    # P2 (issued 02-20, same month) is later than P1: the rule counts it as a repurchase
    assert (c1.in_onb_po, c1.in_onb, c1.repurchased, c1.unassigned, c1.sagt_rltv) == ("Y", "Y", "Y", "N", "N")
    assert c1.excluded == "Y" and c1.excluded_grp == "4) Past Campaign Customer"
    c2 = final[("P3", "BASE1", "C2")]
    assert c2.in_onb_po == "N"                 # batch on the cut-off day is not recent
    assert c2.sagt_rltv == "Y"                 # agent A2's ID is the beneficiary's
    assert c2.repurchased == "Y"               # P4 issued 2023-03-10 within [02-01, 04-28]
    assert c2.unassigned == "N"                # a reassigned agent counts as assigned
    assert c2.excluded_grp == "3) Agent is the Owner/Insured/Beneficiary"
    leads = st.leads.collect()
    assert len(leads) == 5 and len(leads[0]) == 79
    c1_lead = [r for r in leads if r.po_num == "C1"][0]
    assert c1_lead.high_prop_model == "Y" and c1_lead.hml_ci == "H"


def test_unassigned_flag_values(spark):
    df = spark.createDataFrame([("Original Agent",), ("Reassigned Agent",), ("Orphaned",), (None,)], "cus_agt_rltnshp string")
    assert [r.u for r in df.select(FL.unassigned_flag().alias("u")).collect()] == ["N", "N", "Y", "Y"]


def test_publish_modes_fanout(spark, roles):
    in_place = build_stages(roles, P, mode="in_place", reuse=None).leads.count()
    rejoin = build_stages(roles, P, mode="rejoin", reuse="table").leads.count()
    # P1 has 4 tagged rows under one (owner, policy, month) key: the self-join gives 16
    assert in_place == 5
    assert rejoin == 4 * 4 + 1


def test_related_party_truth_table(spark):
    rows = spark.createDataFrame([("P1", "X"), ("P1", None), ("P2", "X"), ("P3", "Y")],
                                 "pol_num string, sagt_id_num string")
    pairs = spark.createDataFrame([("P1", "X"), ("P3", "Z")], "pol_num string, id_num string")
    got = sorted((r.pol_num, r.sagt_id_num or "", r.sagt_rltv) for r in FL.related_party_flag(rows, pairs).collect())
    assert got == [("P1", "", "N"), ("P1", "X", "Y"), ("P2", "X", "N"), ("P3", "Y", "N")]


def test_channel_flags_with_duplicate_agent_rows(spark):
    tpol = spark.createDataFrame([("O1", "W1", "S1"), ("O2", "W2", None), ("O3", None, "S3"), ("O4", "W4", "S4")],
                                 "po_num string, wa_code string, sa_code string")
    tagt = spark.createDataFrame([("W1", "Agency", "AGY1"), ("W1", "Banca", "AGY1"), ("W2", "Agency", "DMO7"),
                                  ("S3", "Agency", "FPC2"), ("W4", "Agency", None), ("S4", None, "XDMO")],
                                 "agt_code string, channel string, loc_cd string")
    got = {r.po_num: (r.banca, r.dmtm) for r in FL.channel_overlap_owners(tpol, tagt, P).collect()}
    assert got == {"O1": (1, 0), "O2": (0, 1), "O3": (0, 1)}


def test_insured_contact_key_is_a_parameter(spark):
    targets = spark.createDataFrame([("P9", D(2023, 3, 1)), ("C7", D(2023, 3, 1))],
                                    "tgt_cust_id string, batch_start_date date")
    links = spark.createDataFrame([("P9", "C8", "I"), ("P5", "C7", "I")], "pol_num string, cli_num string, link_typ string")
    as_written = {r.po_num for r in FL.recent_target_insureds(targets, links, P).collect()}
    by_client = {r.po_num for r in FL.recent_target_insureds(targets, links, P, link_key="cli_num").collect()}
    assert as_written == {"C8"} and by_client == {"C7"}
