"""A hot owner holding a third of the month's policies: whole results, no row caps."""

import datetime as dt
from decimal import Decimal

from cohortkit.operators import cohort as C
from cohortkit.params import RunParams
from cohortkit.plans.leads import build_stages
from tests.units import make_roles

P = RunParams(month_end=dt.date(2023, 2, 28), scorecard_month_end="2023-03-31", lifestage_month="2023-03",
              needs_month="2023-03", run_date=dt.date(2023, 4, 1))
N_HOT, N_OTHER = 300, 600


def _roles(spark):
    policies, coverages, links, customers = [], [], [], []
    for i in range(N_HOT + N_OTHER):
        pol = f"P{i:04d}"
        owner = "HOT" if i < N_HOT else f"C{i:04d}"
        iss = dt.date(2023, 2, 1 + (i * 7) % 28)
        policies.append(dict(pol_num=pol, pmt_mode=12, pol_iss_dt=iss, frst_iss_dt=None, pol_eff_dt=iss,
                             pol_stat_cd="1", wa_cd_1="W1", wa_cd_2=None, agt_code="A1"))
        coverages.append(dict(pol_num=pol, plan_code="B", vers_num="1", cvg_stat_cd="1", cvg_typ="B",
                              cvg_reasn="O", cvg_prem=Decimal("100.00"), cvg_iss_dt=dt.date(2010, 1, 1)))
        links += [dict(pol_num=pol, cli_num=owner, link_typ="O"), dict(pol_num=pol, cli_num=owner, link_typ="I")]
    # history of the hot owner before the month (counts in holdings, not in the cohort)
    for j in range(200):
        pol = f"H{j:04d}"
        policies.append(dict(pol_num=pol, pmt_mode=1, pol_iss_dt=dt.date(2015, 1, 1), frst_iss_dt=None,
                             pol_eff_dt=None, pol_stat_cd="1", wa_cd_1="W1", wa_cd_2=None, agt_code="A1"))
        coverages.append(dict(pol_num=pol, plan_code="B", vers_num="1", cvg_stat_cd="1", cvg_typ="B",
                              cvg_reasn="O", cvg_prem=Decimal("10.00"), cvg_iss_dt=dt.date(2015, 1, 1)))
        links.append(dict(pol_num=pol, cli_num="HOT", link_typ="O"))
    for owner in ["HOT"] + [f"C{i:04d}" for i in range(N_HOT, N_HOT + N_OTHER)]:
        customers.append(dict(cli_num=owner, cli_nm=owner, id_num=owner, cur_age=40, mthly_incm=Decimal(1000),
                              cli_typ="Individual"))
    agents = [dict(agt_code=a, agt_nm=a, stat_cd="01", comp_prvd_num="01", loc_code="L", can_num=a)
              for a in ("W1", "A1")]
    return make_roles(spark, policy=policies, coverage=coverages, links=links, customers=customers, agents=agents)


def test_hot_owner_whole_results(spark):
    t = _roles(spark)
    st = build_stages(t, P)
    cohort_n = st.cohort.count()
    assert cohort_n == N_HOT + N_OTHER                       # nothing dropped or capped
    first = {r.po_num: r.pol_num for r in st.first.select("po_num", "pol_num").collect()}
    assert len(first) == 1 + N_OTHER
    hot_dates = sorted((dt.date(2023, 2, 1 + (i * 7) % 28), f"P{i:04d}") for i in range(N_HOT))
    assert first["HOT"] == hot_dates[0][1]                    # min (issue date, policy)
    summ = {r.po_num: r for r in st.summary.collect()}
    assert summ["HOT"].pol_cnt == N_HOT + 200
    assert summ["HOT"]["10yr_pol_cnt"] == N_HOT + 0          # month policies' coverages date from 2010
    assert summ["HOT"].total_ape == Decimal(N_HOT * 100 + 200 * 10 * 12)
    assert st.final.count() == 1 + N_OTHER


def test_hot_owner_full_rank_matches_window(spark):
    t = _roles(spark)
    split = {(r.pol_num, r.purchase_order_base) for r in
             C.active_cohort(t, P, rank="split").select("pol_num", "purchase_order_base").collect()}
    window = {(r.pol_num, r.purchase_order_base) for r in
              C.active_cohort(t, P, rank="window").select("pol_num", "purchase_order_base").collect()}
    assert split == window and len(split) == N_HOT + N_OTHER
