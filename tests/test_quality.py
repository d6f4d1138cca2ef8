"""Ledger of dropped rows and one row for each dimension key."""

import datetime as dt
from decimal import Decimal

from cohortkit.operators.dims import agent_dimension, as_of
from cohortkit.operators.quality import DROP_REASONS, dropped_row_ledger
from cohortkit.params import RunParams
from tests.units import make_roles

P = RunParams(month_end=dt.date(2023, 2, 28), scorecard_month_end="2023-03-31", run_date=dt.date(2023, 4, 1))
IN, OUT = dt.date(2023, 2, 10), dt.date(2022, 2, 10)


def test_each_reason_once_and_all_rows_counted(spark):
    pol = lambda n, **k: dict(dict(pol_num=n, pmt_mode=12, pol_iss_dt=IN, pol_stat_cd="1", wa_cd_1="W", agt_code="A"), **k)
    policies = [pol("OUT", pol_iss_dt=OUT), pol("NULLDATE", pol_iss_dt=None), pol("LAPSED", pol_stat_cd="B"), pol("NOWA", wa_cd_1="X"),
                pol("NOSA", agt_code=None), pol("NOOWNER"), pol("NOINS"), pol("SECOND", pol_iss_dt=dt.date(2023, 2, 20)), pol("CORP"),
                pol("KEPT"), pol("KEPT", pol_stat_cd="9")]  # a repeated policy counts with its best row
    cov = lambda n, typ="B": dict(pol_num=n, plan_code="p", vers_num="1", cvg_typ=typ, cvg_reasn="O", cvg_prem=Decimal(1), cvg_iss_dt=IN)
    names = ["NONE", "OUT", "NULLDATE", "LAPSED", "NOWA", "NOSA", "NOOWNER", "NOINS", "SECOND", "CORP", "KEPT"]
    owner = {"SECOND": "C1", "KEPT": "C1", "CORP": "C2", "NOINS": "C3"}
    links = [dict(pol_num=n, cli_num=owner.get(n, "C9"), link_typ="O") for n in names if n != "NOOWNER"]
    links += [dict(pol_num=n, cli_num="C7", link_typ="I") for n in names if n != "NOINS"]
    t = make_roles(spark, policy=policies, coverage=[cov(n) for n in names] + [cov("KEPT", "R"), cov("KEPT", None), cov("KEPT")], links=links,
                   agents=[dict(agt_code=a, comp_prvd_num="01") for a in "WA"],
                   customers=[dict(cli_num="C1", cli_typ="Individual"), dict(cli_num="C2", cli_typ="Corporate")])
    got = {r.reason: r.coverages for r in dropped_row_ledger(t, P).collect()}
    assert got == {"no policy": 1, "issued outside the month": 2, "not in force": 1, "writing agent does not qualify": 1,
                   "servicing agent does not qualify": 1, "no owner": 1, "no insured": 1, "not the first contract of an owner": 1,
                   "not a base coverage": 2, "first owner is no individual customer": 1, "kept": 2}
    assert set(got) == set(DROP_REASONS) and sum(got.values()) == t.coverage.count()
    empty = make_roles(spark)
    assert dropped_row_ledger(empty, P).collect() == []


def test_as_of_picks_by_date_then_values(spark):
    rows = [("k", "2023-01", "a", 1), ("k", "2023-02", "b", None), ("k", "2023-02", "b", 2), ("k", "2023-03", "c", 3), ("z", None, "x", 1),
            (None, "2023-01", "n", 1)]
    df = spark.createDataFrame(rows, "key string, eff string, name string, n int")
    got = {r.key: tuple(r) for r in as_of(df, ["key"], "eff", "2023-02").collect()}
    assert got == {"k": ("k", "2023-02", "b", 2), None: (None, "2023-01", "n", 1)}
    every = {r.key: r.name for r in as_of(df.drop("eff"), ["key"]).collect()}
    assert every == {"k": "c", "z": "x", None: "n"}


def test_duplicate_dimension_rows_do_not_multiply_agents(spark):
    t = make_roles(spark, agents=[dict(agt_code="A", comp_prvd_num="01", loc_code="L", can_num="C")],
                   locations=[dict(loc_code="L", city=c, region="R") for c in ("one", "two")],
                   candidates=[dict(can_num="C", email_addr=e) for e in ("x@y", None)],
                   scorecard=[dict(agt_code="A", monthend_dt=m, agent_tier=x) for m, x in
                              (("2023-02-28", "old"), ("2023-03-31", "now"), ("2023-04-30", "later"))])
    assert agent_dimension(t, P).count() == 4
    one = agent_dimension(t, P, unique=True).collect()
    assert [(r.city, r.email_addr, r.agent_tier) for r in one] == [("two", "x@y", "now")]
