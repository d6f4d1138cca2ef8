"""Plan-shape regressions: pushdown, pruning, broadcast of bounded sides, no cartesian joins."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import cohort as C
from cohortkit.operators import dims as D
from cohortkit.plans import registry
from cohortkit.plans.leads import build_stages
from cohortkit.session import remove_staged, staging_scope
from cohortkit.sources.fixtures import FIXTURE_PARAMS, build_fixture_tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def tables(spark):
    return build_fixture_tables(spark, SF, FIXTURE_PARAMS)


def test_cohort_month_filter_is_pushed_and_columns_pruned(tables):
    text = _formatted(C.active_cohort(tables, FIXTURE_PARAMS, rank=None, reuse=None))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    lineitem_schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema") and "l_orderkey" in ln]
    assert lineitem_schema and all("l_quantity" not in ln and "l_tax" not in ln for ln in lineitem_schema)


def test_cohort_joins_do_not_shuffle(spark, tables):
    """By the size checks alone: Spark's own threshold, under which these small tables lie, is off."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(C.active_cohort(tables, FIXTURE_PARAMS, rank=None))
        past = FIXTURE_PARAMS.with_(extra={"month_policy_max_rows": 0, "owner_link_max_rows": 0})
        shuffled = _plan(C.active_cohort(tables, past, rank=None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" in shuffled


def test_full_plan_has_no_cartesian_or_nested_loop_join(spark):
    plan = _plan(registry.queries()["publish_leads"](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_agent_dimension_cut_to_the_cohort(spark, tables):
    """The same rows as the whole dimension has for these agents; agents and scorecards are cut before any join."""
    some = tables.agents.where("CAST(agt_code AS BIGINT) % 3 = 0").select("agt_code")
    whole = D.agent_dimension(tables, FIXTURE_PARAMS)
    cut = D.agent_dimension(tables, FIXTURE_PARAMS, codes=some)
    same = whole.join(some, "agt_code", "left_semi").select(*cut.columns)
    assert 0 < cut.count() < whole.count()
    assert cut.exceptAll(same).count() == 0 and same.exceptAll(cut).count() == 0
    assert D.agent_dimension(tables, FIXTURE_PARAMS, codes=some.limit(0)).count() == 0
    with staging_scope() as made:
        for p in (FIXTURE_PARAMS, FIXTURE_PARAMS.with_(extra={"agent_max_rows": 0})):
            written = D.agent_dimension(tables, p, codes=some, reuse="table")
            assert written.exceptAll(same).count() == 0 and same.exceptAll(written).count() == 0
        remove_staged(spark, made)
    st = build_stages(tables, FIXTURE_PARAMS)
    codes = {r.sagt_cd for r in st.cohort.select("sagt_cd").distinct().collect()}
    assert {r.agt_code for r in st.agent_dim.select("agt_code").collect()} == codes
    st.close()


def test_leads_meet_the_agent_dimension_without_a_shuffle(spark, tables):
    """By the counted rows alone (Spark's own threshold is off): within the bound no join over the agent code or
    the candidates' numbers shuffles, past it they do, with the same leads."""
    def joins(st):
        plans = _plan(st.combined), _plan(D.agent_dimension(tables, st.params, codes=st.cohort.select(
            F.col("sagt_cd").alias("agt_code")).distinct(), reuse="table"))
        return [any("SortMergeJoin" in ln and key in ln and how in ln for ln in plan.splitlines())
                for plan, key, how in zip(plans, ("[sagt_cd", "[can_num"), ("Inner", "LeftSemi"), strict=True)]

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with staging_scope() as made:
            near = build_stages(tables, FIXTURE_PARAMS)
            past = build_stages(tables, FIXTURE_PARAMS.with_(extra={"agent_max_rows": 0}))
            assert joins(near) == [False, False]
            assert joins(past) == [True, True]
            assert near.combined.count() > 0
            assert near.combined.exceptAll(past.combined).count() == 0 and past.combined.exceptAll(near.combined).count() == 0
            near.close(), past.close()
        remove_staged(spark, made)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_without_staging_no_job_runs_while_the_plan_is_built(spark, tables):
    """reuse=None: no side is counted or written, so none is computed twice."""
    memo = C.agent_roles(tables, FIXTURE_PARAMS)  # the agent lookups are counted once for a set of tables
    group = "plan-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        st = build_stages(tables, FIXTURE_PARAMS, reuse=None)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
        assert st.staged == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert memo is C.agent_roles(tables, FIXTURE_PARAMS)


def test_the_cutoff_decides_the_contact_flag(spark):
    """Of the customers with a batch some are flagged and some not, in the query over batches of one month each."""
    rows = registry.queries()["flag_recent_contact_cutoff"](spark, SF).where("targeted").groupBy("in_onb_po").count().collect()
    assert {r.in_onb_po for r in rows} == {"Y", "N"} and min(r["count"] for r in rows) >= 20
