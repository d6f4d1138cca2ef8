"""Bucketed storage and the shuffle path: past every bound, no side of the policy-keyed tables is exchanged."""

import os
import uuid

import pytest

from cohortkit.operators import cohort as C
from cohortkit.plans.leads import build_stages
from cohortkit.session import staging_path
from cohortkit.sources.bucketed import with_bucketed, write_bucketed
from cohortkit.sources.fixtures import FIXTURE_PARAMS, build_fixture_tables
from cohortkit.sources.tables import RoleTables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
PAST_BOUNDS = FIXTURE_PARAMS.with_(extra={"month_policy_max_rows": 0, "holding_policy_max_rows": 0, "owner_link_max_rows": 0})


@pytest.fixture(scope="module")
def plain(spark):
    return build_fixture_tables(spark, SF, FIXTURE_PARAMS)


@pytest.fixture(scope="module")
def bucketed(spark, plain):
    prefix = f"t_{uuid.uuid4().hex[:8]}"
    write_bucketed(plain, prefix, 8, staging_path(spark, prefix))
    return with_bucketed(spark, plain, prefix)


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def nodes(node):
    yield node
    if node.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(node.initialPlan())
    for i in range(node.children().size()):
        yield from nodes(node.children().apply(i))


def scans_below_exchanges(df):
    """Tables whose scan lies below a shuffle."""
    found = set()
    for n in nodes(df._jdf.queryExecution().executedPlan()):
        if n.nodeName() == "Exchange":
            found |= {m.simpleString(1000) for m in nodes(n) if m.nodeName().startswith("Scan")}
    return found


def sort_merge_joins(df):
    return sum(n.nodeName() == "SortMergeJoin" for n in nodes(df._jdf.queryExecution().executedPlan()))


def test_cohort_and_history_joins_exchange_no_large_table(spark, bucketed, no_auto_broadcast):
    base, insureds = C.cohort_base(bucketed, PAST_BOUNDS, reuse=None, insured_only=False)
    cohort = C.with_insured(base, insureds)
    assert sort_merge_joins(cohort) >= 4
    scanned = " ".join(n.simpleString(1000) for n in nodes(cohort._jdf.queryExecution().executedPlan()))
    assert all(f"_{role}" in scanned for role in ("coverage", "policy", "links")) and "Bucketed: true" in scanned
    assert not [s for s in scans_below_exchanges(cohort) if "t_" in s]
    history = C.policy_history(bucketed, PAST_BOUNDS)
    hold = C.holdings(bucketed, PAST_BOUNDS, None, history=history)
    assert sort_merge_joins(hold) >= 2
    assert not [s for s in scans_below_exchanges(hold) if "t_" in s]


def test_unbucketed_tables_are_exchanged_there(spark, plain, no_auto_broadcast):
    """The check above can fail: the same plan over plain files shuffles them."""
    cohort = C.with_insured(*C.cohort_base(plain, PAST_BOUNDS, reuse=None, insured_only=False))
    assert scans_below_exchanges(cohort)


def test_results_are_equal_past_all_bounds(spark, plain, bucketed, no_auto_broadcast):
    want = build_stages(plain, FIXTURE_PARAMS).leads
    got = build_stages(bucketed, PAST_BOUNDS).leads
    assert want.count() == got.count() > 0
    assert want.exceptAll(got).count() == 0


def test_each_large_table_is_scanned_once_or_twice(spark, plain):
    """The policy table serves the month and the history; coverage the cohort and the holdings."""
    uses = {}

    class Counting(RoleTables):
        def __getattribute__(self, name):
            if name in RoleTables.role_names():
                uses[name] = uses.get(name, 0) + 1
            return super().__getattribute__(name)

    t = Counting(**{r: getattr(plain, r) for r in RoleTables.role_names()})
    stages = build_stages(t, FIXTURE_PARAMS)
    scans = uses["policy"] - 1  # one use is for its session
    assert scans <= 2 and uses["coverage"] == 2
    assert stages.leads.count() == build_stages(plain, FIXTURE_PARAMS).leads.count()
    stages.close()
