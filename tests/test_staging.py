"""Shared staging: refusal off a local master, scopes of their own, clean-up on failure, empty re-runs."""

import os
import threading
from types import SimpleNamespace

import pytest

from cohortkit.operators import publish as PB
from cohortkit.plans.leads import build_stages, run_month
from cohortkit.session import ensure_checkpoint_dir, remove_staged, staging_path, staging_scope
from cohortkit.sources.fixtures import SMOKE_PARAMS, build_fixture_tables

SMOKE = "/root/testdata/sf0.001"


def test_refused_without_a_shared_folder_off_a_local_master():
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_scopes_of_two_threads_keep_apart(spark):
    made, ready = {}, threading.Barrier(2)

    def run(name):
        with staging_scope() as own:
            staging_path(spark, name)
            ready.wait()
            staging_path(spark, name)
            made[name] = list(own)

    threads = [threading.Thread(target=run, args=(n,)) for n in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert all(len(v) == 2 and all(os.path.basename(p).startswith(k) for p in v) for k, v in made.items())


def test_stages_close_and_failed_runs_leave_nothing(spark, tmp_path, monkeypatch):
    t = build_fixture_tables(spark, SMOKE, SMOKE_PARAMS)
    stages = build_stages(t, SMOKE_PARAMS)
    assert stages.staged and all(os.path.isdir(p.removeprefix("file:")) for p in stages.staged)
    assert stages.close() > 0 and not stages.staged
    seen = []

    def fail(spark, leads, path, p):
        with staging_scope() as own:
            seen.extend(own)
        raise RuntimeError("publish")

    monkeypatch.setattr(PB, "publish", fail)
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(os.path.join(root, "staging")))
    with pytest.raises(RuntimeError):
        run_month(spark, t, SMOKE_PARAMS, str(tmp_path / "out"))
    assert set(os.listdir(os.path.join(root, "staging"))) == before


def test_empty_rerun_clears_its_month(spark, tmp_path):
    rows = spark.createDataFrame([("a", "202301"), ("b", "202302")], "po_num string, onb_mth_yr string")
    out = str(tmp_path / "leads")
    for key in ("202301", "202302"):
        PB.publish_month(rows, out, key)
    PB.publish_month(rows.where("false"), out, "202302")
    assert [tuple(r) for r in PB.read_published(spark, out).collect()] == [("a", "202301")]
    PB.publish_month(rows.where("false"), out, "202301")
    assert PB.read_published(spark, out).collect() == []
    assert remove_staged(spark, []) == 0


def test_totals_above_ten_to_the_twelfth_and_malformed_dates(spark):
    from decimal import Decimal

    from cohortkit.operators.cohort import holdings_summary
    from cohortkit.sources.tables import ROLE_COLUMNS, conform
    held = spark.createDataFrame([("o", f"p{i}", Decimal(10) ** 11, 1) for i in range(200)],
                                 "po_num string, pol_num string, inforce_ape decimal(18,6), inforce_year int")
    assert holdings_summary(held, SMOKE_PARAMS).first()["total_ape"] == Decimal(2) * Decimal(10) ** 13
    cols, dates = ROLE_COLUMNS["policy"]
    one = spark.createDataFrame([tuple(1 if c == "pmt_mode" else "not a date" if c in dates else "x" for c in cols)], list(cols))
    got = conform(one, "policy").first()
    assert all(got[c] is None for c in dates)
