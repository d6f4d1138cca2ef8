"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no driver collect),
after one warm-up of the whole plan; the reported time per query is the
median of ``$BENCH_REPEAT`` runs (default 3).  The full monthly job (build,
month-partitioned write, count) is timed the same way.  Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit.plans import registry  # noqa: E402
from cohortkit.plans.leads import run_month  # noqa: E402
from cohortkit.session import local_session, staging_path  # noqa: E402
from cohortkit.sources.fixtures import FIXTURE_PARAMS, build_fixture_tables  # noqa: E402

HEADLINE = [
    "cohort_active",          # Step 1 with the split dense rank
    "holdings_all",           # Step 2
    "agg_holdings",           # holdings aggregate
    "dim_agent",              # Step 3
    "profile_customer",       # Step 4
    "agg_collect_party_ids",  # Step 5
    "combine_profile",        # Step 6
    "stage_tagged_leads",     # Step 7
    "score_final_segment",    # Step 8
    "publish_leads",          # Step 9, in place
    "publish_leads_rejoin",   # Step 9, original self-join
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _window_io(log_dir: str, start_ms: float, end_ms: float) -> dict:
    """Input rows and shuffle bytes of every stage submitted inside a time window (event log)."""
    events = []
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isfile(path):
            with open(path) as fh:
                events.extend(json.loads(line) for line in fh if line.startswith("{"))
    stages = set()
    for e in events:
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if start_ms <= info.get("Submission Time", -1) <= end_ms:
                stages.add((info["Stage ID"], info.get("Stage Attempt ID", 0)))
    written = records_in = shuffled_read = 0
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and (e.get("Stage ID"), e.get("Stage Attempt ID", 0)) in stages:
            m = e.get("Task Metrics") or {}
            written += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            sr = m.get("Shuffle Read Metrics") or {}
            shuffled_read += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            # (local Parquet scans report only footer bytes, so rows are counted instead)
            records_in += (m.get("Input Metrics") or {}).get("Records Read", 0)
    return {"stages": len(stages), "input_records": records_in, "shuffle_write_bytes": written,
            "shuffle_read_bytes": shuffled_read}


def _plan_shape(df) -> dict:
    """Operator counts of the initial physical plan (joins by type, exchanges, scans)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    count = lambda token: sum(line.count(token) for line in plan.splitlines())
    return {
        "file_scans": count("FileScan"),
        "broadcast_hash_joins": count("BroadcastHashJoin"),
        "sort_merge_joins": count("SortMergeJoin"),
        "shuffle_exchanges": count("Exchange hashpartitioning") + count("Exchange rangepartitioning")
        + count("Exchange SinglePartition"),
        "cartesian_or_nested_loop": count("CartesianProduct") + count("BroadcastNestedLoopJoin"),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    log_dir = tempfile.mkdtemp(prefix="cohortkit-eventlog-")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="cohortkit-bench",
                          extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                      "spark.eventLog.compress": "false",
                                      "spark.eventLog.rolling.enabled": "false"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortkit-bench-"))
    qs = registry.queries()

    # warm-up: JVM, code paths and file metadata
    warm = qs["publish_leads"](spark, sf_dir)
    _run(warm)
    plan = _plan_shape(warm)

    timings: dict[str, float] = {}
    for key in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            _run(qs[key](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(runs), 3)

    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        tables = build_fixture_tables(spark, sf_dir, FIXTURE_PARAMS)
        n = run_month(spark, tables, FIXTURE_PARAMS, staging_path(spark, "bench_leads"))
        runs.append(time.perf_counter() - t0)
    timings["run_month_job"] = round(statistics.median(runs), 3)

    # one more run, alone, for its I/O volume (read back from the event log)
    t_start = time.time() * 1000
    tables = build_fixture_tables(spark, sf_dir, FIXTURE_PARAMS)
    run_month(spark, tables, FIXTURE_PARAMS, staging_path(spark, "bench_leads_io"))
    t_end = time.time() * 1000

    sf = os.path.basename(sf_dir).replace("sf", "")
    spark.stop()
    io = _window_io(log_dir, t_start, t_end)
    print(json.dumps({
        "metric": "median wall time per headline query (sum over queries)",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "rows_published": n,
        "run_month_io": io,
        "publish_leads_plan": plan,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
