"""Unit rows for the rule tables: every band edge ±1, NULLs, tiers, segments."""

import datetime as dt
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from cohortkit.functions import rulebook as R
from cohortkit.functions import tiers as T
from cohortkit.functions.rules import any_flag, classify, first_reason, least_in, yn


def _one_col(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField("v", dtype)]))


def _apply(spark, values, dtype, expr):
    df = _one_col(spark, values, dtype).select("v", expr(F.col("v")).alias("out"))
    return {r.v: r.out for r in df.collect()}


def test_classify_first_match_and_null_condition(spark):
    df = _one_col(spark, [1, 5, None], IntegerType())
    out = df.select("v", classify([(F.col("v") > 0, "pos"), (F.col("v") > 3, "big")], "other").alias("o"))
    got = {r.v: r.o for r in out.collect()}
    assert got == {1: "pos", 5: "pos", None: "other"}


def test_yn_null_is_no(spark):
    got = _apply(spark, [1, 0, None], IntegerType(), lambda c: yn(c == 1))
    assert got == {1: "Y", 0: "N", None: "N"}


def test_age_band_edges(spark):
    ages = [17, 18, 25, 26, 35, 36, 45, 46, 55, 56, 65, 66, None]
    got = _apply(spark, ages, IntegerType(), T.age_band)
    assert got == {17: "1. <18", 18: "2. 18-25", 25: "2. 18-25", 26: "3. 26-35", 35: "3. 26-35",
                   36: "4. 36-45", 45: "4. 36-45", 46: "5. 46-55", 55: "5. 46-55", 56: "6. 56-65",
                   65: "6. 56-65", 66: "7. >65", None: "Unknown"}


def test_age_band_fraction_between_bands_is_unknown(spark):
    got = _apply(spark, [Decimal("25.5")], DecimalType(5, 1), T.age_band)
    assert got[Decimal("25.5")] == "Unknown"


INCOMES = [-1, 0, 1, 19999, 20000, 39999, 40000, 59999, 60000, 79999, 80000, None]


def test_income_band_lowest_band_is_strictly_positive(spark):
    got = _apply(spark, [None if v is None else Decimal(v) for v in INCOMES], DecimalType(18, 2), T.income_band)
    exp = {-1: "6) Unknown", 0: "6) Unknown", 1: "1) < 20M", 19999: "1) < 20M", 20000: "2) 20-40M",
           39999: "2) 20-40M", 40000: "3) 40-60M", 59999: "3) 40-60M", 60000: "4) 60-80M",
           79999: "4) 60-80M", 80000: "5) 80M+", None: "6) Unknown"}
    assert {None if k is None else int(k): v for k, v in got.items()} == exp


def test_premium_band_lowest_band_is_open_below(spark):
    got = _apply(spark, [None if v is None else Decimal(v) for v in INCOMES], DecimalType(18, 2), T.premium_band)
    got = {None if k is None else int(k): v for k, v in got.items()}
    assert got[-1] == "1) < 20M" and got[0] == "1) < 20M" and got[19999] == "1) < 20M"
    assert got[20000] == "2) 20-40M" and got[80000] == "5) 80M+" and got[None] == "6) Unknown"


def test_policy_count_band(spark):
    got = _apply(spark, [0, 1, 2, 3, 5, 6, None], LongType(), T.policy_count_band)
    assert got == {0: "NA", 1: "1", 2: "2", 3: "3-5", 5: "3-5", 6: ">5", None: "NA"}


def _tier_rows(spark, fn):
    totals = [14999, 15000, 19999, 20000, 54999, 55000, 59999, 60000, 64999, 65000, 149999, 150000,
              299999, 300000]
    rows = [(Decimal(t), n) for t, n in product(totals, (0, 1))]
    df = spark.createDataFrame(rows, "total decimal(18,6), n long")
    return {(int(r.total), r.n): r.out for r in df.select("total", "n", fn("total", "n").alias("out")).collect()}


def test_value_tier_edges(spark):
    got = _tier_rows(spark, T.value_tier)
    assert got[(19999, 1)] == "Not VIP"
    assert got[(20000, 0)] == "Not VIP" and got[(20000, 1)] == "Silver"
    assert got[(64999, 1)] == "Silver" and got[(64999, 0)] == "Not VIP"
    assert got[(65000, 0)] == "Gold" and got[(149999, 0)] == "Gold"
    assert got[(150000, 0)] == "Platinum" and got[(299999, 1)] == "Platinum"
    assert got[(300000, 0)] == "Platinum Elite"


def test_near_tier_edges(spark):
    got = _tier_rows(spark, T.near_tier)
    assert got[(14999, 1)] == "Not Near VIP"
    assert got[(15000, 1)] == "Near Silver" and got[(15000, 0)] == "Not Near VIP"
    assert got[(19999, 1)] == "Near Silver" and got[(20000, 1)] == "Not Near VIP"
    assert got[(54999, 0)] == "Not Near VIP" and got[(55000, 0)] == "Near Gold1"
    assert got[(59999, 0)] == "Near Gold1" and got[(60000, 0)] == "Near Gold2"
    assert got[(64999, 0)] == "Near Gold2" and got[(65000, 0)] == "Not Near VIP"


def test_lead_segment_near_vs_silver(spark):
    rows = [("Near Gold1", "Silver", "Existing", 0), ("Near Gold1", "Not VIP", "Existing", 0),
            ("Not Near VIP", "Gold", "New", 50000), ("Not Near VIP", "Not VIP", "New", 20000),
            ("Not Near VIP", "Not VIP", "New", 19999), ("Not Near VIP", "Not VIP", "Existing", 90000),
            (None, None, None, None)]
    df = spark.createDataFrame(rows, "near string, vip string, ct string, inc int")
    got = [r.o for r in df.select(T.lead_segment("near", "vip", "ct", "inc").alias("o")).collect()]
    assert got == ["VIP", "Near VIP", "VIP", "New", "Others", "Others", "Others"]


def test_city_category(spark):
    got = _apply(spark, ["Hà Nội", "Hồ Chí Minh", "Đà Nẵng", None], StringType(), T.city_category)
    assert got == {"Hà Nội": "Hà Nội", "Hồ Chí Minh": "Hồ Chí Minh", "Đà Nẵng": "Others", None: "Unknown"}


def test_status_decode(spark):
    got = _apply(spark, ["01", "99", "05", None], StringType(), T.status_decode)
    assert got == {"01": "Active", "99": "Terminated", "05": "Unknown", None: "Unknown"}


def test_new_or_existing_window_for_february(spark):
    start, end = dt.date(2022, 8, 1), dt.date(2023, 2, 28)
    days = [dt.date(2022, 7, 31), start, end, dt.date(2023, 3, 1), None]
    got = _apply(spark, days, DateType(), lambda c: T.new_or_existing(c, start, end))
    assert got == {dt.date(2022, 7, 31): "Existing", start: "New", end: "New",
                   dt.date(2023, 3, 1): "Existing", None: "Existing"}


def test_agent_relationship_every_branch(spark):
    rows = [
        ("01", dt.date(2020, 1, 1), "A", "A", None),   # terminated, channel 01 → Orphaned
        ("01", None, "A", "A", None),                  # writing agent 1 → Original
        ("01", None, "A", "B", "A"),                   # writing agent 2 → Original
        ("01", None, "A", "B", None),                  # NULL second agent → Reassigned
        ("04", None, "A", "B", None),
        ("97", None, "A", "B", None),
        ("98", None, "A", "B", None),
        ("02", None, "A", "B", None),
        ("02", dt.date(2020, 1, 1), "A", "B", None),   # terminated outside the list → Unknown
    ]
    df = spark.createDataFrame(rows, "ch string, trmn date, sagt string, wa1 string, wa2 string")
    got = [r.o for r in df.select(T.agent_relationship("ch", "trmn", "sagt", "wa1", "wa2").alias("o")).collect()]
    assert got == ["Orphaned", "Original Agent", "Original Agent", "Reassigned Agent", "Orphaned-Collector",
                   "Orphaned-Agent is SM", "Orphaned-Agent is SM", "Unknown", "Unknown"]


def test_exclusion_all_64_combinations(spark):
    flags = list(R.EXCLUSION_FLAGS)
    rows = [tuple("Y" if b else "N" for b in bits) for bits in product((0, 1), repeat=len(flags))]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in flags))
    out = df.select(*flags, any_flag(flags).alias("excluded"),
                    first_reason(R.EXCLUSION_REASONS, R.NOT_EXCLUDED).alias("grp")).collect()
    assert len(out) == 64
    for r in out:
        ys = [f for f in flags if r[f] == "Y"]
        assert r.excluded == ("Y" if ys else "N")
        expected = next((label for f, label in R.EXCLUSION_REASONS if r[f] == "Y"), R.NOT_EXCLUDED)
        assert r.grp == expected
        assert (r.excluded == "N") == (r.grp == R.NOT_EXCLUDED)


@pytest.mark.parametrize("vals,top2,top3", [
    ((None, None, None, None, None), 0, 0),
    ((None, 2, 9, 9, 9), 1, 1),      # one NULL with a hit
    ((None, 5, 9, 9, 9), 0, 0),      # one NULL without
    ((1, 9, 9, 9, 9), 1, 1),
    ((2, 9, 9, 9, 9), 1, 1),
    ((3, 9, 9, 9, 9), 0, 1),
    ((4, 9, 9, 9, 9), 0, 0),
])
def test_least_decile_skips_nulls(spark, vals, top2, top3):
    cols = list(R.EXISTING_HIT_DECILES)
    df = spark.createDataFrame([vals], ", ".join(f"{c} int" for c in cols))
    r = df.select(F.when(least_in(cols, 1, 2), 1).otherwise(0).alias("t2"),
                  F.when(least_in(cols, 1, 3), 1).otherwise(0).alias("t3")).first()
    assert (r.t2, r.t3) == (top2, top3)


def test_final_and_publish_segments(spark):
    rows = [
        # near, vip, cus_type, need_key, new_key, ci, inv, lt, lp, med, n_ci, n_inv, n_lt
        ("Not Near VIP", "Not VIP", "Existing", 1, None, 2, 9, 9, 9, 9, None, None, None),
        ("Not Near VIP", "Not VIP", "New", None, 1, None, None, None, None, None, 3, 9, 9),
        ("Not Near VIP", "Not VIP", "Existing", 1, None, None, 9, 9, 9, 9, None, None, None),
        ("Not Near VIP", "Not VIP", "New", None, 1, None, None, None, None, None, None, 9, 9),
        ("Not Near VIP", "Not VIP", "Existing", None, None, None, None, None, None, None, None, None, None),
        ("Near Gold2", "Not VIP", "Existing", 1, None, 1, 1, 1, 1, 1, None, None, None),
    ]
    schema = ("near string, vip string, ct string, nk int, wk int, decile_ci int, decile_inv int, "
              "decile_lt int, decile_lp int, decile_med int, ci_decile int, invst_decile int, lt_decile int")
    df = spark.createDataFrame(rows, schema)
    got = [r.o for r in df.select(T.final_lead_segment("near", "vip", "ct", "nk", "wk").alias("o")).collect()]
    assert got == ["High Propensity", "New", "Unknown", "Unknown", "Others", "Near VIP"]
    seg = spark.createDataFrame([("VIP", "Existing", 0, 0), ("Others", "Existing", 1, 0),
                                 ("Others", "New", 0, 1), ("Others", "Existing", None, 0),
                                 ("Others", "New", 0, None), ("Others", None, 1, 1)],
                                "s string, ct string, t2 int, hr int")
    got = [r.o for r in seg.select(T.publish_segment("s", "ct", "t2", "hr").alias("o")).collect()]
    assert got == ["VIP", "High Propensity", "New", "Unknown", "Unknown", "Others"]
