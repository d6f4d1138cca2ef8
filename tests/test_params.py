import datetime as dt

from cohortkit.params import RunParams, add_months, last_day


def test_add_months_clamps_and_does_not_snap():
    assert add_months(dt.date(2023, 2, 28), 2) == dt.date(2023, 4, 28)
    assert add_months(dt.date(2023, 1, 31), 1) == dt.date(2023, 2, 28)
    assert add_months(dt.date(2024, 1, 31), 1) == dt.date(2024, 2, 29)
    assert add_months(dt.date(2023, 3, 31), -1) == dt.date(2023, 2, 28)
    assert add_months(dt.date(1998, 12, 31), 2) == dt.date(1999, 2, 28)


def test_derived_windows_of_a_february_month():
    p = RunParams(month_end=dt.date(2023, 2, 28), run_date=dt.date(2023, 4, 1))
    assert p.month_key == "202302"
    assert p.month_start == dt.date(2023, 2, 1)
    assert p.next_month_start == dt.date(2023, 3, 1)
    assert p.new_window_start == dt.date(2022, 8, 1)
    assert p.repurchase_end == dt.date(2023, 4, 28)
    assert p.with_(snap_month_end=True).repurchase_end == dt.date(2023, 4, 30)
    assert p.recency_cutoff == dt.date(2022, 12, 31)


def test_recency_cutoff_of_fixture_run_date():
    p = RunParams(run_date="2024-02-15")
    assert p.recency_cutoff == dt.date(2023, 10, 31)


def test_leap_and_month_ends():
    for me in (dt.date(2024, 2, 29), dt.date(2023, 3, 31), dt.date(1998, 12, 31)):
        p = RunParams(month_end=me)
        assert last_day(p.month_start) == me
        assert p.month_key == me.strftime("%Y%m")
