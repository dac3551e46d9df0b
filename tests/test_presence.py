"""Presence features on hand fixtures (rules: last-n records, streak 0, weekday variance)."""
import datetime as dt

import pytest

from vigilo.operators import presence as A


def _rows(entity, flags, start=dt.date(2024, 1, 1)):
    return [(entity, start + dt.timedelta(days=i), f) for i, f in enumerate(flags)]


@pytest.fixture(scope="module")
def df(spark):
    rows = (_rows("never", [1] * 40) + _rows("always", [0] * 35) + _rows("short", [1, 0, 0, 1, 0])
            + _rows("mixed", [1, 0, 0, 0, 1, 1, 0, 0, 1] * 4)
            + [("oneday", dt.date(2024, 1, 1) + dt.timedelta(days=7 * i), i % 2) for i in range(6)])
    return spark.createDataFrame(rows, "id string, date date, is_present int")


def test_features(df):
    got = {r["id"]: r for r in A.presence_features(df).collect()}
    assert got["never"]["longest_absence_streak"] == 0          # never absent -> 0
    assert got["never"]["absence_in_last_30_days"] == 0
    assert got["always"]["longest_absence_streak"] == 35
    assert got["always"]["absence_in_last_30_days"] == 30       # last 30 records, not all 35
    assert got["short"]["absence_in_last_30_days"] == 3         # fewer than 30 -> all of them
    assert got["short"]["longest_absence_streak"] == 2
    assert got["mixed"]["longest_absence_streak"] == 3
    assert got["short"]["attendance_rate"] == pytest.approx(0.4)
    assert got["oneday"]["day_of_week_variance"] is None        # one weekday -> NULL (sample variance)


def test_weekday_variance_matches_pandas(df):
    import pandas as pd
    pdf = df.toPandas()
    pdf["wd"] = pd.to_datetime(pdf["date"]).dt.dayofweek
    want = pdf.groupby(["id", "wd"])["is_present"].mean().groupby("id").var()
    got = {r["id"]: r["day_of_week_variance"] for r in A.weekday_presence_variance(df).collect()}
    for k, v in want.items():
        if pd.isna(v):
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-15)


def test_standalone_operators_agree_with_combined(df):
    full = {r["id"]: r for r in A.presence_features(df, recent_n=10, recent_name="absence_in_last_n").collect()}
    for r in A.absences_in_last_n(df, 10).collect():
        assert r["absence_in_last_n"] == full[r["id"]]["absence_in_last_n"]
    for r in A.longest_absence_streak(df).collect():
        assert r["longest_absence_streak"] == full[r["id"]]["longest_absence_streak"]


def test_business_days_and_labels(spark, df):
    wk = A.business_days(df)
    assert all(r["date"].weekday() < 5 for r in wk.collect())
    dim = spark.createDataFrame([("never", "6A", 0), ("always", "7B", 1)], "id string, class string, is_anomaly int")
    out = A.attach_labels(A.presence_features(df), dim)
    assert set(out.columns) == {"id", "attendance_rate", "longest_absence_streak", "absence_in_last_30_days",
                                "day_of_week_variance", "is_anomaly"}  # class does not leak
    assert out.count() == 2                                              # inner join
