from tidemark.operators import profile
from tidemark.sources import schemas

from .test_feeds import cal_row


def test_duplicate_dates(spark):
    df = spark.createDataFrame([cal_row("2011-01-29"), cal_row("2011-01-29"), cal_row("2011-01-30")],
                               schemas.CALENDAR_SCHEMA)
    assert profile.duplicate_dates(df).first()["duplicate_dates"] == 1
    nulls = spark.createDataFrame([cal_row(None), cal_row(None), cal_row("2011-01-30")], schemas.CALENDAR_SCHEMA)
    assert profile.duplicate_dates(nulls).first()["duplicate_dates"] == 1


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([cal_row("2011-01-29"), cal_row("2011-01-30")], schemas.CALENDAR_SCHEMA)
    rows = {(r["a"], r["b"]): r["r"] for r in profile.feature_correlations(df).collect()}
    assert rows[("snap_CA", "snap_TX")] is None and rows[("month", "month")] is None


def test_null_group_dropped(spark):
    df = spark.createDataFrame([cal_row("2011-01-29", 1), cal_row("2011-01-30", None)], schemas.CALENDAR_SCHEMA)
    assert [r["wday"] for r in profile.frequency(df, "wday").collect()] == [1]


def test_missing_dates_and_span(spark):
    df = spark.createDataFrame([cal_row("2011-01-29"), cal_row("2011-02-02")], schemas.CALENDAR_SCHEMA)
    assert profile.missing_dates(df).count() == 3
    assert profile.date_span(df).first()["total_days"] == 4


def test_holiday_patterns_substring(spark):
    df = spark.createDataFrame(
        [cal_row("2011-12-31", n2="NewYearsEve"), cal_row("2012-01-01", n1="NewYear"), cal_row("2011-12-25", n1="Christmas")],
        schemas.CALENDAR_SCHEMA)
    rows = {r["holiday"]: r["count"] for r in profile.holiday_impact(df).collect()}
    assert rows == {"NewYear": 2, "Christmas": 1}


def test_crosstab_zero_filled(spark):
    df = spark.createDataFrame([cal_row("2011-01-29", 1)], schemas.CALENDAR_SCHEMA)
    r = profile.month_wday_crosstab(df).first()
    assert (r["wday_1"], r["wday_2"], r["wday_7"]) == (1, 0, 0)
