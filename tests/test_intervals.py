import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of


def test_times_are_half_open(spark, interval):
    times = spark.sql(
        "SELECT CAST(t AS TIMESTAMP) AS event_time FROM VALUES "
        "('2024-01-04 23:59:59.999999'), ('2024-01-05 00:00:00'), "
        "('2024-01-05 23:59:59'), ('2024-01-06 00:00:00'), (NULL) AS v(t)"
    )
    kept = times.filter(interval("2024-01-05", "2024-01-06").has_time())
    assert rows_of(kept, F.col("event_time").cast("string")) == [
        ("2024-01-05 00:00:00",),
        ("2024-01-05 23:59:59",),
    ]


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2024-01-05", "2024-01-07", ["2024-01-05", "2024-01-06"]),
        ("2024-01-05 06:00:00", "2024-01-05 18:00:00", []),
        ("2024-01-05 06:00:00", "2024-01-07 18:00:00", ["2024-01-05", "2024-01-06"]),
    ],
)
def test_dates_are_cut_from_both_bounds(spark, interval, start, end, days):
    dates = spark.sql(
        "SELECT explode(sequence(DATE'2024-01-03', DATE'2024-01-09')) AS event_date"
    )
    kept = dates.filter(interval(start, end).has_date())
    assert [str(d) for (d,) in rows_of(kept)] == days


@pytest.mark.parametrize(
    "end, last", [("2024-01-07", "2024-01-06"), ("2024-01-07 00:00:01", "2024-01-07")]
)
def test_days_that_may_hold_the_interval(spark, interval, end, last):
    dates = spark.sql(
        "SELECT explode(sequence(DATE'2024-01-03', DATE'2024-01-09')) AS event_date"
    )
    kept = rows_of(dates.filter(interval("2024-01-05 12:00:00", end).may_hold_day()))
    assert (str(kept[0][0]), str(kept[-1][0])) == ("2024-01-05", last)


def test_bad_bounds_raise(interval):
    with pytest.raises(ValueError, match="starts after"):
        interval("2024-01-06", "2024-01-05")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        interval("5th of January", "2024-01-05")
    assert interval("2024-01-05", "2024-01-05").start == "2024-01-05"
