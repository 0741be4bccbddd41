"""Distinct counts put together from hours, against counts of the days' events."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import event, rows_of
from trailmart.operators import hourly
from trailmart.operators.summaries import daily_traffic
from trailmart.plans import hourly_jobs
from trailmart.schema import DAILY_TRAFFIC, EVENTS, ID_NUMBERS
from trailmart.sources.tables import (
    DATAFRAME_SUFFIX,
    read_events,
    read_table,
    store_events,
    table_name,
)

WEEK = ("2024-01-05", "2024-01-12")
NONE = "kind STRING, id STRING, number BIGINT"


def numbers_of(spark, *ids, known=None):
    known = spark.createDataFrame([], NONE) if known is None else known
    new = spark.createDataFrame([("unique_users", i) for i in ids], "kind STRING, id STRING")
    return hourly.numbered(hourly.unnumbered(new, known), known)


def test_numbers_are_dense_and_go_on(spark, monkeypatch):
    monkeypatch.setattr(hourly, "STRETCHES", 7)
    first = numbers_of(spark, *(f"u{n}" for n in range(100)), "u5", "u5")
    assert sorted(r.number for r in first.collect()) == list(range(100))
    more = numbers_of(spark, *(f"u{n}" for n in range(90, 130)), known=first)
    assert sorted(r.number for r in more.collect()) == list(range(100, 130))
    assert {r.id for r in more.collect()} == {f"u{n}" for n in range(100, 130)}
    assert numbers_of(spark).collect() == []


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(5, 7), st.integers(0, 23), st.sampled_from("abcde"), st.booleans()),
        max_size=30,
    )
)
def test_days_equal_those_of_events(spark, events_of, interval, rows):
    events = events_of(
        *[
            event(
                event_time=f"2024-01-{d:02} {h:02}:10:00",
                user_id=u if known else None,
                session_id=f"s{u}{h % 3}",
            )
            for d, h, u, known in rows
        ]
    )
    week = interval(*WEEK)
    ids = hourly.hourly_ids(events, week)
    none = spark.createDataFrame([], NONE)
    numbers = hourly.numbered(hourly.unnumbered(ids, none), none)
    found = hourly.daily_from_hours(
        hourly.hourly_counts(events, week), hourly.hourly_bitmaps(ids, numbers), week
    )
    assert found.columns == daily_traffic(events, week).columns
    assert rows_of(found) == rows_of(daily_traffic(events, week))


def test_many_ids_take_several_bitmaps(spark, interval):
    times = F.timestamp_seconds(F.lit(1_704_448_800) + F.col("id") % 7_200)
    events = spark.range(70_000).select(
        times.alias("event_time"),
        F.concat(F.lit("u"), F.col("id") % 66_000).alias("user_id"),
        F.lit("s").alias("session_id"),
        F.lit("search").alias("event_type"),
    )
    ids = hourly.hourly_ids(events, interval(*WEEK))
    none = spark.createDataFrame([], NONE)
    numbers = hourly.numbered(hourly.unnumbered(ids, none), none)
    bitmaps = hourly.hourly_bitmaps(ids, numbers)
    assert bitmaps.filter("kind = 'unique_users'").select("bucket").distinct().count() == 4
    row = hourly.daily_from_hours(
        hourly.hourly_counts(events, interval(*WEEK)), bitmaps, interval(*WEEK)
    ).first()
    assert (row.total_events, row.unique_users, row.unique_sessions) == (70_000, 66_000, 1)


@pytest.fixture
def stored(spark, schema, events_of):
    rows = [
        event(event_id=f"{d}{h}", event_time=f"2024-01-{d:02} {h:02}:00:00", user_id=f"u{h % 5}")
        for d in (5, 6)
        for h in range(12)
    ]
    stamped = events_of(*rows).withColumn("ingestion_time", F.current_timestamp())
    store_events(stamped, table_name(EVENTS, schema), "b1")
    hourly_jobs.create_hourly_tables(spark, schema)
    return schema


def test_hours_are_added_run_by_run(spark, stored, interval):
    name = table_name(DAILY_TRAFFIC, stored, DATAFRAME_SUFFIX)
    cuts = ("2024-01-05", "2024-01-05 07:00:00", "2024-01-05 07:30:00", "2024-01-06", "2024-01-07")
    for start, end in zip(cuts, cuts[1:]):
        hourly_jobs.add_hourly_traffic(spark, start, end, stored)
    numbers = read_table(spark, table_name(ID_NUMBERS, stored), ID_NUMBERS)
    assert rows_of(numbers.filter("kind = 'unique_users'"), "number") == [(n,) for n in range(5)]
    hourly_jobs.build_daily_traffic_from_hours(spark, *WEEK, stored)
    want = daily_traffic(read_events(spark, stored), interval(*WEEK))
    assert rows_of(read_table(spark, name, DAILY_TRAFFIC)) == rows_of(want)


def test_an_interval_run_again_adds_its_events_but_no_ids(spark, stored):
    for _ in range(2):
        hourly_jobs.add_hourly_traffic(spark, *WEEK, stored)
    hourly_jobs.build_daily_traffic_from_hours(spark, *WEEK, stored)
    name = table_name(DAILY_TRAFFIC, stored, DATAFRAME_SUFFIX)
    rows = read_table(spark, name, DAILY_TRAFFIC).collect()
    assert [(r.total_events, r.unique_users) for r in rows] == [(24, 5)] * 2
