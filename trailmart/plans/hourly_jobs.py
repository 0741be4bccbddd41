"""Jobs that count traffic by hour and put days together from the hours."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trailmart.functions.intervals import Interval
from trailmart.operators import hourly
from trailmart.plans.compaction import finish_interrupted
from trailmart.schema import DAILY_TRAFFIC, HOURLY_COUNTS, HOURLY_IDS, ID_NUMBERS
from trailmart.session import fresh_path, remove, use_utc
from trailmart.sources.tables import (
    DATAFRAME_SUFFIX,
    DEFAULT_SCHEMA,
    append_by_name,
    create_table,
    read_events,
    read_table,
    table_name,
)

LAYOUTS = (ID_NUMBERS, HOURLY_COUNTS, HOURLY_IDS)


def create_hourly_tables(spark: SparkSession, schema: str = DEFAULT_SCHEMA) -> None:
    for layout in LAYOUTS:
        create_table(spark, table_name(layout, schema), layout)


def add_hourly_traffic(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    """Count the interval's events by hour; new ids are numbered after the known ones.

    An interval may be an hour or less. Run again, it adds the counts again, as the other
    appending jobs do; distinct ids stay exact. One run at a time numbers ids.
    """
    interval = Interval.between(use_utc(spark), data_interval_start, data_interval_end)
    finish_interrupted(spark, schema, interval)
    events = read_events(spark, schema, interval)
    names = [table_name(layout, schema) for layout in LAYOUTS]
    path = fresh_path(spark, "hourly-ids")
    try:
        hourly.hourly_ids(events, interval).write.parquet(f"{path}/met")
        met = spark.read.parquet(f"{path}/met")
        known = read_table(spark, names[0], ID_NUMBERS)
        hourly.unnumbered(met, known).write.parquet(f"{path}/new")
        new = spark.read.parquet(f"{path}/new")
        append_by_name(hourly.numbered(new, known), names[0], ID_NUMBERS)
        numbers = read_table(spark, names[0], ID_NUMBERS)
        append_by_name(hourly.hourly_bitmaps(met, numbers), names[2], HOURLY_IDS)
    finally:
        remove(spark, path)
    append_by_name(hourly.hourly_counts(events, interval), names[1], HOURLY_COUNTS)


def build_daily_traffic_from_hours(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    """Append the daily summary of the interval's days, made of their hours alone."""
    interval = Interval.between(use_utc(spark), data_interval_start, data_interval_end)
    counts, ids = (
        read_table(spark, table_name(layout, schema), layout) for layout in LAYOUTS[1:]
    )
    daily = hourly.daily_from_hours(counts, ids, interval)
    append_by_name(daily, table_name(DAILY_TRAFFIC, schema, DATAFRAME_SUFFIX), DAILY_TRAFFIC)
