"""Traffic by hour whose distinct counts add up, exactly, to those of a day.

Users and sessions get dense numbers, and an hour holds the numbers it met as bitmaps: a row for
each stretch of numbers, one bit a number. The bitmaps of several hours, or of several loads of
one hour, are merged by a bitwise or; the bits that are set are the distinct ids. Numbers are
given once and never change, so parts of different loads go together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.functions.metrics import count_of
from trailmart.operators.summaries import events_in_interval
from trailmart.schema import EVENT_TYPES

#: The distinct counts of a day, and the column that each counts.
KINDS = {"unique_users": "user_id", "unique_sessions": "session_id"}
#: Stretches that ids are dealt into by a hash to be numbered side by side.
STRETCHES = 4_096


def _hour() -> list[Column]:
    time = F.col("event_time")
    return [time.cast("date").alias("event_date"), F.hour(time).alias("hour")]


def hourly_counts(events: DataFrame, interval: Interval) -> DataFrame:
    """(event_date, hour, total_events, a count for each type), which add up as they are."""
    return (
        events_in_interval(events, interval)
        .groupBy(*_hour())
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            *[count_of(name).alias(f"{name}_count") for name in EVENT_TYPES],
        )
    )


def hourly_ids(events: DataFrame, interval: Interval) -> DataFrame:
    """(event_date, hour, kind, id) of the distinct ids that each hour met."""
    kinds = [
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id"))
        for kind, column in KINDS.items()
    ]
    met = events_in_interval(events, interval).select(*_hour(), F.inline(F.array(*kinds)))
    return met.filter(F.col("id").isNotNull()).distinct()


def unnumbered(ids: DataFrame, numbers: DataFrame) -> DataFrame:
    """(kind, id) of the ids that have no number yet."""
    return ids.select("kind", "id").distinct().join(numbers, ["kind", "id"], "left_anti")


def numbered(ids: DataFrame, numbers: DataFrame) -> DataFrame:
    """(kind, id, number) for distinct new (kind, id) rows, going on after the given numbers.

    Ids are dealt into stretches by their hash and numbered within them; only the stretches'
    sizes are summed up in one place. ``ids`` is read twice and has to be stored.
    """
    stretch = F.pmod(F.xxhash64("id"), F.lit(STRETCHES)).alias("stretch")
    dealt = ids.select("kind", "id", stretch)
    place = F.row_number().over(Window.partitionBy("kind", "stretch").orderBy("id"))
    before = Window.partitionBy("kind").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = dealt.groupBy("kind", "stretch").agg(F.count("*").alias("size"))
    starts = sizes.select(
        "kind", "stretch", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    given = numbers.groupBy("kind").agg((F.max("number") + 1).alias("given"))
    opened = starts.join(given, "kind", "left")
    placed = dealt.withColumn("place", place).join(opened, ["kind", "stretch"])
    number = F.coalesce("given", F.lit(0)) + F.col("start") + F.col("place") - 1
    return placed.select("kind", "id", number.cast("bigint").alias("number"))


def hourly_bitmaps(ids: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date, hour, kind, bucket, bitmap) of ``hourly_ids`` rows."""
    found = ids.join(numbers, ["kind", "id"])
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    bit = F.bitmap_bit_position("number")
    return found.groupBy("event_date", "hour", "kind", bucket).agg(
        F.bitmap_construct_agg(bit).alias("bitmap")
    )


def daily_from_hours(counts: DataFrame, bitmaps: DataFrame, interval: Interval) -> DataFrame:
    """The daily traffic of days that were counted by hour, of any number of loads each."""
    in_days = interval.has_date("event_date")
    added = [F.sum(f"{name}_count").alias(f"{name}_count") for name in EVENT_TYPES]
    total = F.sum("total_events").alias("total_events")
    days = counts.filter(in_days).groupBy("event_date").agg(total, *added)
    merged = (
        bitmaps.filter(in_days)
        .groupBy("event_date", "kind", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("ids"))
    )
    distinct = merged.groupBy("event_date").agg(
        *[F.sum(F.when(F.col("kind") == kind, F.col("ids"))).alias(kind) for kind in KINDS]
    )
    found = days.join(distinct, "event_date", "left")
    columns = [F.coalesce(kind, F.lit(0)).alias(kind) for kind in KINDS]
    counted = [f"{name}_count" for name in EVENT_TYPES]
    return found.select("event_date", "total_events", *columns, *counted)
