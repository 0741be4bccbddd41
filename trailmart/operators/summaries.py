"""Summaries of raw events: by day, by session, by session and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.functions.metrics import (
    count_of,
    first_day,
    first_time_of,
    has_any,
    quantity_of,
    revenue_of,
)
from trailmart.schema import EVENT_TYPES, PRODUCT_EVENT_TYPES, SESSION_PRODUCTS


def events_in_interval(events: DataFrame, interval: Interval) -> DataFrame:
    """Events of the interval, by their time alone."""
    return events.filter(interval.has_time("event_time"))


def daily_traffic(events: DataFrame, interval: Interval) -> DataFrame:
    """One row per UTC day: events, distinct users and sessions, events by type."""
    return (
        events_in_interval(events, interval)
        .groupBy(F.col("event_time").cast("date").alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("unique_sessions"),
            *[count_of(name).alias(f"{name}_count") for name in EVENT_TYPES],
        )
    )


def sessions(events: DataFrame, interval: Interval) -> DataFrame:
    """One row per session and user, dated by its first event of the interval."""
    seconds = F.unix_timestamp(F.max("event_time")) - F.unix_timestamp(F.min("event_time"))
    return (
        events_in_interval(events, interval)
        .groupBy("session_id", "user_id")
        .agg(
            first_day().alias("session_date"),
            F.min("event_time").alias("session_start_time"),
            F.max("event_time").alias("session_end_time"),
            seconds.alias("session_duration_seconds"),
            F.count(F.lit(1)).alias("event_count"),
            *[count_of(name).alias(f"{name}_count") for name in EVENT_TYPES],
            has_any("search").alias("searched"),
            has_any("product_view").alias("viewed_product"),
            has_any("add_to_cart").alias("added_to_cart"),
            has_any("checkout_start").alias("started_checkout"),
            has_any("purchase").alias("purchased"),
        )
    )


def session_products(events: DataFrame, interval: Interval) -> DataFrame:
    """One row per session, user and product as named and categorised at the time."""
    return (
        events_in_interval(events, interval)
        .filter(F.col("product_id").isNotNull())
        .groupBy("session_id", "user_id", "product_id", "product_name", "category")
        .agg(
            first_day().alias("event_date"),
            *[first_time_of(name).alias(f"first_{name}_time") for name in PRODUCT_EVENT_TYPES],
            *[count_of(name).alias(f"{name}_count") for name in PRODUCT_EVENT_TYPES],
            has_any("product_view").alias("viewed_product"),
            has_any("add_to_cart").alias("added_to_cart"),
            has_any("remove_from_cart").alias("removed_from_cart"),
            has_any("checkout_start").alias("started_checkout"),
            has_any("purchase").alias("purchased"),
            quantity_of("add_to_cart").alias("quantity_added"),
            quantity_of("purchase").alias("quantity_purchased"),
            revenue_of("purchase").alias("revenue"),
        )
        .select(*SESSION_PRODUCTS.columns)
    )
