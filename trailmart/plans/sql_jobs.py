"""The batch jobs, written in SQL; results and intermediate are tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmart.functions.intervals import Interval
from trailmart.plans import sql_text
from trailmart.plans.compaction import finish_interrupted
from trailmart.plans.merge_window import merge_window
from trailmart.schema import (
    ABANDONMENT_MEASURES,
    CART_ABANDONMENT,
    DAILY_TRAFFIC,
    PRODUCT_DAY_KEYS,
    PRODUCT_FUNNEL,
    SESSION_PRODUCTS,
    SESSIONS,
    TableLayout,
)
from trailmart.session import use_utc
from trailmart.sources.tables import (
    DEFAULT_SCHEMA,
    append_by_position,
    read_events,
    table_name,
)


def build_daily_traffic_summary(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    _append_from_events(spark, sql_text.DAILY_TRAFFIC, DAILY_TRAFFIC, interval, schema)


def build_sessions(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    _append_from_events(spark, sql_text.SESSIONS, SESSIONS, interval, schema)


def build_session_products(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    _append_from_events(spark, sql_text.SESSION_PRODUCTS, SESSION_PRODUCTS, interval, schema)


def build_daily_product_funnel(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    funnel = _from_session_products(spark, sql_text.PRODUCT_FUNNEL, interval, schema)
    append_by_position(funnel, table_name(PRODUCT_FUNNEL, schema), PRODUCT_FUNNEL)


def build_daily_product_cart_abandonment(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    abandonment = _from_session_products(spark, sql_text.CART_ABANDONMENT, interval, schema)
    append_by_position(abandonment, table_name(CART_ABANDONMENT, schema), CART_ABANDONMENT)


def merge_daily_product_cart_abandonment(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    """The retry-safe form: running it again leaves the table as it is."""
    interval = _interval(spark, data_interval_start, data_interval_end)
    merge_window(
        _from_session_products(spark, sql_text.CART_ABANDONMENT, interval, schema),
        table_name(CART_ABANDONMENT, schema),
        CART_ABANDONMENT,
        PRODUCT_DAY_KEYS,
        ABANDONMENT_MEASURES,
        interval,
    )


def _interval(spark: SparkSession, start: str, end: str) -> Interval:
    return Interval.between(use_utc(spark), start, end)


def _append_from_events(
    spark: SparkSession, text: str, layout: TableLayout, interval: Interval, schema: str
) -> None:
    finish_interrupted(spark, schema, interval)
    events = read_events(spark, schema, interval)
    rows = sql_text.run_over_events(text, events, interval)
    append_by_position(rows, table_name(layout, schema), layout)


def _from_session_products(
    spark: SparkSession, text: str, interval: Interval, schema: str
) -> DataFrame:
    stored = spark.table(table_name(SESSION_PRODUCTS, schema))
    return sql_text.run_over_session_products(text, stored, interval)
