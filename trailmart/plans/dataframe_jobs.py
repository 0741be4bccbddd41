"""The batch jobs, written with the DataFrame API.

Each reads one table, writes one table of the same schema, and expects both to exist.
Appending jobs add the interval's rows again when they run again; only the merge job
may be retried freely. Jobs that read events must not overlap with a compaction of their
days; one that was interrupted is completed first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmart.functions.intervals import Interval
from trailmart.operators.products import cart_abandonment, product_funnel
from trailmart.operators.summaries import daily_traffic, session_products, sessions
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
    DATAFRAME_SUFFIX,
    DEFAULT_SCHEMA,
    append_by_name,
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
    _append(daily_traffic(_events(spark, schema, interval), interval), DAILY_TRAFFIC, schema)


def build_sessions(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    _append(sessions(_events(spark, schema, interval), interval), SESSIONS, schema)


def build_session_products(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    _append(session_products(_events(spark, schema, interval), interval), SESSION_PRODUCTS, schema)


def build_daily_product_funnel(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    funnel = product_funnel(_session_products(spark, schema), interval)
    _append(funnel, PRODUCT_FUNNEL, schema)


def build_daily_product_cart_abandonment(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    interval = _interval(spark, data_interval_start, data_interval_end)
    abandonment = cart_abandonment(_session_products(spark, schema), interval)
    _append(abandonment, CART_ABANDONMENT, schema)


def merge_daily_product_cart_abandonment(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
) -> None:
    """The retry-safe form: running it again leaves the table as it is."""
    interval = _interval(spark, data_interval_start, data_interval_end)
    merge_window(
        cart_abandonment(_session_products(spark, schema), interval),
        table_name(CART_ABANDONMENT, schema, DATAFRAME_SUFFIX),
        CART_ABANDONMENT,
        PRODUCT_DAY_KEYS,
        ABANDONMENT_MEASURES,
        interval,
    )


def _interval(spark: SparkSession, start: str, end: str) -> Interval:
    return Interval.between(use_utc(spark), start, end)


def _events(spark: SparkSession, schema: str, interval: Interval) -> DataFrame:
    """The stored events, without what an interrupted compaction left twice."""
    finish_interrupted(spark, schema, interval)
    return read_events(spark, schema, interval)


def _session_products(spark: SparkSession, schema: str) -> DataFrame:
    return spark.table(table_name(SESSION_PRODUCTS, schema, DATAFRAME_SUFFIX))


def _append(df: DataFrame, layout: TableLayout, schema: str) -> None:
    append_by_name(df, table_name(layout, schema, DATAFRAME_SUFFIX), layout)
