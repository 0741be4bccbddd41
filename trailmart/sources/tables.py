"""Catalog tables: creating, reading, appending and replacing partitions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.schema import (
    COMPACTION_LOG,
    DEAD_LETTERS,
    EVENTS,
    REJECTED_EVENTS,
    RESULT_TABLES,
    STORED_EVENT_COLUMNS,
    TableLayout,
)
from trailmart.session import with_time_statistics

DEFAULT_SCHEMA = "retail"
# DataFrame jobs keep their results, and the intermediate they read, in tables of their own.
DATAFRAME_SUFFIX = "_df"
# Beyond so many days the catalog is asked once rather than for each.
LISTED_DAYS = 50
# How a catalog names the partition of a null value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_name(layout: TableLayout, schema: str = DEFAULT_SCHEMA, suffix: str = "") -> str:
    return f"{schema}.{layout.name}{suffix}"


def create_table(spark: SparkSession, name: str, layout: TableLayout) -> str:
    """Create an empty table unless it exists.

    An overwrite of a partitioned table replaces only the partitions it writes; the
    option belongs to the table, so no session setting is needed for it.
    """
    layout_clause = ""
    if layout.partitioned_by:
        layout_clause = (
            "OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY ({', '.join(layout.partitioned_by)})"
        )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({layout.ddl}) USING parquet {layout_clause}")
    return name


def create_tables(
    spark: SparkSession, schema: str = DEFAULT_SCHEMA, location: str | None = None
) -> None:
    """Create the schema, at ``location`` if given, with every table the jobs use."""
    spark.sql(
        f"CREATE SCHEMA IF NOT EXISTS {schema}" + (f" LOCATION '{location}'" if location else "")
    )
    create_table(spark, table_name(EVENTS, schema), EVENTS)
    create_table(spark, table_name(COMPACTION_LOG, schema), COMPACTION_LOG)
    for layout in (REJECTED_EVENTS, DEAD_LETTERS):
        create_table(spark, table_name(layout, schema), layout)
    for layout in RESULT_TABLES:
        for suffix in ("", DATAFRAME_SUFFIX):
            create_table(spark, table_name(layout, schema, suffix), layout)


def read_table(spark: SparkSession, name: str, layout: TableLayout) -> DataFrame:
    """The table with its columns in declared order."""
    return spark.table(name).select(*layout.columns)


def read_events(
    spark: SparkSession, schema: str = DEFAULT_SCHEMA, interval: Interval | None = None
) -> DataFrame:
    """Stored events; with an interval, only from the days that can hold its events."""
    events = spark.table(table_name(EVENTS, schema))
    if interval is not None:
        events = events.filter(interval.may_hold_day("event_date"))
    return events.select(*STORED_EVENT_COLUMNS)


def append_by_name(df: DataFrame, name: str, layout: TableLayout) -> None:
    """Append rows; columns meet the table's by name and must be the same set."""
    if set(df.columns) != set(layout.columns) or len(df.columns) != len(layout.columns):
        raise ValueError(f"Columns of {name} are {layout.columns}, got {tuple(df.columns)}")
    stored_order = with_time_statistics(df.sparkSession).table(name).columns
    together(df, layout.partitioned_by).select(*stored_order).write.insertInto(name)


def append_by_position(df: DataFrame, name: str, layout: TableLayout) -> None:
    """Append rows; columns meet the table's declared ones by position."""
    day = [df.columns[layout.columns.index(c)] for c in layout.partitioned_by]
    with_time_statistics(df.sparkSession).sql(
        f"INSERT INTO {name} ({', '.join(layout.columns)}) SELECT * FROM {{rows}}",
        rows=together(df, day),
    )


def together(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Bring rows of one partition together so that few files are written.

    A rebalance, unlike a repartition, splits a day that is larger than the others
    over several tasks.
    """
    columns = list(columns)
    return df.hint("rebalance", *columns) if columns else df


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    Spark writes next to the table and moves whole partitions in at the end, so
    ``df`` may read the same table, and doing it again gives the same result.
    """
    stored_order = with_time_statistics(df.sparkSession).table(name).columns
    df.select(*stored_order).write.insertInto(name, overwrite=True)


def store_events(events: DataFrame, name: str, batch: str) -> None:
    """Store one batch of events. Storing the batch again replaces it.

    There is no shuffle: every task writes the days it holds, as its own files, each in the
    order of its event times, so that a part of a day is found by the files' statistics.
    """
    stored = events.select(
        *STORED_EVENT_COLUMNS,
        F.col("event_time").cast("date").alias("event_date"),
        F.lit(batch).alias("ingest_batch"),
    )
    overwrite_partitions(stored.sortWithinPartitions(*EVENTS.partitioned_by, "event_time"), name)


def partitions(
    spark: SparkSession, name: str, layout: TableLayout, days: Iterable[str] | None = None
) -> DataFrame:
    """The table's partitions as rows of text columns, from the catalog alone.

    With days, only their partitions are returned, by the first column of the layout; a few
    are listed day by day, for many the whole table is listed once.
    """
    columns = layout.partitioned_by
    days = None if days is None else list(days)
    one_list = days is None or len(days) > LISTED_DAYS
    specs = [""] if one_list else [f" PARTITION ({columns[0]} = '{day}')" for day in days]
    lists = [spark.sql(f"SHOW PARTITIONS {name}{spec}") for spec in specs]
    if not lists:
        return spark.createDataFrame([], ", ".join(f"{column} STRING" for column in columns))

    def value_of(column):
        text = F.regexp_extract("partition", f"{column}=([^/]*)", 1)
        return F.nullif(text, F.lit(NULL_PARTITION)).alias(column)

    found = reduce(DataFrame.union, lists).select(*map(value_of, columns))
    return found.filter(F.col(columns[0]).isin(days)) if one_list and days else found


def drop_partitions(
    spark: SparkSession, name: str, specs: Iterable[Mapping[str, str]]
) -> None:
    """Drop partitions with their files, in one catalog call."""
    specs = list(specs)
    if not specs:
        return
    if spark.catalog.getTable(name).tableType != "MANAGED":
        raise ValueError(f"{name} is not a managed table: dropped partitions would keep files")
    clauses = ", ".join(
        "PARTITION (" + ", ".join(f"{k} = '{v}'" for k, v in spec.items()) + ")" for spec in specs
    )
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {clauses}")
