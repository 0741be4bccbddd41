"""Every query over the test tables: (session, table folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.functions.validation import validation_error
from trailmart.operators import products, summaries
from trailmart.plans import dataframe_jobs, hourly_jobs, sql_jobs, sql_text
from trailmart.plans.compaction import compact_clickstream_events
from trailmart.plans.merge_window import merge_window
from trailmart.registry.oracles import (
    BROKEN_FIELDS,
    END,
    LATE_CUT,
    NARROW_END,
    NARROW_START,
    START,
    UNREADABLE_STEP,
    UNREADABLE_WAYS,
)
from trailmart.schema import (
    ABANDONMENT_MEASURES,
    CART_ABANDONMENT,
    CART_EVENT_TYPES,
    DAILY_TRAFFIC,
    DEAD_LETTERS,
    EVENT_COLUMNS,
    EVENTS,
    PRODUCT_DAY_KEYS,
    PRODUCT_FUNNEL,
    SESSION_PRODUCTS,
    SESSIONS,
    TableLayout,
)
from trailmart.session import fresh_path, use_utc, written_once
from trailmart.sources.kafka import as_records, read_record_files
from trailmart.sources.retail_events import clickstream_events
from trailmart.sources.tables import (
    DATAFRAME_SUFFIX,
    append_by_name,
    create_table,
    create_tables,
    read_events,
    read_table,
    store_events,
    table_name,
)
from trailmart.streaming.ingest import (
    REJECTED_EVENTS,
    dead_letters,
    parse_and_mark_events,
    parse_and_validate_events,
    parse_events,
    run_to_end,
    start_clickstream_ingestion,
    start_routed_ingestion,
)
from trailmart.streaming.progress import run_until, watched

Query = Callable[[SparkSession, str], DataFrame]
TIMED_BATCHES = 4
PART_HOUR = "2024-01-12 10:25:00"
#: Bytes of a row group of records. A scan deals out row groups, so a batch of one file has
#: work for all cores only if the file has many.
RECORD_GROUP_BYTES = 4 << 20


def interval_of(spark: SparkSession, start: str = START, end: str = END) -> Interval:
    return Interval.between(use_utc(spark), start, end)


# --- results straight from the events -------------------------------------------------


def events_in_interval(spark, sf_dir):
    return summaries.events_in_interval(clickstream_events(spark, sf_dir), interval_of(spark))


def daily_traffic(spark, sf_dir):
    return summaries.daily_traffic(clickstream_events(spark, sf_dir), interval_of(spark))


def sessions(spark, sf_dir):
    return summaries.sessions(clickstream_events(spark, sf_dir), interval_of(spark))


def session_products(spark, sf_dir):
    return summaries.session_products(clickstream_events(spark, sf_dir), interval_of(spark))


def product_funnel(spark, sf_dir):
    return products.product_funnel(session_products(spark, sf_dir), interval_of(spark))


def _report_columns(rows: DataFrame) -> DataFrame:
    """What the abandonment report needs of session products."""
    return rows.select("session_id", *PRODUCT_DAY_KEYS, "added_to_cart", "purchased")


def _abandonment_of(rows: DataFrame, interval: Interval) -> DataFrame:
    """The report reads its input twice, so session products are made and written once."""
    stored = written_once(_report_columns(rows), "session-products")
    return products.cart_abandonment(stored, interval)


def cart_abandonment(spark, sf_dir):
    return _abandonment_of(session_products(spark, sf_dir), interval_of(spark))


def subday_interval(spark, sf_dir):
    noon = interval_of(spark, "2024-01-10 06:00:00", "2024-01-10 18:00:00")
    funnel = products.product_funnel(session_products(spark, sf_dir), noon)
    return funnel.agg(F.count(F.lit(1)).alias("funnel_rows"))


def _sql_over_events(text: str) -> Query:
    def query(spark, sf_dir):
        events = clickstream_events(spark, sf_dir)
        return sql_text.run_over_events(text, events, interval_of(spark))

    return query


def _sql_over_session_products(text: str) -> Query:
    def query(spark, sf_dir):
        events, interval = clickstream_events(spark, sf_dir), interval_of(spark)
        stored = sql_text.run_over_events(sql_text.SESSION_PRODUCTS, events, interval)
        if text == sql_text.CART_ABANDONMENT:
            stored = written_once(_report_columns(stored), "session-products")
        return sql_text.run_over_session_products(text, stored, interval)

    return query


# --- jobs over tables -----------------------------------------------------------------


def _scratch_schema(spark: SparkSession) -> str:
    """A schema of its own for one call, with its files in the shared folder.

    It stays for the caller to read; the folder is the session's to clear.
    """
    schema = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{fresh_path(use_utc(spark), 'tables')}'")
    return schema


def _scratch_table(spark: SparkSession, layout: TableLayout) -> str:
    return create_table(spark, table_name(layout, _scratch_schema(spark)), layout)


def _stored_clickstream(spark: SparkSession, sf_dir: str) -> str:
    """A schema with all tables, the events table filled."""
    schema = _scratch_schema(spark)
    create_tables(spark, schema)
    _store_load(clickstream_events(spark, sf_dir), schema, "load-1")
    return schema


def _store_load(events: DataFrame, schema: str, batch: str) -> None:
    stamped = events.withColumn("ingestion_time", F.current_timestamp())
    store_events(stamped, table_name(EVENTS, schema), batch)


def _append_twice(jobs, suffix: str) -> Query:
    def query(spark, sf_dir):
        schema = _stored_clickstream(spark, sf_dir)
        for _ in range(2):
            jobs.build_daily_traffic_summary(spark, START, END, schema)
        return read_table(spark, table_name(DAILY_TRAFFIC, schema, suffix), DAILY_TRAFFIC)

    return query


def _table_pipeline(jobs, suffix: str, layout: TableLayout, steps: tuple[str, ...]) -> Query:
    """Run jobs one after the other over stored tables and return the last one's table."""

    def query(spark, sf_dir):
        schema = _stored_clickstream(spark, sf_dir)
        for step in steps:
            getattr(jobs, step)(spark, START, END, schema)
        return read_table(spark, table_name(layout, schema, suffix), layout)

    return query


def _daily_runs(spark: SparkSession, sf_dir: str, build: Callable) -> str:
    """A schema with a job run day by day, so that a session over midnight has two rows."""
    schema = _stored_clickstream(spark, sf_dir)
    day, last = date.fromisoformat(START[:10]), date.fromisoformat(END[:10])
    while day < last:
        following = day + timedelta(days=1)
        build(spark, str(day), str(following), schema)
        day = following
    return schema


def traffic_from_hours(spark, sf_dir):
    """Daily traffic put together from parts of hours, loaded in several runs.

    The first run ends within an hour, which the second one goes on with.
    """
    schema = _stored_clickstream(spark, sf_dir)
    hourly_jobs.create_hourly_tables(spark, schema)
    for start, end in ((START, PART_HOUR), (PART_HOUR, LATE_CUT), (LATE_CUT, END)):
        hourly_jobs.add_hourly_traffic(spark, start, end, schema)
    hourly_jobs.build_daily_traffic_from_hours(spark, START, END, schema)
    return read_table(spark, table_name(DAILY_TRAFFIC, schema, DATAFRAME_SUFFIX), DAILY_TRAFFIC)


def sessions_daily_runs(spark, sf_dir):
    schema = _daily_runs(spark, sf_dir, dataframe_jobs.build_sessions)
    return read_table(spark, table_name(SESSIONS, schema, DATAFRAME_SUFFIX), SESSIONS)


def session_products_daily_runs(spark, sf_dir):
    schema = _daily_runs(spark, sf_dir, sql_jobs.build_session_products)
    return read_table(spark, table_name(SESSION_PRODUCTS, schema), SESSION_PRODUCTS)


def cart_abandonment_daily_runs(spark, sf_dir):
    schema = _daily_runs(spark, sf_dir, dataframe_jobs.build_session_products)
    dataframe_jobs.build_daily_product_cart_abandonment(spark, START, END, schema)
    name = table_name(CART_ABANDONMENT, schema, DATAFRAME_SUFFIX)
    return read_table(spark, name, CART_ABANDONMENT)


# --- merges ---------------------------------------------------------------------------


def _merge(source: DataFrame, name: str, interval: Interval) -> list[str]:
    """The days that the merge wrote."""
    return merge_window(
        source, name, CART_ABANDONMENT, PRODUCT_DAY_KEYS, ABANDONMENT_MEASURES, interval
    )


def _merge_in_turn(sources: Callable[[SparkSession, str], list[DataFrame]]) -> Query:
    """Merge each source into a table that starts empty."""

    def query(spark, sf_dir):
        name = _scratch_table(spark, CART_ABANDONMENT)
        for source in sources(spark, sf_dir):
            _merge(source, name, interval_of(spark))
        return read_table(spark, name, CART_ABANDONMENT)

    return query


def _same_twice(spark, sf_dir):
    return [cart_abandonment(spark, sf_dir)] * 2


def _early_then_all(spark, sf_dir):
    events, interval = clickstream_events(spark, sf_dir), interval_of(spark)
    early = events.filter(F.col("event_time") < F.lit(LATE_CUT).cast("timestamp"))
    return [
        _abandonment_of(summaries.session_products(part, interval), interval)
        for part in (early, events)
    ]


def _all_then_fewer(spark, sf_dir):
    interval = interval_of(spark)
    stored = written_once(_report_columns(session_products(spark, sf_dir)), "session-products")
    gone = (F.col("product_id") == "p3") | (F.col("event_date") == "2024-01-10")
    return [products.cart_abandonment(part, interval) for part in (stored, stored.filter(~gone))]


def _days_of_last_merge(sources: Callable[[SparkSession, str], list[DataFrame]]) -> Query:
    """The days that the last of several merges wrote."""

    def query(spark, sf_dir):
        name = _scratch_table(spark, CART_ABANDONMENT)
        written = [_merge(source, name, interval_of(spark)) for source in sources(spark, sf_dir)]
        days = spark.createDataFrame([(day,) for day in written[-1]], "event_date STRING")
        return days.select(F.col("event_date").cast("date"))

    return query


def merge_null_keys(spark, sf_dir):
    return _merge_in_turn(_same_twice)(spark, sf_dir).filter("category IS NULL")


def merge_duplicates(spark, sf_dir):
    name = _scratch_table(spark, CART_ABANDONMENT)
    for _ in range(2):
        append_by_name(cart_abandonment(spark, sf_dir), name, CART_ABANDONMENT)
    _merge(cart_abandonment(spark, sf_dir), name, interval_of(spark))
    return read_table(spark, name, CART_ABANDONMENT)


def merge_outside_window(spark, sf_dir):
    """All days stored, then a narrower interval merged from a source without product p3."""
    name = _scratch_table(spark, CART_ABANDONMENT)
    append_by_name(cart_abandonment(spark, sf_dir), name, CART_ABANDONMENT)
    narrow = interval_of(spark, NARROW_START, NARROW_END)
    fewer = session_products(spark, sf_dir).filter(F.col("product_id") != "p3")
    _merge(_abandonment_of(fewer, narrow), name, narrow)
    return read_table(spark, name, CART_ABANDONMENT)


# --- ingestion ------------------------------------------------------------------------


def json_decode(spark, sf_dir):
    return parse_events(as_records(clickstream_events(spark, sf_dir)))


def validation_errors(spark, sf_dir):
    events = clickstream_events(spark, sf_dir)
    marked = events.select("event_id", validation_error().alias("message"))
    return marked.filter(F.col("message").isNotNull())


def validation_error_counts(spark, sf_dir):
    return validation_errors(spark, sf_dir).groupBy("message").agg(F.count("*").alias("events"))


def validation_all_rules(spark, sf_dir):
    """Events by message, with one field of each broken in turn by the event's number."""
    events = clickstream_events(spark, sf_dir)
    events = events.withColumn("number", F.expr("CAST(substring(event_id, 2) AS BIGINT)"))
    turn = f"number % {len(BROKEN_FIELDS) + 1}"
    for place, (field, value) in enumerate(BROKEN_FIELDS):
        kind = events.schema[field].dataType.simpleString()
        broken = F.expr(f"IF({turn} = {place}, CAST({value} AS {kind}), {field})")
        events = events.withColumn(field, broken)
    marked = events.select(validation_error().alias("message"))
    return marked.groupBy("message").agg(F.count("*").alias("events"))


def _valid(events: DataFrame) -> DataFrame:
    return events.filter(validation_error().isNull())


def _ingest(spark: SparkSession, schema: str, records: str, checkpoint: str) -> None:
    events = parse_and_validate_events(read_record_files(spark, records))
    run_to_end(
        start_clickstream_ingestion(events, checkpoint, schema, trigger={"availableNow": True})
    )


def _put_records(records: DataFrame, path: str) -> None:
    """Add files of records to a topic."""
    writer = records.write.mode("append").option("parquet.block.size", RECORD_GROUP_BYTES)
    writer.parquet(path)


def _ingestion_target(spark: SparkSession) -> str:
    schema = _scratch_schema(spark)
    create_table(spark, table_name(EVENTS, schema), EVENTS)
    return schema


def stream_ingest(spark, sf_dir):
    records, checkpoint = fresh_path(spark, "records"), fresh_path(spark, "stream")
    _put_records(as_records(_valid(clickstream_events(spark, sf_dir))), records)
    schema = _ingestion_target(spark)
    _ingest(spark, schema, records, checkpoint)
    return read_events(spark, schema).drop("ingestion_time")


def stream_restart(spark, sf_dir):
    """A run, a second one after more files came, and a third over the same files."""
    records, checkpoint = fresh_path(spark, "records"), fresh_path(spark, "stream")
    valid = _valid(clickstream_events(spark, sf_dir))
    early = F.col("event_time") < F.lit(LATE_CUT).cast("timestamp")
    schema = _ingestion_target(spark)
    for part in (valid.filter(early), valid.filter(~early), None):
        if part is not None:
            _put_records(as_records(part), records)
        _ingest(spark, schema, records, checkpoint)
    return read_events(spark, schema).drop("ingestion_time")


def stream_stamped(spark, sf_dir):
    """How many ingested events carry their arrival time."""
    records, checkpoint = fresh_path(spark, "records"), fresh_path(spark, "stream")
    _put_records(as_records(_valid(clickstream_events(spark, sf_dir))), records)
    schema = _ingestion_target(spark)
    _ingest(spark, schema, records, checkpoint)
    return read_events(spark, schema).agg(F.count("ingestion_time").alias("stamped_events"))


def _routed(spark: SparkSession, records: DataFrame) -> str:
    """A schema into which the records were ingested, whatever is in them."""
    path, checkpoint = fresh_path(spark, "records"), fresh_path(spark, "stream")
    _put_records(records, path)
    schema = _ingestion_target(spark)
    marked = parse_and_mark_events(read_record_files(spark, path))
    run_to_end(start_routed_ingestion(marked, checkpoint, schema, trigger={"availableNow": True}))
    return schema


def _unreadable_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, numbered by their offset, a part of them with a document that cannot be
    read: one way for each of the first remainders of the number."""
    number = F.expr("CAST(substring(event_id, 2) AS BIGINT)")
    records = as_records(clickstream_events(spark, sf_dir), offset=number)
    document = "decode(value, 'UTF-8')"
    open_end = f"substring({document}, 1, length({document}) - 1)"
    ways = (
        f"substring({document}, 1, length({document}) - 5)",
        f"concat('[', {document}, ']')",
        f"""regexp_replace({document}, '"event_time":"[^"]*"', '"event_time":"5th of January"')""",
        f"""concat({open_end}, ',"quantity":1.5}}')""",
        f"""concat({open_end}, ',"quantity":"2"}}')""",
        f"""concat({open_end}, ',"price":123456789012.0}}')""",
        "'null'",
    )
    cases = " ".join(
        f"WHEN offset % {UNREADABLE_STEP} = {place} THEN encode({way}, 'UTF-8')"
        for place, way in enumerate(ways)
    )
    assert len(ways) == UNREADABLE_WAYS
    return records.withColumn("value", F.expr(f"CASE {cases} ELSE value END"))


def stream_rejects(spark, sf_dir):
    schema = _routed(spark, as_records(clickstream_events(spark, sf_dir)))
    return spark.table(table_name(REJECTED_EVENTS, schema)).select(
        *EVENT_COLUMNS, "validation_error"
    )


def stream_accepted(spark, sf_dir):
    schema = _routed(spark, as_records(clickstream_events(spark, sf_dir)))
    return read_events(spark, schema).drop("ingestion_time")


def stream_dead_letters(spark, sf_dir):
    """The records whose documents cannot be read, which do not stop the stream."""
    schema = _routed(spark, _unreadable_records(spark, sf_dir))
    letters = spark.table(table_name(DEAD_LETTERS, schema))
    return letters.select("offset", "topic", "timestamp", "error")


def stream_past_dead_letters(spark, sf_dir):
    """The valid events among such records."""
    schema = _routed(spark, _unreadable_records(spark, sf_dir))
    return read_events(spark, schema).drop("ingestion_time")


def stream_dead_letters_again(spark, sf_dir):
    """Events by message after the dead letters, mended, were ingested as well."""
    schema = _routed(spark, _unreadable_records(spark, sf_dir))
    kept = dead_letters(spark, schema).select("offset")
    number = F.expr("CAST(substring(event_id, 2) AS BIGINT)")
    events = clickstream_events(spark, sf_dir).withColumn("offset", number)
    # Only what comes again is made a document.
    again = events.join(kept, "offset", "left_semi")
    mended = parse_and_mark_events(as_records(again, offset=F.col("offset")))
    again = mended.groupBy(F.col("validation_error").alias("message"))
    return again.agg(F.count("*").alias("events"))


def stream_rule_counts(spark, sf_dir):
    """What each rule refused, as the stream's own progress tells it."""
    with watched(spark) as progress:
        _routed(spark, _unreadable_records(spark, sf_dir))
    return spark.createDataFrame(list(progress.refused.items()), "message STRING, events BIGINT")


def stream_timed(spark, sf_dir):
    """Several batches of a query that is triggered once a second, stopped between batches."""
    records, checkpoint = fresh_path(spark, "records"), fresh_path(spark, "stream")
    valid = as_records(_valid(clickstream_events(spark, sf_dir)))
    _put_records(valid.repartition(TIMED_BATCHES, F.xxhash64("value")), records)
    total, schema = spark.read.parquet(records).count(), _ingestion_target(spark)
    events = parse_and_validate_events(read_record_files(spark, records, files_per_batch=1))
    with watched(spark) as progress:
        query = start_clickstream_ingestion(
            events, checkpoint, schema, trigger={"processingTime": "1 second"}
        )
        run_until(query, lambda: sum(rows for _, rows, _ in progress.batches) >= total)
    return read_events(spark, schema).drop("ingestion_time")


# --- compaction -----------------------------------------------------------------------


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    schema = _scratch_schema(spark)
    create_tables(spark, schema)
    events = clickstream_events(spark, sf_dir)
    loads = (
        ~F.col("event_type").isin(*CART_EVENT_TYPES),
        F.col("event_type").isin("add_to_cart", "remove_from_cart"),
        F.col("event_type").isin("checkout_start", "purchase"),
    )
    for number, rows in enumerate(loads):
        # A file per load and day, whatever the scan's tasks, so that files can be counted.
        whole_days = events.filter(rows).repartition(F.col("event_time").cast("date"))
        _store_load(whole_days, schema, f"load-{number}")
    return schema, compact_clickstream_events(spark, START, END, schema)


def compact_rows(spark, sf_dir):
    schema, _ = _compacted(spark, sf_dir)
    return read_events(spark, schema).drop("ingestion_time")


def _file_counts(metrics: DataFrame) -> DataFrame:
    return metrics.select("event_date", "rewritten_files", "added_files")


def compact_metrics(spark, sf_dir):
    return _file_counts(_compacted(spark, sf_dir)[1])


def compact_rerun_metrics(spark, sf_dir):
    """A second compaction of the same table finds nothing to do."""
    schema, _ = _compacted(spark, sf_dir)
    return _file_counts(compact_clickstream_events(spark, START, END, schema))


QUERIES: dict[str, Query] = {
    "clickstream_events": clickstream_events,
    "events_in_interval": events_in_interval,
    "daily_traffic": daily_traffic,
    "traffic_from_hours": traffic_from_hours,
    "daily_traffic_sql": _sql_over_events(sql_text.DAILY_TRAFFIC),
    "sessions": sessions,
    "sessions_sql": _sql_over_events(sql_text.SESSIONS),
    "session_products": session_products,
    "session_products_sql": _sql_over_events(sql_text.SESSION_PRODUCTS),
    "product_funnel": product_funnel,
    "product_funnel_sql": _sql_over_session_products(sql_text.PRODUCT_FUNNEL),
    "cart_abandonment": cart_abandonment,
    "cart_abandonment_sql": _sql_over_session_products(sql_text.CART_ABANDONMENT),
    "cart_abandonment_daily_runs": cart_abandonment_daily_runs,
    "sessions_daily_runs": sessions_daily_runs,
    "session_products_daily_runs": session_products_daily_runs,
    "subday_interval": subday_interval,
    "append_twice": _append_twice(dataframe_jobs, DATAFRAME_SUFFIX),
    "append_twice_sql": _append_twice(sql_jobs, ""),
    "sessions_job": _table_pipeline(
        dataframe_jobs, DATAFRAME_SUFFIX, SESSIONS, ("build_sessions",)
    ),
    "sessions_job_sql": _table_pipeline(sql_jobs, "", SESSIONS, ("build_sessions",)),
    "session_products_job": _table_pipeline(
        dataframe_jobs, DATAFRAME_SUFFIX, SESSION_PRODUCTS, ("build_session_products",)
    ),
    "session_products_job_sql": _table_pipeline(
        sql_jobs, "", SESSION_PRODUCTS, ("build_session_products",)
    ),
    "product_funnel_job": _table_pipeline(
        dataframe_jobs,
        DATAFRAME_SUFFIX,
        PRODUCT_FUNNEL,
        ("build_session_products", "build_daily_product_funnel"),
    ),
    "product_funnel_job_sql": _table_pipeline(
        sql_jobs, "", PRODUCT_FUNNEL, ("build_session_products", "build_daily_product_funnel")
    ),
    "cart_abandonment_job": _table_pipeline(
        dataframe_jobs,
        DATAFRAME_SUFFIX,
        CART_ABANDONMENT,
        ("build_session_products", "build_daily_product_cart_abandonment"),
    ),
    "cart_abandonment_job_sql": _table_pipeline(
        sql_jobs,
        "",
        CART_ABANDONMENT,
        ("build_session_products", "build_daily_product_cart_abandonment"),
    ),
    "merge_job": _table_pipeline(
        dataframe_jobs,
        DATAFRAME_SUFFIX,
        CART_ABANDONMENT,
        ("build_session_products",) + 2 * ("merge_daily_product_cart_abandonment",),
    ),
    "merge_job_sql": _table_pipeline(
        sql_jobs,
        "",
        CART_ABANDONMENT,
        ("build_session_products",) + 2 * ("merge_daily_product_cart_abandonment",),
    ),
    "merge_rerun": _merge_in_turn(_same_twice),
    "merge_late_events": _merge_in_turn(_early_then_all),
    "merge_deletes": _merge_in_turn(_all_then_fewer),
    "merge_rerun_days": _days_of_last_merge(_same_twice),
    "merge_late_days": _days_of_last_merge(_early_then_all),
    "merge_deletes_days": _days_of_last_merge(_all_then_fewer),
    "merge_null_keys": merge_null_keys,
    "merge_duplicates": merge_duplicates,
    "merge_outside_window": merge_outside_window,
    "json_decode": json_decode,
    "validation_errors": validation_errors,
    "validation_error_counts": validation_error_counts,
    "validation_all_rules": validation_all_rules,
    "stream_ingest": stream_ingest,
    "stream_restart": stream_restart,
    "stream_stamped": stream_stamped,
    "stream_rejects": stream_rejects,
    "stream_accepted": stream_accepted,
    "stream_dead_letters": stream_dead_letters,
    "stream_past_dead_letters": stream_past_dead_letters,
    "stream_dead_letters_again": stream_dead_letters_again,
    "stream_rule_counts": stream_rule_counts,
    "stream_timed": stream_timed,
    "compact_rows": compact_rows,
    "compact_metrics": compact_metrics,
    "compact_rerun_metrics": compact_rerun_metrics,
}


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as plain UTC date-times, so that no reader's zone shifts them."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def registered() -> dict[str, Query]:
    def with_plain_times(query: Query) -> Query:
        return lambda spark, sf_dir: _plain_times(query(spark, sf_dir))

    return {name: with_plain_times(query) for name, query in QUERIES.items()}
