import datetime
import glob
import json
import os
from decimal import Decimal
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import VALID, event, rows_of
from trailmart.registry import queries
from trailmart.schema import EVENT_COLUMNS, EVENTS, KAFKA_RECORD_DDL, STORED_EVENT_COLUMNS
from trailmart.session import fresh_path
from trailmart.sources.kafka import as_records, read_kafka_events, read_record_files
from trailmart.sources.tables import create_table, partitions, read_events, store_events, table_name
from trailmart.streaming import ingest
from trailmart.streaming.progress import run_until, watched

NOW = {"availableNow": True}


@pytest.fixture
def records_of(spark):
    def build(*values):
        rows = [(None, None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, KAFKA_RECORD_DDL)

    return build


def with_fields(**fields) -> str:
    return json.dumps({**VALID, "event_time": "2024-01-05T10:00:00.000001Z", **fields})


def test_documents_become_typed_columns(records_of):
    text = with_fields(price=1.235, user_id=7, quantity=3, unknown="x", page_url=None)
    row = ingest.parse_events(records_of(text)).first()
    assert (row.price, row.user_id, row.quantity) == (Decimal("1.24"), "7", 3)
    assert (row.page_url, row.category) == (None, None)
    assert "unknown" not in row.asDict()
    assert row.event_time.microsecond == 1


@pytest.mark.parametrize("text", [None, "", "  "])
def test_empty_documents_are_events_without_id(records_of, text):
    parsed = ingest.parse_and_mark_events(records_of(text)).first()
    assert parsed.validation_error == "event_id is required"


@pytest.mark.parametrize(
    "text",
    [
        '{"event_id": "e1"',
        "null",
        "[]",
        with_fields(event_time="5th of January"),
        with_fields(quantity=1.5),
        with_fields(quantity="2"),
        with_fields(price=123456789012.0),
    ],
)
def test_documents_that_do_not_fit_fail(records_of, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        ingest.parse_events(records_of(text)).collect()


def test_stored_columns_and_stamp(spark, records_of):
    stored = ingest.parse_and_validate_events(records_of(with_fields()))
    assert tuple(stored.columns) == STORED_EVENT_COLUMNS
    before = spark.sql("SELECT current_timestamp()").first()[0]
    assert stored.first().ingestion_time >= before
    broken = ingest.parse_and_validate_events(records_of(with_fields(browser=" ")))
    with pytest.raises(Exception, match="Invalid clickstream event: browser is required"):
        broken.collect()


def test_topic_options(spark, monkeypatch):
    """The connector is not on the test class path, so only what is asked of it is seen."""
    with pytest.raises(Exception, match="kafka"):
        read_kafka_events(spark, "host:9092", "clicks")

    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return seen

    class Session:
        readStream = Reader()

    assert read_kafka_events(Session(), "host:9092", "clicks") == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "clicks",
        "startingOffsets": "earliest",
    }


def test_required_settings(monkeypatch):
    monkeypatch.setenv("KAFKA_TOPIC", " clicks ")
    assert ingest.required_setting("KAFKA_TOPIC") == "clicks"
    monkeypatch.setenv("KAFKA_TOPIC", "  ")
    with pytest.raises(ValueError, match="value for KAFKA_TOPIC"):
        ingest.required_setting("KAFKA_TOPIC")
    assert ingest.checkpoint_location(named("/state//")) == "/state/retail-clickstream-events"
    for blank in (None, "", " "):
        with pytest.raises(ValueError, match="needs spark.checkpoint.dir"):
            ingest.checkpoint_location(named(blank))


def named(folder):
    """A session that names the folder; a real one cannot change it while it runs."""
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder or default))


class Stream:
    """A topic of record files, its checkpoint and a schema to ingest into."""

    def __init__(self, spark, schema, events_of):
        self.spark, self.schema, self.events_of = spark, schema, events_of
        self.records = fresh_path(spark, "records")
        self.checkpoint = fresh_path(spark, "checkpoint")
        self.late = False

    def produce(self, *rows):
        as_records(self.events_of(*rows)).coalesce(1).write.mode("append").parquet(self.records)

    def ingest(self, checkpoint=None):
        records = read_record_files(self.spark, self.records, files_per_batch=1)
        events = ingest.parse_and_validate_events(records)
        query = ingest.start_clickstream_ingestion(
            events, checkpoint or self.checkpoint, self.schema, trigger=NOW
        )
        ingest.run_to_end(query)
        return query

    def stored(self):
        return sorted(row.event_id for row in read_events(self.spark, self.schema).collect())


@pytest.fixture
def stream(spark, schema, events_of):
    return Stream(spark, schema, events_of)


def test_a_restart_goes_on_where_the_last_run_ended(stream):
    stream.produce(event(event_id="a"), event(event_id="b", event_time="2024-01-07 01:00:00"))
    first = stream.ingest()
    assert first.name == "retail-clickstream-events" and not first.isActive
    stream.produce(event(event_id="c"))
    stream.ingest()
    stream.ingest()
    assert stream.stored() == ["a", "b", "c"]
    days = partitions(stream.spark, table_name(EVENTS, stream.schema), EVENTS)
    assert {row.event_date for row in days.collect()} == {"2024-01-05", "2024-01-07"}


def test_a_new_checkpoint_reads_all_again(stream):
    stream.produce(event(event_id="a"))
    stream.ingest()
    stream.ingest(fresh_path(stream.spark, "checkpoint"))
    assert stream.stored() == ["a", "a"]


def test_a_repeated_batch_replaces_itself(spark, stream, events_of):
    stream.produce(event(event_id="a"))
    stream.ingest()
    name = ingest.batch_name(spark, stream.checkpoint, 0)
    again = events_of(event(event_id="a")).withColumn("ingestion_time", F.current_timestamp())
    store_events(again, table_name(EVENTS, stream.schema), name)
    assert stream.stored() == ["a"]


def test_an_invalid_event_stops_the_query_and_keeps_earlier_batches(stream):
    stream.produce(event(event_id="a"))
    stream.ingest()
    stream.produce(event(event_id="b", page_url=None))
    for _ in range(2):
        with pytest.raises(Exception, match="page_url is required"):
            stream.ingest()
    assert stream.stored() == ["a"]


def test_rejects_can_be_routed(spark, stream):
    rejects = table_name(ingest.REJECTED_EVENTS, stream.schema)
    create_table(spark, rejects, ingest.REJECTED_EVENTS)
    stream.produce(event(event_id="a"), event(event_id="b", browser=""), event(event_id="c"))
    marked = ingest.parse_and_mark_events(read_record_files(spark, stream.records))
    ingest.run_to_end(
        ingest.start_routed_ingestion(marked, stream.checkpoint, stream.schema, trigger=NOW)
    )
    assert stream.stored() == ["a", "c"]
    assert rows_of(spark.table(rejects), "event_id", "validation_error") == [
        ("b", "browser is required")
    ]


def test_the_stamp_is_the_time_of_the_batch(stream):
    started = datetime.datetime.now() - datetime.timedelta(days=1)
    stream.produce(event(event_id="a"), event(event_id="b"))
    stream.ingest()
    stamps = {r.ingestion_time for r in read_events(stream.spark, stream.schema).collect()}
    assert len(stamps) == 1 and stamps.pop() > started


def test_a_running_query_is_stopped_on_the_way_out():
    class Query:
        isActive, stopped = True, False

        def awaitTermination(self):
            raise KeyboardInterrupt

        def stop(self):
            self.stopped = True

    query = Query()
    with pytest.raises(KeyboardInterrupt):
        ingest.run_to_end(query)
    assert query.stopped


UNREADABLE = [
    '{"event_id": "e1"',
    "null",
    "[]",
    f"[{json.dumps(VALID)}]",
    "text",
    with_fields(event_time="5th of January"),
    with_fields(quantity=1.5),
    with_fields(quantity="2"),
    with_fields(price=123456789012.0),
]
READABLE = [
    None,
    "",
    "  ",
    "{}",
    with_fields(user_id=7),
    with_fields(price=1.235),
    with_fields(event_time=1_704_448_800),
    with_fields(unknown={"a": [1]}),
    with_fields() + "{}",
]


@pytest.mark.parametrize("text", UNREADABLE)
def test_what_would_fail_the_ingestion_is_a_dead_letter(records_of, text):
    records = records_of(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        ingest.parse_events(records).collect()
    marked = ingest.parse_and_mark_events(records).first()
    assert marked.validation_error == "document is not a clickstream event"
    assert marked.dead_letter == records.first()


@pytest.mark.parametrize("text", READABLE)
def test_what_can_be_read_is_read_alike(records_of, text):
    marked = ingest.parse_and_mark_events(records_of(text))
    assert marked.first().dead_letter is None
    assert marked.select(*EVENT_COLUMNS).first() == ingest.parse_events(records_of(text)).first()


def routed(stream, marked, trigger=NOW):
    return ingest.start_routed_ingestion(marked, stream.checkpoint, stream.schema, trigger=trigger)


def test_unreadable_documents_do_not_stop_the_routed_stream(spark, stream, records_of):
    stream.produce(event(event_id="a"), event(event_id="b", browser=""))
    bad = records_of(*UNREADABLE).coalesce(1)
    bad.write.mode("append").parquet(stream.records)
    stream.produce(event(event_id="c"))
    records = read_record_files(spark, stream.records, files_per_batch=1)
    with watched(spark) as progress:
        ingest.run_to_end(routed(stream, ingest.parse_and_mark_events(records)))
    assert stream.stored() == ["a", "c"]
    kept = ingest.dead_letters(spark, stream.schema)
    assert rows_of(kept) == rows_of(bad)
    assert progress.refused == {
        "browser is required": 1,
        "document is not a clickstream event": len(UNREADABLE),
    }
    assert [rows for _, rows, _ in progress.batches] == [2, len(UNREADABLE), 1]
    again = ingest.parse_and_mark_events(kept)
    assert again.filter("dead_letter IS NULL").isEmpty()


def test_a_repeated_batch_replaces_its_letters(spark, stream, records_of):
    records_of(*UNREADABLE[:2]).write.mode("append").parquet(stream.records)
    marked = ingest.parse_and_mark_events(read_record_files(spark, stream.records))
    query = routed(stream, marked)
    ingest.run_to_end(query)
    commits = f"{stream.checkpoint}/commits/0".removeprefix("file:")
    os.remove(commits)
    os.remove(os.path.join(os.path.dirname(commits), ".0.crc"))
    ingest.run_to_end(routed(stream, marked))
    assert ingest.dead_letters(spark, stream.schema).count() == 2


def test_timed_triggers_are_stopped_between_batches(spark, stream):
    for name in "abcd":
        stream.produce(event(event_id=name))
    events = ingest.parse_and_validate_events(
        read_record_files(spark, stream.records, files_per_batch=1)
    )
    with watched(spark) as progress:
        query = ingest.start_clickstream_ingestion(
            events, stream.checkpoint, stream.schema, trigger={"processingTime": "1 second"}
        )
        run_until(query, lambda: len(progress.batches) >= 3)
    assert not query.isActive
    done = [number for number, _, _ in progress.batches]
    assert done == list(range(len(done))) and 3 <= len(done) <= 4
    assert stream.stored() == list("abcd")[: len(done)]
    stream.ingest()
    assert stream.stored() == list("abcd")


def test_the_default_trigger_waits_for_its_minute(spark, stream):
    stream.produce(event(event_id="a"))
    events = ingest.parse_and_validate_events(read_record_files(spark, stream.records))
    with watched(spark) as progress:
        query = ingest.start_clickstream_ingestion(events, stream.checkpoint, stream.schema)
        started = datetime.datetime.now()
        run_until(query, lambda: progress.batches and waited(started, 3, stream))
    assert len(progress.batches) == 1 and stream.stored() == ["a"]


def waited(since, seconds, stream):
    """Whether so much time went by; something new has come to the topic meanwhile."""
    if not stream.late:
        stream.produce(event(event_id="b"))
        stream.late = True
    return (datetime.datetime.now() - since).total_seconds() > seconds


def test_a_failing_query_is_not_waited_for(spark, stream):
    stream.produce(event(event_id="a", page_url=None))
    events = ingest.parse_and_validate_events(read_record_files(spark, stream.records))
    query = ingest.start_clickstream_ingestion(
        events, stream.checkpoint, stream.schema, trigger={"processingTime": "1 second"}
    )
    with pytest.raises(Exception, match="page_url is required"):
        run_until(query, lambda: False)
    assert not query.isActive


def test_a_batch_of_one_large_file_has_work_for_many_tasks(spark, events_of, monkeypatch):
    """A scan's task reads whole row groups, so a file needs several to be dealt out."""
    path = fresh_path(spark, "records")
    monkeypatch.setattr(queries, "RECORD_GROUP_BYTES", 32 << 10)
    numbered = events_of(event()).crossJoin(spark.range(20_000).select(F.col("id").alias("n")))
    events = numbered.withColumn("event_id", F.sha2(F.col("n").cast("string"), 256))
    queries._put_records(as_records(events).coalesce(1), path)
    (name,) = glob.glob(f"{path.removeprefix('file:')}/*.parquet")
    groups = pq.ParquetFile(name).metadata
    rows = [groups.row_group(n).num_rows for n in range(groups.num_row_groups)]
    assert sum(rows) == 20_000 and max(rows) < 5_000


def test_only_dead_letters_are_made_documents_again(spark, schema, events_of, monkeypatch):
    events = events_of(*[event(event_id=f"e{n}") for n in range(45)])
    monkeypatch.setattr(queries, "clickstream_events", lambda spark, folder: events)
    again = queries.stream_dead_letters_again(spark, "")
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    after, _, joined = plan.lower().replace("_", "").partition("leftsemi")
    assert "tojson" in after
    assert joined and "tojson" not in joined
    assert [row.asDict() for row in again.collect()] == [{"message": None, "events": 12}]
