from unittest import mock

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, rows_of
from trailmart.plans import compaction, dataframe_jobs, sql_jobs
from trailmart.plans.compaction import compact_clickstream_events, finish_interrupted
from trailmart.schema import COMPACTION_LOG, EVENTS, SESSIONS
from trailmart.sources.tables import (
    DATAFRAME_SUFFIX,
    drop_partitions,
    partitions,
    read_events,
    store_events,
    table_name,
)

WEEK = ("2024-01-05", "2024-01-12")


class Store:
    def __init__(self, spark, schema, events_of):
        self.spark, self.schema, self.events_of = spark, schema, events_of
        self.table = table_name(EVENTS, schema)

    def load(self, batch, *days, files=1):
        rows = [
            event(event_id=f"{batch}-{d}-{i}", event_time=f"2024-01-{d:02} 10:00:00")
            for d in days
            for i in range(20)
        ]
        stamped = self.events_of(*rows).withColumn("ingestion_time", F.current_timestamp())
        store_events(stamped.repartition(files), self.table, batch)

    def load_bulk(self, batch, day=5, rows=4_000):
        """One file whose size is that of its rows, as two of them together have twice it."""
        base = self.events_of(event(event_time=f"2024-01-{day:02} 10:00:00"))
        text = F.expr("concat(sha2(uuid(), 512), sha2(uuid(), 512))")
        bulk = base.crossJoin(self.spark.range(0, rows, 1, 1)).drop("id")
        bulk = bulk.withColumns({"event_id": F.expr("uuid()"), "page_url": text})
        stamped = bulk.withColumn("ingestion_time", F.current_timestamp()).coalesce(1)
        store_events(stamped, self.table, batch)

    def count(self):
        return read_events(self.spark, self.schema).agg(
            F.count("*"), F.sum(F.xxhash64("event_id").cast("decimal(20,0)"))
        ).first()

    def files(self):
        found = self.spark.table(self.table).select("event_date", "_metadata.file_path").distinct()
        return {r[0].day: r[1] for r in found.groupBy("event_date").count().collect()}

    def paths(self, batches=None):
        found = self.spark.table(self.table)
        if batches is not None:
            found = found.filter(F.col("ingest_batch").isin(*batches))
        return {row[0] for row in found.select("_metadata.file_path").distinct().collect()}

    def largest(self):
        return self.spark.table(self.table).agg(F.max("_metadata.file_size")).first()[0]

    def rows(self):
        return rows_of(read_events(self.spark, self.schema))

    def batches(self):
        return {tuple(r) for r in partitions(self.spark, self.table, EVENTS).collect()}

    def compact(self, *window, **options):
        metrics = compact_clickstream_events(self.spark, *(window or WEEK), self.schema, **options)
        return {r.event_date.day: (r.rewritten_files, r.added_files) for r in metrics.collect()}


@pytest.fixture
def store(spark, schema, events_of):
    return Store(spark, schema, events_of)


def test_small_files_of_the_interval_become_one_a_day(store):
    for i in range(4):
        store.load(f"load-{i}", 5, 6, 20, files=2)
    store.load("load-9", 8)
    rows = store.rows()
    assert store.compact() == {5: (8, 1), 6: (8, 1)}
    assert store.files() == {5: 1, 6: 1, 8: 1, 20: 8}
    assert store.rows() == rows
    # A second run finds nothing to do, and later loads are taken in.
    assert store.compact() == {}
    store.load("load-10", 5)
    assert store.compact() == {5: (2, 1)}
    assert len(store.rows()) == len(rows) + 20


def test_only_files_with_events_of_the_interval_are_taken(store):
    for i in range(2):
        store.load(f"load-{i}", 5)
    assert store.compact("2024-01-05 11:00:00", "2024-01-06") == {}
    assert store.compact("2024-01-05 09:00:00", "2024-01-05 10:00:01") == {5: (2, 1)}


def test_well_sized_files_stay(store):
    for i in range(2):
        store.load(f"load-{i}", 5)
    (size,) = store.spark.table(store.table).select("_metadata.file_size").distinct().first()
    assert store.compact(target_file_bytes=size) == {}
    assert store.compact(min_input_files=3) == {}


def test_large_days_get_several_files(store):
    for i in range(6):
        store.load(f"load-{i}", 5)
    size = store.spark.table(store.table).agg(F.max("_metadata.file_size")).first()[0]
    assert store.compact(target_file_bytes=2 * size) == {5: (6, 3)}
    assert len(store.rows()) == 120


@pytest.mark.parametrize("times", [1.5, 2, 2.5])
def test_a_second_run_finds_nothing_to_do(store, times):
    for i in range(5):
        store.load_bulk(f"load-{i}")
    rows, target = store.count(), int(times * store.largest())
    first = store.compact(target_file_bytes=target)
    assert first == ({} if times == 1.5 else {5: (5, 3)})
    assert store.compact(target_file_bytes=target) == {}
    assert store.count() == rows


def test_files_that_shrink_are_rewritten_only_while_they_get_fewer(store):
    """Small files are mostly footer, so two together are far below twice their size."""
    for i in range(12):
        store.load(f"load-{i}", 5)
    rows, target, runs = store.rows(), int(2.5 * store.largest()), []
    while metrics := store.compact(target_file_bytes=target):
        runs.append(metrics[5])
    assert runs and all(added < rewritten for rewritten, added in runs)
    assert store.rows() == rows


def test_a_late_file_leaves_full_files_alone(store):
    for i in range(5):
        store.load_bulk(f"load-{i}")
    target = 2 * store.largest()
    assert store.compact(target_file_bytes=target) == {5: (5, 3)}
    full = {name for _, name in store.batches() if not name.endswith("-tail")}
    kept = store.paths(full)
    store.load("late", 5)
    assert store.compact(target_file_bytes=target) == {5: (2, 1)}
    assert len(kept) == 2 and kept <= store.paths()


def test_metrics_count_the_files_that_vanish(store):
    """A batch is the unit: where one of its files holds an event, all are rewritten."""
    store.load("load-0", 5, files=4)
    store.load("load-1", 5, files=3)
    before = store.paths()
    metrics = store.compact("2024-01-05 10:00:00", "2024-01-05 11:00:00")
    gone, new = before - store.paths(), store.paths() - before
    assert metrics == {5: (len(gone), len(new))} == {5: (7, 1)}


def test_large_files_are_split_once(store):
    store.load("load-0", 5)
    target = store.largest() // 3
    store.compact(target_file_bytes=target)
    assert store.compact(target_file_bytes=target) == {}


def test_packing_is_that_of_a_scan():
    files = [("a", 5), ("b", 25), ("c", 4), ("d", 3), ("e", 9)]
    assert compaction.packed(files, 10) == [
        [("b", 10)], [("b", 10)], [("e", 9)], [("a", 5), ("b", 5)], [("c", 4), ("d", 3)],
    ]


def test_days_outside_the_interval_are_not_listed(store):
    for i in range(2):
        store.load(f"load-{i}", 5, 20)
    with mock.patch.object(compaction, "partitions", wraps=partitions) as listed:
        assert store.compact() == {5: (2, 1)}
    assert {day for call in listed.call_args_list for day in call.args[3]} <= {
        f"2024-01-{day:02}" for day in range(5, 12)
    }


def test_the_log_is_empty_after_a_run(store):
    for i in range(2):
        store.load(f"load-{i}", 5)
    store.compact()
    assert store.spark.table(table_name(COMPACTION_LOG, store.schema)).isEmpty()


def test_outputs_that_are_only_partly_there_are_taken_back(store):
    for i in range(5):
        store.load(f"load-{i}", 5)
    rows, target = store.rows(), 2 * store.largest()
    with mock.patch.object(compaction, "drop_partitions", side_effect=KeyboardInterrupt):
        with pytest.raises(KeyboardInterrupt):
            store.compact(target_file_bytes=target)
    (tail,) = [name for _, name in store.batches() if name.endswith("-tail")]
    drop_partitions(store.spark, store.table, [{"event_date": "2024-01-05", "ingest_batch": tail}])
    finish_interrupted(store.spark, store.schema)
    assert store.rows() == rows
    assert not any(name.startswith("compacted-") for _, name in store.batches())


def test_summaries_after_an_interrupted_run_are_not_doubled(store):
    for i in range(3):
        store.load(f"load-{i}", 5)
    with mock.patch.object(compaction, "drop_partitions", side_effect=KeyboardInterrupt):
        with pytest.raises(KeyboardInterrupt):
            store.compact()
    for jobs, suffix in ((dataframe_jobs, DATAFRAME_SUFFIX), (sql_jobs, "")):
        jobs.build_sessions(store.spark, *WEEK, store.schema)
        built = store.spark.table(table_name(SESSIONS, store.schema, suffix))
        assert built.agg(F.sum("event_count")).first()[0] == 60


def test_the_newest_batch_of_each_stream_is_left_alone(store):
    for stream in ("aaa", "bbb"):
        for number in (8, 9, 10):
            store.load(f"{stream}-{number:010d}", 5)
    store.compact()
    left = {name for _, name in store.batches() if not name.startswith("compacted-")}
    assert left == {"aaa-0000000010", "bbb-0000000010"}


def test_an_interrupted_run_is_finished_by_the_next(store):
    for i in range(3):
        store.load(f"load-{i}", 5)
    rows = store.rows()
    with mock.patch.object(compaction, "drop_partitions", side_effect=KeyboardInterrupt):
        with pytest.raises(KeyboardInterrupt):
            # finish_interrupted drops nothing yet, so the first drop is that of the day
            with mock.patch.object(compaction, "finish_interrupted"):
                store.compact()
    assert len(store.rows()) == 2 * len(rows)
    store.compact()
    assert store.rows() == rows
    assert store.files() == {5: 1}


def test_a_run_that_fails_before_writing_loses_nothing(store):
    for i in range(3):
        store.load(f"load-{i}", 5)
    rows = store.rows()
    with mock.patch.object(compaction, "overwrite_partitions", side_effect=OSError):
        with pytest.raises(OSError):
            store.compact()
    assert store.rows() == rows
    assert store.compact() == {5: (3, 1)}
    assert store.rows() == rows
