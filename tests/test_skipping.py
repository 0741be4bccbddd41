"""Event times in files: their order, their statistics, and what scans skip by them."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import event, rows_of
from trailmart.functions.intervals import Interval
from trailmart.plans import compaction
from trailmart.schema import EVENTS
from trailmart.sources import tables
from trailmart.sources.tables import read_events, store_events, table_name

DAY = "2024-01-05"
PAGE_ROWS = 100


@pytest.fixture
def small_pages(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.page.row.count.limit", str(PAGE_ROWS))
    yield
    conf.unset("parquet.page.row.count.limit")


@pytest.fixture
def load(spark, schema, events_of):
    """Store a batch of events spread evenly over a day, in no order."""

    def build(batch, rows=2_400, day=DAY, first=0, hours=24):
        base = events_of(event(event_time=f"{day} 00:00:00"))
        spread = base.crossJoin(spark.range(0, rows, 1, 1))
        micros = F.expr(f"{first} * 3600000000 + CAST(id * {hours} * 3600000000 / {rows} AS BIGINT)")
        moved = F.timestamp_micros(F.unix_micros("event_time") + micros)
        spread = spread.withColumn("event_id", F.concat(F.lit(batch), "id"))
        spread = spread.withColumn("event_time", moved).drop("id").orderBy(F.xxhash64("event_id"))
        stamped = spread.withColumn("ingestion_time", F.current_timestamp()).coalesce(1)
        store_events(stamped, table_name(EVENTS, schema), batch)

    return build


def paths(spark, schema):
    found = spark.table(table_name(EVENTS, schema)).select("_metadata.file_path").distinct()
    return sorted(row[0].removeprefix("file:").replace("//", "") for row in found.collect())


def rows_read(df) -> int:
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_files_are_in_the_order_of_time_and_know_their_range(spark, schema, load):
    load("b1", first=3, hours=6)
    (path,) = paths(spark, schema)
    times = pq.read_table(path, columns=["event_time"])["event_time"].to_pylist()
    assert times == sorted(times)
    for name in ("event_time", "ingestion_time"):
        number = pq.read_schema(path).names.index(name)
        statistics = pq.read_metadata(path).row_group(0).column(number).statistics
        assert statistics.has_min_max
    number = pq.read_schema(path).names.index("event_time")
    statistics = pq.read_metadata(path).row_group(0).column(number).statistics
    assert (statistics.min, statistics.max) == (times[0], times[-1])


@pytest.mark.parametrize("compacted", [False, True])
def test_an_hour_reads_a_part_of_its_day(spark, schema, load, small_pages, compacted):
    for batch in ("b1", "b2", "b3"):
        load(batch)
    if compacted:
        compaction.compact_clickstream_events(spark, DAY, "2024-01-06", schema)
        assert len(paths(spark, schema)) == 1
    hour = Interval.between(spark, f"{DAY} 13:00:00", f"{DAY} 14:00:00")
    found = read_events(spark, schema, hour).filter(hour.has_time())
    assert found.count() == 300
    assert rows_read(found) <= 300 + 3 * 2 * PAGE_ROWS < 7_200


def test_days_are_chosen_by_footers_alone(spark, schema, load):
    load("b1", first=0, hours=6)
    load("b2", first=12, hours=6)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(EVENTS, schema)}")
    location = location.filter("col_name = 'Location'").first().data_type
    ranges = compaction.time_ranges(spark, location, [DAY])
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(event_time), MAX(event_time)]" in plan
    assert rows_of(ranges) == rows_of(compaction._read_time_ranges(spark, location, [DAY]))
    late = Interval.between(spark, f"{DAY} 06:00:00", f"{DAY} 13:00:00")
    chosen = compaction.batch_files(spark, late, schema)
    assert rows_of(chosen, "ingest_batch") == [("b2",)]
    both = Interval.between(spark, f"{DAY} 05:59:00", f"{DAY} 13:00:00")
    assert compaction.batch_files(spark, both, schema).count() == 2


def test_files_of_the_old_time_format_are_read_and_chosen(spark, schema, load, monkeypatch):
    def old(session):
        session.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
        return session

    with monkeypatch.context() as patched:
        patched.setattr(tables, "with_time_statistics", old)
        load("b1", first=0, hours=6)
    load("b2", first=12, hours=6)
    assert str(pq.ParquetFile(paths(spark, schema)[0]).schema.column(1).physical_type) == "INT96"
    part = Interval.between(spark, f"{DAY} 05:00:00", f"{DAY} 12:01:00")
    assert rows_of(compaction.batch_files(spark, part, schema), "ingest_batch") == [("b1",), ("b2",)]
    before = rows_of(read_events(spark, schema), "event_id", "event_time")
    compaction.compact_clickstream_events(spark, DAY, "2024-01-06", schema)
    assert len(paths(spark, schema)) == 1
    assert rows_of(read_events(spark, schema), "event_id", "event_time") == before


def test_many_days_are_listed_at_once(spark, schema, load, monkeypatch):
    load("b1", rows=10)
    load("b1", rows=10, day="2024-01-07")
    name, days = table_name(EVENTS, schema), [DAY, "2024-01-06"]
    few = rows_of(tables.partitions(spark, name, EVENTS, days))
    monkeypatch.setattr(tables, "LISTED_DAYS", 1)
    assert few == rows_of(tables.partitions(spark, name, EVENTS, days)) == [(DAY, "b1")]
