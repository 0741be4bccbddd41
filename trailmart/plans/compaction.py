"""Rewriting small files of the events table into few large ones."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from itertools import groupby

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.schema import COMPACTION_LOG, EVENTS
from trailmart.session import use_utc
from trailmart.sources.tables import (
    DEFAULT_SCHEMA,
    append_by_name,
    drop_partitions,
    overwrite_partitions,
    partitions,
    table_name,
)

# Files below and above these shares of the target size are rewritten.
SMALL_FILE, LARGE_FILE = 0.75, 1.8
TARGET_FILE_BYTES = 512 * 1024 * 1024
MIN_INPUT_FILES = 2
COMPACTED, TAIL = "compacted-", "-tail"
KEYS = "event_date DATE, ingest_batch STRING"
FILES = f"{KEYS}, path STRING, length BIGINT"


def compact_clickstream_events(
    spark: SparkSession,
    data_interval_start: str,
    data_interval_end: str,
    schema: str = DEFAULT_SCHEMA,
    target_file_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
    days_at_once: int = 4,
) -> DataFrame:
    """Bin-pack badly sized files of the interval's batches; no row changes.

    A batch of a day is the unit: all its files are rewritten or none, and the metrics count
    the same files, by day before and after. May run beside the ingestion: only its newest
    batch can still be repeated, and that one is left alone. It must not overlap with the
    jobs that summarise the same days, nor with another compaction.
    """
    interval = Interval.between(use_utc(spark), data_interval_start, data_interval_end)
    finish_interrupted(spark, schema)
    spark.sql(f"TRUNCATE TABLE {table_name(COMPACTION_LOG, schema)}")
    run = COMPACTED + uuid.uuid4().hex
    plans = plan_days(spark, interval, schema, target_file_bytes, min_input_files)
    _log(spark, schema, run, plans)
    packing = _packing_session(spark, target_file_bytes)
    with ThreadPoolExecutor(max_workers=days_at_once) as pool:
        jobs = [
            pool.submit(_compact_day, packing, table_name(EVENTS, schema), run, plan)
            for plan in plans
        ]
        for job in jobs:
            job.result()
    spark.sql(f"TRUNCATE TABLE {table_name(COMPACTION_LOG, schema)}")
    return _metrics(spark, schema, run, plans)


@dataclass(frozen=True)
class DayPlan:
    """What a run does on one day; sizes and paths of files, never rows."""

    day: str
    batches: tuple[str, ...]
    files: int
    size: int
    #: Files that fill no bin; they go to a batch of their own, which the next run takes.
    tail: tuple[str, ...]
    #: Whether anything is written beside the tail.
    fills: bool

    def outputs(self, run: str) -> list[str]:
        return [run] * self.fills + [run + TAIL] * bool(self.tail)


def plan_days(
    spark: SparkSession,
    interval: Interval,
    schema: str,
    target_file_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
) -> list[DayPlan]:
    """The days on which rewriting gives fewer files or splits a large one.

    A batch takes part if most of its bytes lie in badly sized files, so full files are not
    written again because of a late small one.
    """
    files = batch_files(spark, interval, schema).collect()
    plans = []
    for day, of_day in _grouped(files, "event_date"):
        chosen = []
        for batch, own in _grouped(of_day, "ingest_batch"):
            # What a compaction wrote is as small as its row groups let it be.
            most = float("inf") if batch.startswith(COMPACTED) else LARGE_FILE
            bad = sum(
                row.length
                for row in own
                if not SMALL_FILE * target_file_bytes <= row.length <= most * target_file_bytes
            )
            if 2 * bad > sum(row.length for row in own):
                chosen += own
        plan = _plan_day(str(day), chosen, target_file_bytes, min_input_files)
        if plan:
            plans.append(plan)
    return plans


def _grouped(rows: list, column: str) -> list[tuple]:
    rows = sorted(rows, key=lambda row: row[column])
    return [(key, list(group)) for key, group in groupby(rows, key=lambda row: row[column])]


def _plan_day(day: str, rows: list, target: int, min_input_files: int) -> DayPlan | None:
    bins = packed([(row.path, row.length) for row in rows], target)
    splits = any(
        row.length > LARGE_FILE * target and not row.ingest_batch.startswith(COMPACTED)
        for row in rows
    )
    if not splits and (len(rows) < min_input_files or len(bins) >= len(rows)):
        return None
    last = bins[-1]
    whole = {row.path: row.length for row in rows}
    short = sum(size for _, size in last) < SMALL_FILE * target
    apart = short and all(whole[path] == size for path, size in last)
    return DayPlan(
        day=day,
        batches=tuple(sorted({row.ingest_batch for row in rows})),
        files=len(rows),
        size=sum(whole.values()),
        tail=tuple(path for path, _ in last) if apart else (),
        fills=len(bins) > 1 or not apart,
    )


def packed(files: list[tuple[str, int]], target: int) -> list[list[tuple[str, int]]]:
    """The (path, bytes) parts of each task of a scan that packs up to ``target`` bytes.

    A scan cuts large files at the target and fills one task after the other, from the
    largest part to the smallest; only the last task can be far from full.
    """
    parts = [
        (path, min(target, size - start)) for path, size in files for start in range(0, size, target)
    ]
    bins: list[list[tuple[str, int]]] = [[]]
    filled = 0
    for part in sorted(parts, key=lambda part: -part[1]):
        if bins[-1] and filled + part[1] > target:
            bins.append([])
            filled = 0
        bins[-1].append(part)
        filled += part[1]
    return bins


def batch_files(spark: SparkSession, interval: Interval, schema: str) -> DataFrame:
    """(event_date, ingest_batch, path, length) of batches that hold events of the interval.

    On days that lie wholly in the interval the partition decides, on the first and last day,
    where they are cut, the least and greatest event time of the batch's files. Files are
    listed and their footers read, events are not.
    """
    table = table_name(EVENTS, schema)
    stored = partitions(spark, table, EVENTS, interval.days(spark))
    there = stored.select("event_date").distinct()
    found = there.withColumn("whole", interval.holds_day("event_date")).collect()
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    location = location.first().data_type.rstrip("/")
    if not found:
        return spark.createDataFrame([], FILES)
    files = (
        spark.read.format("binaryFile")
        .schema(f"path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, {KEYS}")
        .option("basePath", location)
        .option("pathGlobFilter", "*.parquet")
        .load([f"{location}/event_date={row.event_date}" for row in found])
        .select("event_date", "ingest_batch", "path", "length")
    )
    cut = sorted(row.event_date for row in found if not row.whole)
    touched = spark.createDataFrame(_touched(spark, location, cut, interval), KEYS)
    whole = files.select("event_date", "ingest_batch").filter(interval.holds_day("event_date"))
    taken = whole.union(touched).distinct()
    spared = _repeatable_batches(stored)
    return files.join(taken, ["event_date", "ingest_batch"], "left_semi").join(
        spared, "ingest_batch", "left_anti"
    )


def time_ranges(spark: SparkSession, location: str, days: list[str]) -> DataFrame:
    """(event_date, ingest_batch, least, greatest): event times in microseconds, from footers.

    Spark's pushed-down aggregates know integers, not timestamps, and find a column by its
    place, so the times are read as the integers they are stored as, in their place.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    files = (
        footers.read.schema(f"event_id STRING, event_time BIGINT, {KEYS}")
        .option("basePath", location)
        .parquet(*[f"{location}/event_date={day}" for day in days])
    )
    return files.groupBy("event_date", "ingest_batch").agg(
        F.min("event_time").alias("least"), F.max("event_time").alias("greatest")
    )


def _read_time_ranges(spark: SparkSession, location: str, days: list[str]) -> DataFrame:
    """The same by reading the times, for files that were stored without statistics."""
    files = (
        spark.read.schema(f"event_time TIMESTAMP, {KEYS}")
        .option("basePath", location)
        .parquet(*[f"{location}/event_date={day}" for day in days])
    )
    micros = files.select("event_date", "ingest_batch", F.unix_micros("event_time").alias("time"))
    return micros.groupBy("event_date", "ingest_batch").agg(
        F.min("time").alias("least"), F.max("time").alias("greatest")
    )


def _touched(spark: SparkSession, location: str, days: list[str], interval: Interval) -> list:
    """(event_date, ingest_batch) of the days' batches whose time range meets the interval."""
    if not days:
        return []

    def meeting(ranges: DataFrame) -> list:
        last, first = F.unix_micros(interval.end_time), F.unix_micros(interval.start_time)
        met = ranges.filter((F.col("least") < last) & (F.col("greatest") >= first))
        return [tuple(row) for row in met.select("event_date", "ingest_batch").collect()]

    try:
        return meeting(time_ranges(spark, location, days))
    except (PySparkException, Py4JJavaError):
        return meeting(_read_time_ranges(spark, location, days))


def finish_interrupted(
    spark: SparkSession, schema: str = DEFAULT_SCHEMA, interval: Interval | None = None
) -> None:
    """Complete what an interrupted run had written, or take it back.

    Where all its outputs of a day are there, their inputs are dropped; where only some are,
    these are. With an interval, on its days alone.
    """
    log = spark.table(table_name(COMPACTION_LOG, schema))
    if interval is not None:
        log = log.filter(interval.may_hold_day("event_date"))
    logged = log.withColumn("event_date", F.col("event_date").cast("string")).collect()
    if not logged:
        return
    table, days = table_name(EVENTS, schema), sorted({row.event_date for row in logged})
    stored = {tuple(row) for row in partitions(spark, table, EVENTS, days).collect()}
    unwanted = []
    for day, rows in _grouped(logged, "event_date"):
        outputs = {(day, row.compacted_batch) for row in rows}
        inputs = {(day, row.ingest_batch) for row in rows}
        if outputs <= stored:
            unwanted += sorted(inputs & stored)
        elif inputs <= stored:
            unwanted += sorted(outputs & stored)
    keys = EVENTS.partitioned_by
    drop_partitions(spark, table, [dict(zip(keys, values)) for values in unwanted])


def _repeatable_batches(stored: DataFrame) -> DataFrame:
    """The newest batch of every stream: the only one its checkpoint may not have yet.

    Among the listed days alone, which spares one more batch at most.
    """
    stream_batch = r"^(.*)-(\d{10})$"
    return (
        stored.filter(F.col("ingest_batch").rlike(stream_batch))
        .groupBy(F.regexp_extract("ingest_batch", stream_batch, 1))
        .agg(F.max("ingest_batch").alias("ingest_batch"))
        .select("ingest_batch")
    )


def _log(spark: SparkSession, schema: str, run: str, plans: list[DayPlan]) -> None:
    """Each output of a day with each of its inputs."""
    if not plans:
        return
    rows = [
        (output, date.fromisoformat(plan.day), batch)
        for plan in plans
        for output in plan.outputs(run)
        for batch in plan.batches
    ]
    log = spark.createDataFrame(rows, COMPACTION_LOG.ddl)
    append_by_name(log.coalesce(1), table_name(COMPACTION_LOG, schema), COMPACTION_LOG)


def _packing_session(spark: SparkSession, target_file_bytes: int) -> SparkSession:
    """A session whose scans pack files into tasks of the target size.

    Each such task then writes one file, so data is rewritten without a shuffle.
    """
    packing = use_utc(spark.newSession())
    packing.conf.set("spark.sql.files.maxPartitionBytes", target_file_bytes)
    packing.conf.set("spark.sql.files.openCostInBytes", 0)
    packing.conf.set("spark.sql.files.minPartitionNum", 1)
    return packing


def _compact_day(spark: SparkSession, table: str, run: str, plan: DayPlan) -> None:
    stored = spark.table(table).filter(F.col("event_date") == F.lit(plan.day).cast("date"))
    chosen = stored.filter(F.col("ingest_batch").isin(*plan.batches))
    rewritten = _named_outputs(chosen, run, plan).sortWithinPartitions(
        *EVENTS.partitioned_by, "event_time"
    )
    overwrite_partitions(rewritten, table)
    drop_partitions(
        spark, table, [{"event_date": plan.day, "ingest_batch": name} for name in plan.batches]
    )


def _named_outputs(events: DataFrame, run: str, plan: DayPlan) -> DataFrame:
    """The events under the batch that their file goes to.

    Paths are joined rather than written into the plan, as a bin may hold very many small
    files; the join is a broadcast, for a shuffle would undo the scan's packing, and the paths
    are one bin's of those that the driver has listed.
    """
    if not plan.fills or not plan.tail:
        return events.withColumn("ingest_batch", F.lit(run if plan.fills else run + TAIL))
    # The scan's paths are escaped like the listed ones.
    tail = events.sparkSession.createDataFrame([(path,) for path in plan.tail], "tail_path STRING")
    at = events.withColumn("scanned_path", F.col("_metadata.file_path"))
    joined = at.join(F.broadcast(tail), F.col("scanned_path") == F.col("tail_path"), "left")
    batch = F.when(F.col("tail_path").isNotNull(), run + TAIL).otherwise(run)
    return joined.withColumn("ingest_batch", batch).drop("tail_path", "scanned_path")


def _metrics(spark: SparkSession, schema: str, run: str, plans: list[DayPlan]) -> DataFrame:
    table = table_name(EVENTS, schema)
    before = spark.createDataFrame(
        [(date.fromisoformat(plan.day), plan.files, plan.size) for plan in plans],
        "event_date DATE, rewritten_files BIGINT, rewritten_bytes BIGINT",
    )
    after = (
        spark.table(table)
        .filter(F.col("event_date").isin(*[plan.day for plan in plans]))
        .filter(F.col("ingest_batch").isin(run, run + TAIL))
        .select("event_date", "_metadata.file_path", "_metadata.file_size")
        .distinct()
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("added_files"), F.sum("file_size").alias("added_bytes"))
    )
    return before.join(after, "event_date", "left").select(
        "event_date", "rewritten_files", "added_files", "rewritten_bytes", "added_bytes"
    )
