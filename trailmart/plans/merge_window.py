"""The merge of a result into a table laid out by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.operators.merge import (
    ambiguous_keys,
    differing_days,
    merged_rows,
    repeated_keys,
)
from trailmart.schema import TableLayout
from trailmart.session import fresh_path, remove
from trailmart.sources.tables import (
    drop_partitions,
    overwrite_partitions,
    partitions,
    together,
)


def merge_window(
    source: DataFrame,
    name: str,
    layout: TableLayout,
    keys: Sequence[str],
    measures: Sequence[str],
    interval: Interval,
) -> list[str]:
    """Make the interval's days of a table equal to ``source``; leave other days alone.

    Matched rows are updated, new ones inserted, vanished ones deleted. Only days whose rows
    change are written; their names are returned. Days are replaced one by one rather than
    all at once; after an interruption the same call completes the merge.
    """
    spark = source.sparkSession
    (day,) = layout.partitioned_by
    if day not in keys:
        raise ValueError(f"Rows are matched within their days, so {day} has to be a key")
    path = fresh_path(spark, "merge-source")
    try:
        return _merge(_written(source, day, path), name, layout, keys, measures, interval)
    finally:
        remove(spark, path)


def _merge(
    result: DataFrame,
    name: str,
    layout: TableLayout,
    keys: Sequence[str],
    measures: Sequence[str],
    interval: Interval,
) -> list[str]:
    spark = result.sparkSession
    (day,) = layout.partitioned_by
    outside = result.filter(~F.coalesce(interval.has_date(day), F.lit(False)))
    if not outside.isEmpty():
        raise ValueError(f"Source rows lie outside [{interval.start}, {interval.end})")

    target = spark.table(name).filter(interval.has_date(day)).select(*keys, *measures)
    source = result.select(*[F.col(f.name).cast(f.dataType) for f in target.schema])
    if not (
        repeated_keys(source, keys).isEmpty() or ambiguous_keys(target, source, keys).isEmpty()
    ):
        raise ValueError(f"Several source rows match one row of {name}")

    # Days, never rows, reach the driver.
    different = differing_days(target, source, keys, measures, day)
    different = different.withColumn(day, F.col(day).cast("string")).collect()
    written = [row[day] for row in different if row.remains]
    if written:
        in_days = F.col(day).isin(written)
        merged = merged_rows(target.filter(in_days), source.filter(in_days), keys, measures)
        overwrite_partitions(together(merged, [day]), name)
    stored_days = partitions(spark, name, layout, interval.days(spark)).filter(
        interval.has_date(F.col(day).try_cast("date"))
    )
    kept_days = result.select(F.col(day).cast("string")).distinct()
    emptied = stored_days.join(kept_days, day, "left_anti").collect()
    drop_partitions(spark, name, [row.asDict() for row in emptied])
    return sorted({*written, *(row[day] for row in emptied)})


def _written(source: DataFrame, day: str, path: str) -> DataFrame:
    """The source as files in the shared folder, so that its work is done once."""
    together(source, [day]).write.partitionBy(day).parquet(path)
    return source.sparkSession.read.schema(source.schema).parquet(path)
