"""Upsert of a complete result for an interval of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPEAT_CHUNK = 10_000


def merged_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """What the merged days hold, given the target's and the source's rows of those days.

    Source rows update the target rows of equal keys or are inserted, and target rows
    that no source row matches go. An updated row is all source, so of the target only
    the number of rows per key is needed: a key stored twice stays stored twice. Null
    keys equal nothing: their old rows go and their new rows are inserted.
    """
    counted = _counted(target, source, keys, measures)
    return _repeated(counted, F.col("copies")).select(*keys, *measures)


def differing_days(
    target: DataFrame, source: DataFrame, keys: Sequence[str], measures: Sequence[str], day: str
) -> DataFrame:
    """(day, remains): the days whose merged rows are not the stored ones, as multisets, and
    whether they have rows after the merge.

    Both sides are reduced to fingerprints by day. The merged rows are not made for it: a row
    counts as often as it would be there.
    """
    columns = [*keys, *measures]
    merged = _fingerprints(_counted(target, source, keys, measures), day, columns, "merged")
    stored = _fingerprints(target.withColumn("copies", F.lit(1)), day, columns, "stored")
    both = merged.join(stored, day, "full_outer")
    different = both.filter(~F.col("merged").eqNullSafe(F.col("stored")))
    return different.select(day, F.col("merged").isNotNull().alias("remains"))


def _counted(
    target: DataFrame, source: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Source rows with how often each is there after the merge, as ``copies``."""
    stored = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    matched = source.join(stored, list(keys), "left")
    return matched.select(*keys, *measures, F.coalesce("copies", F.lit(1)).alias("copies"))


def _fingerprints(rows: DataFrame, day: str, columns: Sequence[str], name: str) -> DataFrame:
    """(day, name): the number of a day's rows and two sums of their hashes, in any order.

    Hashes skip nulls, so where they are is hashed as well.
    """
    nulls = [F.col(column).isNull() for column in columns]
    copies = F.col("copies").cast("decimal(18,0)")
    sums = [
        F.sum(F.xxhash64(F.lit(turn), *columns, *nulls).cast("decimal(20,0)") * copies)
        for turn in (0, 1)
    ]
    return rows.groupBy(day).agg(F.struct(F.sum("copies"), *sums).alias(name))


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys that more than one source row would update."""
    return repeated_keys(source, keys).join(target.select(*keys).distinct(), list(keys), "left_semi")


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of several source rows; null keys are left out, they update nothing."""
    rows = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return rows.filter("rows > 1").drop("rows")


def _repeated(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times, with bounded arrays however many copies there are."""
    first, size = F.lit(0).cast("bigint"), F.lit(REPEAT_CHUNK).cast("bigint")
    chunks = F.sequence(first, F.floor((copies - 1) / size))
    in_chunks = df.withColumn("copies", copies).withColumn("chunk", F.explode(chunks))
    last = F.least(F.col("copies") - F.col("chunk") * size, size)
    return in_chunks.withColumn("copy", F.explode(F.sequence(first + 1, last)))
