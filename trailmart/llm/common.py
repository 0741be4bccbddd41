"""What the operators on texts share: session settings, table access, stored results."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.session import fresh_path

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
#: Most rows and bytes that one Arrow batch carries to a Python worker.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Of five folds by document id, this one is never learnt from.
FOLDS, HELD_OUT_FOLD = 5, 0


def ready(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and let Python workers import this package.

    The path serves local sessions and shared installations; elsewhere ship the package
    with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{PACKAGE_ROOT}:{known}".rstrip(":")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, options: dict[str, int | bool] | None = None) -> DataFrame:
    """Write to the shared folder and read back: a result that outlives its executors."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_side(df: DataFrame, purpose: str, max_rows: int) -> DataFrame:
    """A side of a join, stored; with a broadcast hint if it has at most ``max_rows`` rows.

    Larger ones are left to a shuffled join. The rows are counted first, up to the bound.
    """
    side = stored(df, purpose)
    small = side.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(side) if small else side


def held_out(doc_id: Column) -> Column:
    """Whether a document's id puts it in the fold that no model learns from."""
    fold = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS
    return fold == HELD_OUT_FOLD


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, max_rows: int
) -> DataFrame:
    """At most ``max_rows`` labelled documents outside the held-out fold: (text, label).

    The rows with the smallest hash of their id, so that the sample is the same for the
    same labels. Only the ids and labels are ordered; as they are at most ``max_rows``,
    they are broadcast to the documents. Null ids, labels and texts are never sampled.
    """
    picked = (
        labels.select(F.col("doc_id").alias("picked_id"), F.col(label).alias("label"))
        .filter(F.col("picked_id").isNotNull() & F.col("label").isNotNull())
        .filter(~held_out(F.col("picked_id")))
        .groupBy("picked_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("picked_id"), "picked_id")
        .limit(max_rows)
    )
    texts = documents.select("doc_id", "text").filter(F.col("text").isNotNull())
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("picked_id"))
    return joined.select("doc_id", "text", "label")


def buffered(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.Table]:
    """Consecutive rows together, until their texts reach ``max_bytes``; batches are cut for it.

    What Arrow keeps of a buffer's memory goes back to the system before the next.
    """
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in _cut(batch, column, max_bytes):
            waiting.append(part)
            size += part.column(column).nbytes
            if size >= max_bytes:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
                pa.default_memory_pool().release_unused()
    if waiting:
        yield pa.Table.from_batches(waiting)


def _cut(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts have up to ``max_bytes`` before the last, whatever that has."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // max_bytes, prepend=0)) + 1
    for start, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
        if start < end:
            yield batch.slice(start, end - start)
