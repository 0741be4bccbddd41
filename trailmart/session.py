"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates are cut from timestamps in UTC, whatever the cluster's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def with_time_statistics(spark: SparkSession) -> SparkSession:
    """Times are stored as 64-bit microseconds from now on.

    Files then hold the least and greatest time of each row group and page, by which scans
    skip; the format that Spark writes by default has neither.
    """
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def named_folder(spark: SparkSession) -> str:
    """The shared folder as the cluster names it, empty where it names none."""
    return (spark.conf.get(CHECKPOINT_DIR, None) or "").strip().rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or what was set later.

    Only a local session without either gets a folder of its own.
    """
    context = spark.sparkContext
    folder = named_folder(spark) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"Set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trailmart-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever store holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as files in the shared folder: to be read twice, made once."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
