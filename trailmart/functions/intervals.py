"""Half-open data intervals over event times and event dates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Interval:
    """``[start, end)``; bounds are timestamp text in the session's zone."""

    start: str
    end: str

    @classmethod
    def between(cls, spark: SparkSession, start, end) -> Interval:
        """Check both bounds before any table is read.

        Text that is no timestamp and reversed bounds raise; equal bounds are an
        empty interval.
        """
        interval = cls(str(start), str(end))
        reversed_bounds = spark.sql(
            "SELECT CAST(:start AS TIMESTAMP) > CAST(:end AS TIMESTAMP) FROM VALUES (0)",
            args={"start": interval.start, "end": interval.end},
        ).first()[0]
        if reversed_bounds is None:
            raise ValueError(f"Bounds are not timestamps: {start!r}, {end!r}")
        if reversed_bounds:
            raise ValueError(f"Interval starts after its end: {start!r}, {end!r}")
        return interval

    @property
    def bounds(self) -> dict[str, str]:
        """Named parameters for ``spark.sql``."""
        return {"start": self.start, "end": self.end}

    @property
    def start_time(self) -> Column:
        return F.lit(self.start).cast("timestamp")

    @property
    def end_time(self) -> Column:
        return F.lit(self.end).cast("timestamp")

    def has_time(self, column: str = "event_time") -> Column:
        return (F.col(column) >= self.start_time) & (F.col(column) < self.end_time)

    def has_date(self, column: str | Column = "event_date") -> Column:
        """Both bounds are cut to dates, so a partial last day is left out."""
        day = F.col(column) if isinstance(column, str) else column
        return (day >= self.start_time.cast("date")) & (day < self.end_time.cast("date"))

    def may_hold_day(self, column: str = "event_date") -> Column:
        """Days that can hold an event time of the interval, for partition pruning."""
        last_day = (self.end_time - F.expr("INTERVAL 1 MICROSECOND")).cast("date")
        return (F.col(column) >= self.start_time.cast("date")) & (F.col(column) <= last_day)

    def holds_day(self, column: str = "event_date") -> Column:
        """Days that lie wholly in the interval."""
        day = F.col(column).cast("timestamp")
        return (day >= self.start_time) & (day + F.expr("INTERVAL 1 DAY") <= self.end_time)

    def days(self, spark: SparkSession) -> list[str]:
        """The days that can hold an event time of the interval, as text."""
        found = spark.sql(
            """
            WITH bounds AS (
                SELECT CAST(CAST(:start AS TIMESTAMP) AS DATE) AS first,
                       CAST(CAST(:end AS TIMESTAMP) - INTERVAL 1 MICROSECOND AS DATE) AS last
            )
            SELECT explode(sequence(first, last)) AS day FROM bounds WHERE first <= last
            """,
            args=self.bounds,
        )
        return [str(row.day) for row in found.collect()]
