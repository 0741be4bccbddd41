"""Aggregates over the events or summaries of one group.

All of them combine on the map side, so a group that holds a large share of the
rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_of(event_type: str) -> Column:
    """Events of one type; a null type counts for none."""
    return F.expr(f"count_if(event_type = '{event_type}')")


def has_any(event_type: str) -> Column:
    return F.expr(f"count_if(event_type = '{event_type}') > 0")


def first_day() -> Column:
    """The UTC date of the group's first event."""
    return F.expr("CAST(min(event_time) AS DATE)")


def first_time_of(event_type: str) -> Column:
    return F.expr(f"min(IF(event_type = '{event_type}', event_time, NULL))")


def quantity_of(event_type: str) -> Column:
    return F.expr(f"coalesce(sum(IF(event_type = '{event_type}', quantity, NULL)), 0L)")


def revenue_of(event_type: str) -> Column:
    """Quantity times price; an event without one of them earns nothing."""
    paid = f"sum(IF(event_type = '{event_type}', quantity * price, NULL))"
    return F.expr(f"CAST(coalesce({paid}, 0) AS DECIMAL(12,2))")


def count_where(flag: str) -> Column:
    """Rows whose flag is true; a null flag counts neither as true nor as false."""
    return F.expr(f"count_if({flag})")


def rate(part: str, whole: str) -> Column:
    """``part / whole`` to four places, 0 for an empty whole."""
    return F.expr(f"CAST(coalesce(try_divide({part}, {whole}), 0) AS DECIMAL(9,4))")
