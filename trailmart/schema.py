"""Event vocabulary, column lists and table layouts."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T


def _fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of each column of a plain column list."""
    return re.findall(r"(\w+) (\w+(?:\(\d+,\d+\))?)", ddl)


# The event vocabulary of the clickstream.
EVENT_TYPES = (
    "page_view",
    "search",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "checkout_start",
    "purchase",
)
PRODUCT_EVENT_TYPES = (
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "checkout_start",
    "purchase",
)
CART_EVENT_TYPES = ("add_to_cart", "remove_from_cart", "checkout_start", "purchase")

# The JSON document of one event, all fields nullable.
EVENT_DDL = """
    event_id STRING, event_time TIMESTAMP, user_id STRING, session_id STRING,
    event_type STRING, page_url STRING, referrer_url STRING, search_query STRING,
    product_id STRING, product_name STRING, category STRING, cart_id STRING,
    order_id STRING, quantity INT, price DECIMAL(10,2), device_type STRING,
    browser STRING, traffic_source STRING
"""
COLUMN_TYPES = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "INT": T.IntegerType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
}
EVENT_SCHEMA = T.StructType(
    [T.StructField(name, COLUMN_TYPES[kind]) for name, kind in _fields(EVENT_DDL)]
)
EVENT_COLUMNS = tuple(EVENT_SCHEMA.names)

# A stored event carries its arrival time right after the event time.
STORED_EVENT_COLUMNS = EVENT_COLUMNS[:2] + ("ingestion_time",) + EVENT_COLUMNS[2:]

# The record layout of a Kafka topic, as the Kafka source presents it.
KAFKA_RECORD_DDL = """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP
"""

KAFKA_RECORD_COLUMNS = tuple(name for name, _ in _fields(KAFKA_RECORD_DDL))

PRODUCT_DAY_KEYS = ("event_date", "product_id", "product_name", "category")
ABANDONMENT_MEASURES = (
    "cart_session_count",
    "purchased_cart_session_count",
    "abandoned_cart_session_count",
    "cart_abandonment_rate",
)


@dataclass(frozen=True)
class TableLayout:
    """Columns in their declared order, and the columns files are laid out by."""

    name: str
    ddl: str
    partitioned_by: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in _fields(self.ddl))


def _counts(event_types) -> str:
    return ", ".join(f"{name}_count BIGINT" for name in event_types)


EVENTS = TableLayout(
    "retail_clickstream_events",
    """
    event_id STRING, event_time TIMESTAMP, ingestion_time TIMESTAMP, user_id STRING,
    session_id STRING, event_type STRING, page_url STRING, referrer_url STRING,
    search_query STRING, product_id STRING, product_name STRING, category STRING,
    cart_id STRING, order_id STRING, quantity INT, price DECIMAL(10,2),
    device_type STRING, browser STRING, traffic_source STRING,
    event_date DATE, ingest_batch STRING
    """,
    ("event_date", "ingest_batch"),
)

DAILY_TRAFFIC = TableLayout(
    "retail_daily_traffic_summary",
    f"""
    event_date DATE, total_events BIGINT, unique_users BIGINT, unique_sessions BIGINT,
    {_counts(EVENT_TYPES)}
    """,
)

# Traffic by hour, and the dense numbers of ids whose bits its bitmaps hold.
ID_NUMBERS = TableLayout("retail_id_numbers", "id STRING, number BIGINT, kind STRING", ("kind",))
HOURLY_COUNTS = TableLayout(
    "retail_hourly_traffic",
    f"hour INT, total_events BIGINT, {_counts(EVENT_TYPES)}, event_date DATE",
    ("event_date",),
)
HOURLY_IDS = TableLayout(
    "retail_hourly_ids",
    "hour INT, kind STRING, bucket BIGINT, bitmap BINARY, event_date DATE",
    ("event_date",),
)

SESSIONS = TableLayout(
    "retail_sessions",
    f"""
    session_id STRING, user_id STRING, session_date DATE,
    session_start_time TIMESTAMP, session_end_time TIMESTAMP,
    session_duration_seconds BIGINT, event_count BIGINT, {_counts(EVENT_TYPES)},
    searched BOOLEAN, viewed_product BOOLEAN, added_to_cart BOOLEAN,
    started_checkout BOOLEAN, purchased BOOLEAN
    """,
    ("session_date",),
)

SESSION_PRODUCTS = TableLayout(
    "retail_session_products",
    f"""
    session_id STRING, user_id STRING, event_date DATE, product_id STRING,
    product_name STRING, category STRING,
    {", ".join(f"first_{name}_time TIMESTAMP" for name in PRODUCT_EVENT_TYPES)},
    {_counts(PRODUCT_EVENT_TYPES)},
    viewed_product BOOLEAN, added_to_cart BOOLEAN, removed_from_cart BOOLEAN,
    started_checkout BOOLEAN, purchased BOOLEAN,
    quantity_added BIGINT, quantity_purchased BIGINT, revenue DECIMAL(12,2)
    """,
    ("event_date",),
)

PRODUCT_FUNNEL = TableLayout(
    "retail_daily_product_funnel",
    """
    event_date DATE, product_id STRING, product_name STRING, category STRING,
    product_view_session_count BIGINT, add_to_cart_session_count BIGINT,
    checkout_start_session_count BIGINT, purchase_session_count BIGINT,
    product_view_event_count BIGINT, add_to_cart_event_count BIGINT,
    checkout_start_event_count BIGINT, purchase_event_count BIGINT,
    revenue DECIMAL(18,2), view_to_cart_rate DECIMAL(9,4),
    cart_to_checkout_rate DECIMAL(9,4), checkout_to_purchase_rate DECIMAL(9,4),
    view_to_purchase_rate DECIMAL(9,4)
    """,
    ("event_date",),
)

CART_ABANDONMENT = TableLayout(
    "retail_daily_product_cart_abandonment",
    """
    event_date DATE, product_id STRING, product_name STRING, category STRING,
    cart_session_count BIGINT, purchased_cart_session_count BIGINT,
    abandoned_cart_session_count BIGINT, cart_abandonment_rate DECIMAL(9,4)
    """,
    ("event_date",),
)

REJECTED_EVENTS = TableLayout(
    "retail_clickstream_rejects",
    f"{EVENT_DDL.strip()}, validation_error STRING, ingest_batch STRING",
    ("ingest_batch",),
)

# Records whose document could not be read, as they came, for a later attempt.
DEAD_LETTERS = TableLayout(
    "retail_clickstream_dead_letters",
    f"{KAFKA_RECORD_DDL.strip()}, error STRING, ingest_batch STRING",
    ("ingest_batch",),
)

# Each batch that a compaction run writes with those it replaces; lets a rerun finish one.
COMPACTION_LOG = TableLayout(
    "retail_clickstream_compactions",
    "compacted_batch STRING, event_date DATE, ingest_batch STRING",
)

RESULT_TABLES = (
    DAILY_TRAFFIC,
    SESSIONS,
    SESSION_PRODUCTS,
    PRODUCT_FUNNEL,
    CART_ABANDONMENT,
)
