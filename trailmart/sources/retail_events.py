"""Retail clickstream events derived from the ``events`` and ``part`` tables.

The same projection exists as SQL for the checks in ``trailmart.registry.oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.schema import CART_EVENT_TYPES
from trailmart.session import use_utc

# Fixed values of the mapping.
HALF_DAY = 43_200
THREE_DAYS = 259_200
PRODUCTS_PER_USER = 3
DEVICES = ("desktop", "mobile", "tablet")
BROWSERS = ("chrome", "safari", "firefox", "edge")
TRAFFIC_SOURCES = ("direct", "search", "email", "social", "ads")

EVENTS_DDL = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
    props STRING
"""
PART_DDL = "p_partkey BIGINT, p_name STRING, p_type STRING"

RAW = {
    "event_number": "event_id",
    "user": "user_id",
    "event_time": "CAST(ts AS TIMESTAMP)",
    "source_type": "event_type",
    "value": "value",
    "k": r"CAST(regexp_extract(props, r'(\d+)', 1) AS INT)",
}
EVENT_TYPE = """
    CASE source_type
      WHEN 'view' THEN IF(k % 2 = 0, 'page_view', 'product_view')
      WHEN 'click' THEN IF(k % 3 = 0, 'remove_from_cart', 'add_to_cart')
      WHEN 'signup' THEN 'checkout_start'
      WHEN 'purchase' THEN 'purchase'
      ELSE IF(k % 2 = 0, 'search', 'product_view')
    END
"""
IS_PRODUCT = "event_type NOT IN ('page_view', 'search')"
IS_CART = f"event_type IN {CART_EVENT_TYPES}"


def _pick(choices: tuple[str, ...]) -> str:
    return f"element_at(array{choices}, k % {len(choices)} + 1)"


FIELDS = {
    "event_id": "concat('e', event_number)",
    "event_time": "event_time",
    "user_id": "concat('u', user)",
    "session_id": "concat('s', visit)",
    "event_type": "event_type",
    "page_url": "concat('/page/', k)",
    "referrer_url": "IF(k % 4 = 0, NULL, concat('/page/', k - 1))",
    "search_query": "IF(event_type = 'search', IF(k % 10 = 0, '  ', concat('q', k)), NULL)",
    "product_id": f"IF({IS_PRODUCT}, concat('p', product_key), NULL)",
    "product_name": f"IF({IS_PRODUCT}, p_name, NULL)",
    "category": f"IF({IS_PRODUCT} AND product_key % 7 != 0, p_type, NULL)",
    "cart_id": f"IF({IS_CART}, concat('c', visit), NULL)",
    "order_id": "IF(event_type = 'purchase' AND k % 17 != 0, concat('o', event_number), NULL)",
    "quantity": f"IF({IS_CART} AND k % 11 != 0, 1 + k % 5, NULL)",
    "price": f"IF({IS_PRODUCT} AND k % 13 != 0, CAST(value AS DECIMAL(10,2)), NULL)",
    "device_type": _pick(DEVICES),
    "browser": _pick(BROWSERS),
    "traffic_source": _pick(TRAFFIC_SOURCES),
}


def clickstream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 columns of an event, in their declared order and types."""
    use_utc(spark)
    stored = spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")
    raw = stored.selectExpr(*_named(RAW))
    keyed = raw.selectExpr(
        "*",
        f"{EVENT_TYPE} AS event_type",
        f"user * {PRODUCTS_PER_USER} + event_number % {PRODUCTS_PER_USER} AS pick",
        f"concat(user, '-', floor((unix_timestamp(event_time) - {HALF_DAY}) / {THREE_DAYS}))"
        " AS visit",
    )
    # Few products a user, so that carts meet purchases, spread over all of them.
    parts = spark.read.schema(PART_DDL).parquet(f"{sf_dir}/part.parquet")
    products = parts.agg(F.max("p_partkey") + 1).scalar()
    keyed = keyed.withColumn("p_partkey", F.try_mod("pick", products))
    joined = keyed.join(parts, "p_partkey", "left")
    return joined.withColumnRenamed("p_partkey", "product_key").selectExpr(*_named(FIELDS))


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in expressions.items()]
