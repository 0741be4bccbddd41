"""The batch results as Spark SQL over a table given as a DataFrame.

``:start`` and ``:end`` are bound, never spliced into the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from trailmart.functions.intervals import Interval
from trailmart.schema import EVENT_TYPES, PRODUCT_EVENT_TYPES


def _counts(event_types) -> str:
    return ",\n  ".join(f"count_if(event_type = '{t}') AS {t}_count" for t in event_types)


_EVENT_WINDOW = "event_time >= CAST(:start AS TIMESTAMP) AND event_time < CAST(:end AS TIMESTAMP)"
_DATE_WINDOW = (
    "event_date >= CAST(CAST(:start AS TIMESTAMP) AS DATE) "
    "AND event_date < CAST(CAST(:end AS TIMESTAMP) AS DATE)"
)

DAILY_TRAFFIC = f"""
SELECT
  CAST(event_time AS DATE) AS event_date,
  count(*) AS total_events,
  count(DISTINCT user_id) AS unique_users,
  count(DISTINCT session_id) AS unique_sessions,
  {_counts(EVENT_TYPES)}
FROM {{events}}
WHERE {_EVENT_WINDOW}
GROUP BY ALL
"""

SESSIONS = f"""
WITH visits AS (
  SELECT
    session_id,
    user_id,
    min(event_time) AS session_start_time,
    max(event_time) AS session_end_time,
    count(*) AS event_count,
    {_counts(EVENT_TYPES)}
  FROM {{events}}
  WHERE {_EVENT_WINDOW}
  GROUP BY session_id, user_id
)
SELECT
  session_id,
  user_id,
  CAST(session_start_time AS DATE) AS session_date,
  session_start_time,
  session_end_time,
  unix_timestamp(session_end_time) - unix_timestamp(session_start_time)
    AS session_duration_seconds,
  event_count,
  {", ".join(f"{t}_count" for t in EVENT_TYPES)},
  search_count > 0 AS searched,
  product_view_count > 0 AS viewed_product,
  add_to_cart_count > 0 AS added_to_cart,
  checkout_start_count > 0 AS started_checkout,
  purchase_count > 0 AS purchased
FROM visits
"""

_FIRST_TIMES = ",\n    ".join(
    f"min(event_time) FILTER (WHERE event_type = '{t}') AS first_{t}_time"
    for t in PRODUCT_EVENT_TYPES
)

SESSION_PRODUCTS = f"""
WITH visits AS (
  SELECT
    session_id,
    user_id,
    product_id,
    product_name,
    category,
    CAST(min(event_time) AS DATE) AS event_date,
    {_FIRST_TIMES},
    {_counts(PRODUCT_EVENT_TYPES)},
    sum(quantity) FILTER (WHERE event_type = 'add_to_cart') AS added,
    sum(quantity) FILTER (WHERE event_type = 'purchase') AS bought,
    sum(quantity * price) FILTER (WHERE event_type = 'purchase') AS paid
  FROM {{events}}
  WHERE {_EVENT_WINDOW} AND product_id IS NOT NULL
  GROUP BY session_id, user_id, product_id, product_name, category
)
SELECT
  session_id,
  user_id,
  event_date,
  product_id,
  product_name,
  category,
  {", ".join(f"first_{t}_time" for t in PRODUCT_EVENT_TYPES)},
  {", ".join(f"{t}_count" for t in PRODUCT_EVENT_TYPES)},
  product_view_count > 0 AS viewed_product,
  add_to_cart_count > 0 AS added_to_cart,
  remove_from_cart_count > 0 AS removed_from_cart,
  checkout_start_count > 0 AS started_checkout,
  purchase_count > 0 AS purchased,
  coalesce(added, 0L) AS quantity_added,
  coalesce(bought, 0L) AS quantity_purchased,
  CAST(coalesce(paid, 0) AS DECIMAL(12, 2)) AS revenue
FROM visits
"""

PRODUCT_FUNNEL = f"""
WITH stages AS (
  SELECT
    event_date,
    product_id,
    product_name,
    category,
    count_if(viewed_product) AS product_view_session_count,
    count_if(added_to_cart) AS add_to_cart_session_count,
    count_if(started_checkout) AS checkout_start_session_count,
    count_if(purchased) AS purchase_session_count,
    sum(product_view_count) AS product_view_event_count,
    sum(add_to_cart_count) AS add_to_cart_event_count,
    sum(checkout_start_count) AS checkout_start_event_count,
    sum(purchase_count) AS purchase_event_count,
    CAST(sum(revenue) AS DECIMAL(18, 2)) AS revenue
  FROM {{session_products}}
  WHERE {_DATE_WINDOW}
  GROUP BY event_date, product_id, product_name, category
)
SELECT
  *,
  CAST(coalesce(try_divide(add_to_cart_session_count, product_view_session_count), 0)
    AS DECIMAL(9, 4)) AS view_to_cart_rate,
  CAST(coalesce(try_divide(checkout_start_session_count, add_to_cart_session_count), 0)
    AS DECIMAL(9, 4)) AS cart_to_checkout_rate,
  CAST(coalesce(try_divide(purchase_session_count, checkout_start_session_count), 0)
    AS DECIMAL(9, 4)) AS checkout_to_purchase_rate,
  CAST(coalesce(try_divide(purchase_session_count, product_view_session_count), 0)
    AS DECIMAL(9, 4)) AS view_to_purchase_rate
FROM stages
"""

# Purchases are counted per pair before the join, see operators.products.
CART_ABANDONMENT = f"""
WITH in_window AS (
  SELECT *, xxhash64(session_id, product_id) AS pair_hash
  FROM {{session_products}}
  WHERE {_DATE_WINDOW}
),
bought AS (
  SELECT session_id, product_id, count(*) AS purchases
  FROM in_window
  WHERE purchased
  GROUP BY session_id, product_id
),
outcomes AS (
  SELECT c.event_date, c.product_id, c.product_name, c.category, b.purchases
  FROM in_window AS c
  LEFT JOIN (SELECT *, xxhash64(session_id, product_id) AS pair_hash FROM bought) AS b
    USING (session_id, product_id, pair_hash)
  WHERE c.added_to_cart
),
carts AS (
  SELECT
    event_date,
    product_id,
    product_name,
    category,
    sum(coalesce(purchases, 1)) AS cart_session_count,
    sum(coalesce(purchases, 0)) AS purchased_cart_session_count,
    count_if(purchases IS NULL) AS abandoned_cart_session_count
  FROM outcomes
  GROUP BY event_date, product_id, product_name, category
)
SELECT
  *,
  CAST(coalesce(try_divide(abandoned_cart_session_count, cart_session_count), 0)
    AS DECIMAL(9, 4)) AS cart_abandonment_rate
FROM carts
"""


def run_over_events(text: str, events: DataFrame, interval: Interval) -> DataFrame:
    return events.sparkSession.sql(text, args=interval.bounds, events=events)


def run_over_session_products(
    text: str, session_products: DataFrame, interval: Interval
) -> DataFrame:
    return session_products.sparkSession.sql(
        text, args=interval.bounds, session_products=session_products
    )
