"""SQL for DuckDB, one statement per query, written against the test tables."""

from __future__ import annotations

START, END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
LATE_CUT = "2024-01-19 12:00:00"

CLICKSTREAM = """
raw AS (
  SELECT event_id AS n, ts, user_id AS u, event_type AS source_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         (user_id * 3 + event_id % 3) % (SELECT max(p_partkey) + 1 FROM part) AS pk,
         CAST(floor((epoch(date_trunc('second', ts)) - 43200) / 259200) AS BIGINT) AS b
  FROM events
),
typed AS (
  SELECT raw.*, p_name, p_type,
         CASE source_type
           WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'page_view' ELSE 'product_view' END
           WHEN 'click' THEN CASE WHEN k % 3 = 0 THEN 'remove_from_cart' ELSE 'add_to_cart' END
           WHEN 'signup' THEN 'checkout_start'
           WHEN 'purchase' THEN 'purchase'
           ELSE CASE WHEN k % 2 = 0 THEN 'search' ELSE 'product_view' END
         END AS t
  FROM raw LEFT JOIN part ON pk = p_partkey
),
clickstream AS (
  SELECT 'e' || n AS event_id, ts AS event_time, 'u' || u AS user_id,
         's' || u || '-' || b AS session_id, t AS event_type,
         '/page/' || k AS page_url,
         CASE WHEN k % 4 <> 0 THEN '/page/' || (k - 1) END AS referrer_url,
         CASE WHEN t = 'search' THEN CASE WHEN k % 10 = 0 THEN '  ' ELSE 'q' || k END END
           AS search_query,
         CASE WHEN t NOT IN ('page_view', 'search') THEN 'p' || pk END AS product_id,
         CASE WHEN t NOT IN ('page_view', 'search') THEN p_name END AS product_name,
         CASE WHEN t NOT IN ('page_view', 'search') AND pk % 7 <> 0 THEN p_type END AS category,
         CASE WHEN t NOT IN ('page_view', 'search', 'product_view')
              THEN 'c' || u || '-' || b END AS cart_id,
         CASE WHEN t = 'purchase' AND k % 17 <> 0 THEN 'o' || n END AS order_id,
         CASE WHEN t NOT IN ('page_view', 'search', 'product_view') AND k % 11 <> 0
              THEN CAST(1 + k % 5 AS INTEGER) END AS quantity,
         CASE WHEN t NOT IN ('page_view', 'search') AND k % 13 <> 0
              THEN CAST(value AS DECIMAL(10,2)) END AS price,
         ['desktop', 'mobile', 'tablet'][k % 3 + 1] AS device_type,
         ['chrome', 'safari', 'firefox', 'edge'][k % 4 + 1] AS browser,
         ['direct', 'search', 'email', 'social', 'ads'][k % 5 + 1] AS traffic_source
  FROM typed
)"""

TYPES = (
    "page_view",
    "search",
    "product_view",
    "add_to_cart",
    "remove_from_cart",
    "checkout_start",
    "purchase",
)


def _counts(types) -> str:
    return ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}_count" for t in types)


def _any(event_type: str, name: str) -> str:
    return f"coalesce(bool_or(event_type = '{event_type}'), false) AS {name}"


def _within(column: str, start: str, end: str, kind: str = "TIMESTAMP") -> str:
    return f"{column} >= {kind} '{start}' AND {column} < {kind} '{end}'"


def daily_traffic(start: str = START, end: str = END) -> str:
    return f"""
  SELECT CAST(event_time AS DATE) AS event_date, count(*) AS total_events,
         count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions, {_counts(TYPES)}
  FROM clickstream WHERE {_within("event_time", start, end)} GROUP BY 1"""


def sessions(start: str = START, end: str = END) -> str:
    flags = ", ".join(
        _any(t, name)
        for t, name in (
            ("search", "searched"),
            ("product_view", "viewed_product"),
            ("add_to_cart", "added_to_cart"),
            ("checkout_start", "started_checkout"),
            ("purchase", "purchased"),
        )
    )
    return f"""
  SELECT session_id, user_id, CAST(min(event_time) AS DATE) AS session_date,
         min(event_time) AS session_start_time, max(event_time) AS session_end_time,
         CAST(epoch(date_trunc('second', max(event_time)))
            - epoch(date_trunc('second', min(event_time))) AS BIGINT)
           AS session_duration_seconds,
         count(*) AS event_count, {_counts(TYPES)}, {flags}
  FROM clickstream WHERE {_within("event_time", start, end)}
  GROUP BY session_id, user_id"""


def session_products(start: str = START, end: str = END, also_by: str = "") -> str:
    firsts = ", ".join(
        f"min(event_time) FILTER (event_type = '{t}') AS first_{t}_time" for t in TYPES[2:]
    )
    flags = ", ".join(
        _any(t, name)
        for t, name in (
            ("product_view", "viewed_product"),
            ("add_to_cart", "added_to_cart"),
            ("remove_from_cart", "removed_from_cart"),
            ("checkout_start", "started_checkout"),
            ("purchase", "purchased"),
        )
    )
    return f"""
  SELECT session_id, user_id, CAST(min(event_time) AS DATE) AS event_date,
         product_id, product_name, category, {firsts}, {_counts(TYPES[2:])}, {flags},
         CAST(coalesce(sum(quantity) FILTER (event_type = 'add_to_cart'), 0) AS BIGINT)
           AS quantity_added,
         CAST(coalesce(sum(quantity) FILTER (event_type = 'purchase'), 0) AS BIGINT)
           AS quantity_purchased,
         CAST(coalesce(sum(quantity * price) FILTER (event_type = 'purchase'), 0)
           AS DECIMAL(12,2)) AS revenue
  FROM clickstream
  WHERE {_within("event_time", start, end)} AND product_id IS NOT NULL
  GROUP BY session_id, user_id, product_id, product_name, category{also_by}"""


def _rate(part: str, whole: str) -> str:
    return (
        f"CAST(CASE WHEN {whole} > 0 THEN {part} / {whole} ELSE 0 END AS DECIMAL(9,4))"
    )


def product_funnel(start: str = START, end: str = END) -> str:
    stages = (
        ("product_view", "viewed_product"),
        ("add_to_cart", "added_to_cart"),
        ("checkout_start", "started_checkout"),
        ("purchase", "purchased"),
    )
    counts = ", ".join(
        [f"count(*) FILTER ({flag}) AS {t}_session_count" for t, flag in stages]
        + [f"CAST(sum({t}_count) AS BIGINT) AS {t}_event_count" for t, _ in stages]
    )
    rates = ", ".join(
        f"{_rate(f'{a}_session_count', f'{b}_session_count')} AS {name}"
        for a, b, name in (
            ("add_to_cart", "product_view", "view_to_cart_rate"),
            ("checkout_start", "add_to_cart", "cart_to_checkout_rate"),
            ("purchase", "checkout_start", "checkout_to_purchase_rate"),
            ("purchase", "product_view", "view_to_purchase_rate"),
        )
    )
    return f"""
  SELECT *, {rates} FROM (
    SELECT event_date, product_id, product_name, category, {counts},
           CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
    FROM session_products WHERE {_within("event_date", start[:10], end[:10], "DATE")}
    GROUP BY event_date, product_id, product_name, category)"""


def cart_abandonment(start: str = START, end: str = END) -> str:
    window = _within("event_date", start[:10], end[:10], "DATE")
    return f"""
  SELECT *, {_rate("abandoned_cart_session_count", "cart_session_count")}
              AS cart_abandonment_rate
  FROM (
    SELECT c.event_date, c.product_id, c.product_name, c.category,
           count(*) AS cart_session_count,
           count(*) FILTER (p.bought) AS purchased_cart_session_count,
           count(*) FILTER (p.bought IS NULL) AS abandoned_cart_session_count
    FROM (SELECT * FROM session_products WHERE {window} AND added_to_cart) c
    LEFT JOIN (SELECT session_id, product_id, true AS bought
               FROM session_products WHERE {window} AND purchased) p
      ON c.session_id = p.session_id AND c.product_id = p.product_id
    GROUP BY c.event_date, c.product_id, c.product_name, c.category)"""


def validation_case() -> str:
    product = "event_type IN ('product_view','add_to_cart','remove_from_cart','checkout_start','purchase')"
    cart = "event_type IN ('add_to_cart','remove_from_cart','checkout_start','purchase')"

    def blank(column):
        return f"({column} IS NULL OR length(trim({column})) = 0)"

    rules = [
        (blank(c), f"{c} is required")
        for c in ("event_id", "user_id", "session_id", "event_type", "page_url")
    ]
    rules.append(("event_time IS NULL", "event_time is required"))
    rules += [
        (blank(c), f"{c} is required") for c in ("device_type", "browser", "traffic_source")
    ]
    known = ", ".join(f"'{t}'" for t in TYPES)
    rules.append((f"event_type NOT IN ({known})", "event_type is not supported"))
    rules.append(
        (
            f"event_type = 'search' AND {blank('search_query')}",
            "search_query is required for search events",
        )
    )
    rules += [
        (f"{product} AND {blank(c)}", f"{c} is required for product events")
        for c in ("product_id", "product_name", "category")
    ]
    rules += [
        (
            f"{product} AND (price IS NULL OR price < 0)",
            "price must be nonnegative for product events",
        ),
        (f"{cart} AND {blank('cart_id')}", "cart_id is required for cart events"),
        (
            f"{cart} AND (quantity IS NULL OR quantity <= 0)",
            "quantity must be positive for cart events",
        ),
        (
            f"event_type = 'purchase' AND {blank('order_id')}",
            "order_id is required for purchase events",
        ),
    ]
    return "CASE " + " ".join(f"WHEN {c} THEN '{m}'" for c, m in rules) + " END"


# One way to break each rule, in the order of the rules.
BROKEN_FIELDS = (
    ("event_id", "''"),
    ("user_id", "NULL"),
    ("session_id", "' '"),
    ("event_type", "''"),
    ("page_url", "NULL"),
    ("event_time", "NULL"),
    ("device_type", "'  '"),
    ("browser", "''"),
    ("traffic_source", "NULL"),
    ("event_type", "'refund'"),
    ("search_query", "''"),
    ("product_id", "NULL"),
    ("product_name", "''"),
    ("category", "' '"),
    ("price", "-1"),
    ("cart_id", "NULL"),
    ("quantity", "0"),
    ("order_id", "''"),
)
# Of so many records by number the first ones cannot be read, one way for each remainder.
UNREADABLE_STEP, UNREADABLE_WAYS = 40, 7
MALFORMED = "document is not a clickstream event"
NARROW_START, NARROW_END = "2024-01-08 00:00:00", "2024-01-12 00:00:00"


def _with(*named: str) -> str:
    return "WITH " + ",\n".join(named) + "\n"


def _session_products_cte(end: str = END, also_by: str = "", where: str = "") -> str:
    rows = session_products(START, end, also_by)
    if where:
        rows = f"SELECT * FROM ({rows}) WHERE {where}"
    return f"session_products AS ({rows})"


def _broken_events() -> str:
    """The events with one field of each broken, by the number in its id."""
    turn = f"CAST(substr(event_id, 2) AS BIGINT) % {len(BROKEN_FIELDS) + 1}"
    ways: dict[str, str] = {}
    for place, (field, value) in enumerate(BROKEN_FIELDS):
        ways[field] = ways.get(field, "") + f" WHEN {place} THEN {value}"
    replaced = ", ".join(
        f"CASE {turn} {cases} ELSE {field} END AS {field}" for field, cases in ways.items()
    )
    return f"broken AS (SELECT * REPLACE ({replaced}) FROM clickstream)"


def _differing_days(other_session_products: str) -> str:
    """The days whose abandonment is another one over other session products."""
    return f"""
  WITH one AS ({_with(CLICKSTREAM, _session_products_cte())} {cart_abandonment()}),
  other AS ({_with(CLICKSTREAM, other_session_products)} {cart_abandonment()})
  SELECT event_date FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM other) UNION
  SELECT event_date FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM one)"""


def oracle_statements() -> dict[str, str]:
    events = _with(CLICKSTREAM)
    stored = _with(CLICKSTREAM, _session_products_cte())
    traffic = events + daily_traffic()
    funnel = stored + product_funnel()
    abandonment = stored + cart_abandonment()
    abandoned = f"{stored.rstrip()},\nabandonment AS ({cart_abandonment()})\n"
    fewer = "product_id <> 'p3' AND event_date <> DATE '2024-01-10'"
    with_error = (
        events.rstrip()
        + f",\nmarked AS (SELECT *, {validation_case()} AS validation_error FROM clickstream)\n"
    )
    valid = with_error + "SELECT * EXCLUDE (validation_error) FROM marked WHERE validation_error IS NULL"
    number = "CAST(substr(event_id, 2) AS BIGINT)"
    unread = f"{number} % {UNREADABLE_STEP} < {UNREADABLE_WAYS}"
    narrow = _within("event_date", NARROW_START[:10], NARROW_END[:10], "DATE")
    statements = {
        "clickstream_events": events + "SELECT * FROM clickstream",
        "events_in_interval": events
        + f"SELECT * FROM clickstream WHERE {_within('event_time', START, END)}",
        "cart_abandonment_daily_runs": _with(
            CLICKSTREAM, _session_products_cte(also_by=", CAST(event_time AS DATE)")
        )
        + cart_abandonment(),
        "subday_interval": stored
        + "SELECT count(*) AS funnel_rows FROM ("
        + product_funnel("2024-01-10 06:00:00", "2024-01-10 18:00:00")
        + ")",
        "merge_deletes": _with(CLICKSTREAM, _session_products_cte(where=fewer))
        + cart_abandonment(),
        "merge_rerun_days": "SELECT DATE '2024-01-05' AS event_date WHERE false",
        "merge_late_days": _differing_days(
            f"session_products AS ({session_products(START, LATE_CUT)})"
        ),
        "merge_deletes_days": _differing_days(_session_products_cte(where=fewer)),
        "merge_null_keys": abandoned + "SELECT * FROM abandonment WHERE category IS NULL",
        # Of a key stored twice, null in part, both rows go and one is inserted.
        "merge_duplicates": abandoned
        + "SELECT * FROM abandonment UNION ALL "
        + "SELECT * FROM abandonment WHERE category IS NOT NULL",
        "merge_outside_window": _with(
            CLICKSTREAM,
            _session_products_cte(),
            f"everything AS ({cart_abandonment()})",
        )
        + f"""SELECT * FROM everything WHERE NOT ({narrow})
              UNION ALL
              SELECT * FROM ({cart_abandonment(NARROW_START, NARROW_END)})
              WHERE product_id <> 'p3'""",
        "validation_errors": with_error
        + "SELECT event_id, validation_error AS message FROM marked "
        + "WHERE validation_error IS NOT NULL",
        "validation_error_counts": with_error
        + "SELECT validation_error AS message, count(*) AS events FROM marked "
        + "WHERE validation_error IS NOT NULL GROUP BY 1",
        "validation_all_rules": _with(CLICKSTREAM, _broken_events())
        + f"SELECT {validation_case()} AS message, count(*) AS events FROM broken GROUP BY 1",
        "stream_stamped": with_error
        + "SELECT count(*) AS stamped_events FROM marked WHERE validation_error IS NULL",
        "sessions_daily_runs": events
        + sessions().replace("GROUP BY session_id", "GROUP BY CAST(event_time AS DATE), session_id"),
        "session_products_daily_runs": events
        + session_products(also_by=", CAST(event_time AS DATE)"),
        # Each load has one file a day, and a day with several gets one.
        "compact_metrics": events
        + f"""SELECT CAST(event_time AS DATE) AS event_date, count(DISTINCT CASE
                WHEN event_type IN ('add_to_cart', 'remove_from_cart') THEN 1
                WHEN event_type IN ('checkout_start', 'purchase') THEN 2 ELSE 0 END)
                AS rewritten_files, CAST(1 AS BIGINT) AS added_files
              FROM clickstream WHERE {_within('event_time', START, END)}
              GROUP BY 1 HAVING rewritten_files > 1""",
        "compact_rerun_metrics": "SELECT DATE '2024-01-05' AS event_date, "
        + "CAST(0 AS BIGINT) AS rewritten_files, CAST(0 AS BIGINT) AS added_files WHERE false",
        "stream_dead_letters": events
        + f"""SELECT {number} AS "offset", 'clickstream' AS topic, event_time AS "timestamp",
                     '{MALFORMED}' AS error
              FROM clickstream WHERE {unread}""",
        "stream_past_dead_letters": f"{valid} AND NOT {unread}",
        "stream_dead_letters_again": with_error
        + "SELECT validation_error AS message, count(*) AS events FROM marked "
        + f"WHERE {unread} GROUP BY 1",
        "stream_rule_counts": with_error
        + f"""SELECT CASE WHEN {unread} THEN '{MALFORMED}' ELSE validation_error END AS message,
                     count(*) AS events
              FROM marked WHERE validation_error IS NOT NULL OR {unread} GROUP BY 1""",
        "stream_rejects": with_error + "SELECT * FROM marked WHERE validation_error IS NOT NULL",
    }
    same_as = {
        traffic: ("daily_traffic", "daily_traffic_sql", "traffic_from_hours"),
        f"{traffic} UNION ALL {daily_traffic()}": ("append_twice", "append_twice_sql"),
        events + sessions(): ("sessions", "sessions_sql", "sessions_job", "sessions_job_sql"),
        events + session_products(): (
            "session_products",
            "session_products_sql",
            "session_products_job",
            "session_products_job_sql",
        ),
        funnel: (
            "product_funnel",
            "product_funnel_sql",
            "product_funnel_job",
            "product_funnel_job_sql",
        ),
        abandonment: (
            "cart_abandonment",
            "cart_abandonment_sql",
            "cart_abandonment_job",
            "cart_abandonment_job_sql",
            "merge_job",
            "merge_job_sql",
            "merge_rerun",
            "merge_late_events",
        ),
        events + "SELECT * FROM clickstream": ("json_decode", "compact_rows"),
        valid: ("stream_ingest", "stream_restart", "stream_accepted", "stream_timed"),
    }
    for statement, names in same_as.items():
        statements.update(dict.fromkeys(names, statement))
    return statements
