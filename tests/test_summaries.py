from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import event, rows_of
from trailmart.operators.summaries import daily_traffic, session_products, sessions
from trailmart.plans import sql_text

DAY = ("2024-01-05", "2024-01-06")


def test_unknown_types_count_in_totals_only(events_of, interval):
    events = events_of(event("search"), event(None, user_id=None), event("other", user_id="u2"))
    row = daily_traffic(events, interval(*DAY)).first()
    assert (row.total_events, row.unique_users, row.unique_sessions) == (3, 2, 1)
    assert row.search_count == 1
    assert sum(v for k, v in row.asDict().items() if k.endswith("_count")) == 1
    session = sessions(events, interval(*DAY)).filter("user_id = 'u1'").first()
    assert (session.searched, session.purchased) == (True, False)
    nobody = sessions(events, interval(*DAY)).filter("user_id IS NULL").first()
    assert (nobody.event_count, nobody.searched) == (1, False)


def test_a_session_is_dated_by_its_first_event(events_of, interval):
    midnight = [
        event("product_view", event_time="2024-01-05 23:50:00"),
        event("purchase", event_time="2024-01-06 00:10:00"),
    ]
    whole = sessions(events_of(*midnight), interval("2024-01-05", "2024-01-07")).first()
    assert (str(whole.session_date), whole.session_duration_seconds) == ("2024-01-05", 1200)
    product = session_products(events_of(*midnight), interval("2024-01-05", "2024-01-07")).first()
    assert str(product.event_date) == "2024-01-05"
    assert str(product.first_purchase_time) == "2024-01-06 00:10:00"
    assert product.first_add_to_cart_time is None
    # Each run over a part of the session summarises that part.
    parts = [
        sessions(events_of(*midnight), interval(*bounds)).first()
        for bounds in (DAY, ("2024-01-06", "2024-01-07"))
    ]
    assert [(str(p.session_date), p.event_count) for p in parts] == [
        ("2024-01-05", 1),
        ("2024-01-06", 1),
    ]


def test_durations_count_started_seconds(events_of, interval):
    events = events_of(
        event(event_time="2024-01-05 00:00:00.9"), event(event_time="2024-01-05 00:00:01.1")
    )
    assert sessions(events, interval(*DAY)).first().session_duration_seconds == 1


def test_quantities_and_revenue(events_of, interval):
    events = events_of(
        event("add_to_cart", quantity=3),
        event("add_to_cart", quantity=None),
        event("purchase", quantity=2, price="2.50"),
        event("purchase", quantity=4, price=None),
        event("purchase", quantity=None, price="9.99"),
        event("remove_from_cart", quantity=7),
    )
    row = session_products(events, interval(*DAY)).first()
    assert (row.quantity_added, row.quantity_purchased, row.revenue) == (3, 6, Decimal("5.00"))
    assert (row.purchase_count, row.removed_from_cart, row.viewed_product) == (3, True, False)
    views = session_products(events_of(event("product_view")), interval(*DAY)).first()
    assert (views.quantity_added, views.quantity_purchased, views.revenue) == (0, 0, Decimal(0))


def test_revenue_too_large_for_its_type_raises(events_of, interval):
    huge = [event("purchase", quantity=2_000_000_000, price="99999999.99")]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        session_products(events_of(*huge), interval(*DAY)).collect()


def test_renamed_and_uncategorised_products_are_apart(events_of, interval):
    events = events_of(
        event("product_view"),
        event("product_view", product_name="gold ring"),
        event("product_view", category=None),
        event("product_view", category=None),
        event("page_view"),
    )
    found = session_products(events, interval(*DAY))
    assert rows_of(found, "product_name", "category", "product_view_count") == [
        ("gold ring", "SMALL", 1),
        ("ring", "SMALL", 1),
        ("ring", None, 2),
    ]


def test_repeated_events_count_again(events_of, interval):
    assert daily_traffic(events_of(*[event()] * 3), interval(*DAY)).first().total_events == 3


@pytest.mark.parametrize(
    "operator, text",
    [
        (daily_traffic, sql_text.DAILY_TRAFFIC),
        (sessions, sql_text.SESSIONS),
        (session_products, sql_text.SESSION_PRODUCTS),
    ],
)
def test_sql_form_has_the_same_rows_and_types(events_of, interval, operator, text):
    kinds = ("page_view", "search", "product_view", "add_to_cart", "purchase", "other", None)
    rows = [
        event(kind, user_id=f"u{i % 2}", event_time=f"2024-01-0{5 + i % 2} 1{i}:00:00.{i}")
        for i, kind in enumerate(kinds)
    ]
    rows += [event("purchase", quantity=None), event("checkout_start", category=None)]
    events, both_days = events_of(*rows), interval("2024-01-05", "2024-01-07")
    ours, sql = operator(events, both_days), sql_text.run_over_events(text, events, both_days)
    assert ours.dtypes == sql.dtypes
    assert rows_of(ours) == rows_of(sql)


KIND = st.sampled_from(["page_view", "search", "purchase", "other", None])
SOMEONE = st.sampled_from(["a", "b", "c", None])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 71), KIND, SOMEONE, SOMEONE), max_size=25))
def test_traffic_of_an_interval_is_that_of_its_days(events_of, interval, drawn):
    events = events_of(
        *[
            event(k, user_id=u, session_id=s, event_time=f"2024-01-0{5 + h // 24} {h % 24:02}:30:00")
            for h, k, u, s in drawn
        ]
    )
    whole = daily_traffic(events, interval("2024-01-05", "2024-01-08"))
    first = daily_traffic(events, interval("2024-01-05", "2024-01-06"))
    rest = daily_traffic(events, interval("2024-01-06", "2024-01-08"))
    assert rows_of(whole) == rows_of(first.union(rest))
    by_day = {}
    for hour, kind, user, session in drawn:
        by_day.setdefault(5 + hour // 24, []).append((kind, user, session))
    expected = {
        day: (
            len(rows),
            len({u for _, u, _ in rows} - {None}),
            len({s for _, _, s in rows} - {None}),
            sum(k == "purchase" for k, _, _ in rows),
        )
        for day, rows in by_day.items()
    }
    found = whole.select(
        F.dayofmonth("event_date"), "total_events", "unique_users", "unique_sessions", "purchase_count"
    ).collect()
    assert {row[0]: tuple(row[1:]) for row in found} == expected


def test_a_foreign_event_date_column_filters_nothing(events_of, interval):
    """Only where the layout is known may days be pruned; here the column is a local date."""
    rows = [event(event_id=f"e{n}", event_time=f"2024-01-05 {n:02}:00:00") for n in range(24)]
    local = events_of(*rows).withColumn("event_date", F.expr("CAST(event_time - INTERVAL 8 HOURS AS DATE)"))
    (row,) = daily_traffic(local, interval("2024-01-05", "2024-01-06")).collect()
    assert row.total_events == 24
