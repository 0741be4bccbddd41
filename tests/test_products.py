from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows_of
from trailmart.operators.products import cart_abandonment, product_funnel
from trailmart.plans import sql_text

COLUMNS = """
    session_id STRING, event_date DATE, product_id STRING, product_name STRING, category STRING,
    viewed_product BOOLEAN, added_to_cart BOOLEAN, started_checkout BOOLEAN, purchased BOOLEAN,
    product_view_count BIGINT, add_to_cart_count BIGINT, checkout_start_count BIGINT,
    purchase_count BIGINT, revenue DECIMAL(12,2)
"""
WEEK = ("2024-01-05", "2024-01-12")


@pytest.fixture(scope="session")
def stored(spark):
    """Session products from (session, day of January, product, category, flags) tuples."""

    def build(*rows):
        import datetime

        full = [
            (s, datetime.date(2024, 1, d), p, "ring", c, *flags, 1, 2, 3, 4, Decimal("1.25"))
            for s, d, p, c, flags in rows
        ]
        return spark.createDataFrame(full, COLUMNS)

    return build


# viewed, added, started checkout, purchased
CARTED = (True, True, False, False)
BOUGHT = (True, True, True, True)
BOUGHT_ONLY = (False, False, False, True)


def test_funnel_counts_and_rates(stored, interval):
    rows = [("s1", 5, "p1", "x", CARTED), ("s2", 5, "p1", "x", BOUGHT)]
    rows += [(f"v{i}", 5, "p1", "x", (True, False, False, False)) for i in range(30)]
    rows += [("s3", 5, "p2", "x", BOUGHT_ONLY), ("s4", 5, "p2", "x", (None,) * 4)]
    p1, p2 = product_funnel(stored(*rows), interval(*WEEK)).orderBy("product_id").collect()
    assert (p1.product_view_session_count, p1.add_to_cart_session_count) == (32, 2)
    assert (p1.product_view_event_count, p1.revenue) == (32, Decimal("40.00"))
    assert (p1.view_to_cart_rate, p1.view_to_purchase_rate) == (Decimal("0.0625"), Decimal("0.0313"))
    assert (p2.product_view_session_count, p2.purchase_session_count) == (0, 1)
    assert (p2.view_to_cart_rate, p2.checkout_to_purchase_rate) == (Decimal(0), Decimal(0))


def test_rates_may_exceed_one(stored, interval):
    rows = [("s1", 5, "p1", "x", CARTED)]
    rows += [(f"b{i}", 5, "p1", "x", (False, True, True, True)) for i in range(3)]
    row = product_funnel(stored(*rows), interval(*WEEK)).first()
    assert row.view_to_cart_rate == Decimal("4.0000")


def test_a_subday_interval_selects_nothing(stored, interval):
    rows = stored(("s1", 5, "p1", "x", BOUGHT))
    noon = interval("2024-01-05 06:00:00", "2024-01-05 18:00:00")
    assert product_funnel(rows, noon).isEmpty()
    assert cart_abandonment(rows, noon).isEmpty()


def test_pairs_stored_on_several_days_meet_each_other(stored, interval):
    rows = stored(
        ("s1", 5, "p1", "x", CARTED),
        ("s1", 6, "p1", "x", BOUGHT),
        ("s1", 7, "p1", "x", BOUGHT_ONLY),
        ("s2", 5, "p1", "x", CARTED),
    )
    found = rows_of(cart_abandonment(rows, interval(*WEEK)))
    # Two purchase rows meet the cart rows of both days; s2 bought nothing.
    assert [(r[0].day, *r[4:]) for r in found] == [
        (5, 3, 2, 1, Decimal("0.3333")),
        (6, 2, 2, 0, Decimal("0.0000")),
    ]


def test_null_pairs_meet_nothing(stored, interval):
    rows = stored((None, 5, "p1", None, BOUGHT), ("s1", 5, "p1", None, (True, None, None, None)))
    (row,) = cart_abandonment(rows, interval(*WEEK)).collect()
    assert (row.category, row.cart_session_count, row.abandoned_cart_session_count) == (None, 1, 1)


@pytest.mark.parametrize(
    "operator, text",
    [(product_funnel, sql_text.PRODUCT_FUNNEL), (cart_abandonment, sql_text.CART_ABANDONMENT)],
)
def test_sql_form_has_the_same_rows_and_types(stored, interval, operator, text):
    rows = stored(
        ("s1", 5, "p1", "x", CARTED),
        ("s1", 6, "p1", None, BOUGHT),
        (None, 6, "p1", None, BOUGHT),
        ("s2", 11, "p2", "x", BOUGHT_ONLY),
        ("s2", 12, "p2", "x", BOUGHT),
    )
    ours = operator(rows, interval(*WEEK))
    sql = sql_text.run_over_session_products(text, rows, interval(*WEEK))
    assert ours.dtypes == sql.dtypes
    assert rows_of(ours) == rows_of(sql)


ROW = st.tuples(
    st.sampled_from(["s1", "s2", None]),
    st.integers(4, 13),
    st.sampled_from(["p1", "p2"]),
    st.sampled_from(["x", None]),
    st.tuples(*[st.sampled_from([True, False, None])] * 4),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=20))
def test_abandonment_equals_joining_row_by_row(stored, interval, drawn):
    carts, bought = Counter(), Counter()
    inside = [row for row in drawn if 5 <= row[1] < 12]
    for s, d, p, c, flags in inside:
        if not flags[1]:
            continue
        met = sum(1 for s2, _, p2, _, f in inside if f[3] and s is not None and (s2, p2) == (s, p))
        carts[(d, p, c)] += max(1, met)
        bought[(d, p, c)] += met
    found = {
        (r.event_date.day, r.product_id, r.category): (
            r.cart_session_count,
            r.purchased_cart_session_count,
            r.abandoned_cart_session_count,
        )
        for r in cart_abandonment(stored(*drawn), interval(*WEEK)).collect()
    }
    assert found == {k: (n, bought[k], n - bought[k]) for k, n in carts.items()}
