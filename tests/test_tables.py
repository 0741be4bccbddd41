import pytest

from tests.conftest import event, rows_of
from trailmart.plans import dataframe_jobs, sql_jobs
from trailmart.schema import (
    CART_ABANDONMENT,
    DAILY_TRAFFIC,
    EVENTS,
    PRODUCT_FUNNEL,
    SESSION_PRODUCTS,
    SESSIONS,
)
from trailmart.sources.tables import (
    append_by_name,
    append_by_position,
    drop_partitions,
    overwrite_partitions,
    partitions,
    read_events,
    read_table,
    store_events,
    table_name,
)

from pyspark.sql import functions as F

TWO_DAYS = ("2024-01-05", "2024-01-07")


@pytest.fixture
def carts(spark):
    def build(*rows):
        values = [f"(DATE'2024-01-{d:02}', '{p}', 'ring', 'x', {n}L, 0L, {n}L, 1.0BD)" for d, p, n in rows]
        return spark.sql(f"SELECT * FROM VALUES {', '.join(values)}").toDF(*CART_ABANDONMENT.columns)

    return build


def test_append_by_name_reorders(spark, schema, carts):
    name = table_name(CART_ABANDONMENT, schema)
    rows = carts((5, "p1", 1))
    append_by_name(rows.select(*reversed(rows.columns)), name, CART_ABANDONMENT)
    append_by_name(rows, name, CART_ABANDONMENT)
    stored = read_table(spark, name, CART_ABANDONMENT)
    assert tuple(stored.columns) == CART_ABANDONMENT.columns
    assert [r[1:5] for r in rows_of(stored)] == [("p1", "ring", "x", 1)] * 2


def test_append_by_name_wants_all_columns(schema, carts):
    name = table_name(CART_ABANDONMENT, schema)
    with pytest.raises(ValueError, match="Columns of"):
        append_by_name(carts((5, "p1", 1)).drop("category"), name, CART_ABANDONMENT)
    with pytest.raises(ValueError, match="Columns of"):
        append_by_name(carts((5, "p1", 1)).withColumn("more", F.lit(1)), name, CART_ABANDONMENT)


def test_append_by_position_ignores_names(spark, schema, carts):
    name = table_name(CART_ABANDONMENT, schema)
    append_by_position(carts((5, "p1", 1), (6, "p2", 3)).toDF(*"abcdefgh"), name, CART_ABANDONMENT)
    stored = read_table(spark, name, CART_ABANDONMENT)
    assert [(str(r[0]), r[1], r[4]) for r in rows_of(stored)] == [
        ("2024-01-05", "p1", 1),
        ("2024-01-06", "p2", 3),
    ]


def test_partitions_are_replaced_and_dropped_one_by_one(spark, schema, carts):
    name = table_name(CART_ABANDONMENT, schema)
    append_by_name(carts((5, "p1", 1), (6, "p1", 1), (7, "p1", 1)), name, CART_ABANDONMENT)
    overwrite_partitions(carts((6, "p9", 1)), name)
    drop_partitions(spark, name, [{"event_date": "2024-01-07"}])
    assert rows_of(spark.table(name), "product_id") == [("p1",), ("p9",)]
    listed = partitions(spark, name, CART_ABANDONMENT)
    assert rows_of(listed) == [("2024-01-05",), ("2024-01-06",)]
    # Nothing of a dropped day comes back when the day is written again.
    append_by_name(carts((7, "p2", 1)), name, CART_ABANDONMENT)
    assert rows_of(spark.table(name), "product_id") == [("p1",), ("p2",), ("p9",)]


def test_dropping_wants_a_managed_table(spark, schema, tmp_path):
    name = f"{schema}.outside"
    spark.sql(f"CREATE TABLE {name} (a INT, d DATE) USING parquet PARTITIONED BY (d) LOCATION '{tmp_path}'")
    with pytest.raises(ValueError, match="not a managed table"):
        drop_partitions(spark, name, [{"d": "2024-01-07"}])


@pytest.fixture
def filled(spark, schema, events_of):
    rows = [
        event("add_to_cart", event_time="2024-01-05 23:50:00"),
        event("purchase", event_time="2024-01-06 00:10:00"),
        event("product_view", session_id="s2", event_time="2024-01-06 12:00:00"),
        event("page_view", event_time="2024-01-09 12:00:00"),
    ]
    stamped = events_of(*rows).withColumn("ingestion_time", F.current_timestamp())
    store_events(stamped, table_name(EVENTS, schema), "load-1")
    return schema


def test_reading_an_interval_prunes_days(spark, filled, interval):
    events = read_events(spark, filled, interval(*TWO_DAYS))
    assert events.count() == 3
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


JOBS = [
    ("build_daily_traffic_summary", DAILY_TRAFFIC, 2),
    ("build_sessions", SESSIONS, 2),
    ("build_session_products", SESSION_PRODUCTS, 2),
    ("build_daily_product_funnel", PRODUCT_FUNNEL, 2),
    ("build_daily_product_cart_abandonment", CART_ABANDONMENT, 1),
]


def test_both_front_ends_store_the_same_rows_in_tables_of_their_own(spark, filled):
    for jobs in (dataframe_jobs, sql_jobs):
        for job, _, _ in JOBS:
            getattr(jobs, job)(spark, *TWO_DAYS, filled)
    for _, layout, rows in JOBS:
        first = read_table(spark, table_name(layout, filled, "_df"), layout)
        second = read_table(spark, table_name(layout, filled), layout)
        assert first.count() == rows
        assert first.dtypes == second.dtypes
        assert rows_of(first) == rows_of(second)


def test_running_again_appends_again(spark, filled):
    for _ in range(2):
        dataframe_jobs.build_sessions(spark, *TWO_DAYS, filled)
    stored = read_table(spark, table_name(SESSIONS, filled, "_df"), SESSIONS)
    assert sorted(stored.toPandas()["session_id"]) == ["s1", "s1", "s2", "s2"]


def test_daily_runs_store_a_midnight_session_twice(spark, filled):
    for start, end in (("2024-01-05", "2024-01-06"), ("2024-01-06", "2024-01-07")):
        sql_jobs.build_session_products(spark, start, end, filled)
    sql_jobs.build_daily_product_cart_abandonment(spark, *TWO_DAYS, filled)
    (row,) = read_table(spark, table_name(CART_ABANDONMENT, filled), CART_ABANDONMENT).collect()
    # The cart of the 5th meets the purchase stored for the 6th.
    assert (row.event_date.day, row.cart_session_count, row.purchased_cart_session_count) == (5, 1, 1)
