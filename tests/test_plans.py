"""What the physical plans read, shuffle and split."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL_TABLES, event, rows_of
from trailmart.operators.products import cart_abandonment, product_funnel
from trailmart.operators.summaries import daily_traffic, session_products, sessions
from trailmart.plans import sql_text
from trailmart.registry.queries import QUERIES
from trailmart.schema import EVENTS, SESSION_PRODUCTS
from trailmart.session import fresh_path
from trailmart.sources.kafka import as_records
from trailmart.sources.tables import read_events, store_events, table_name
from trailmart.streaming.ingest import parse_and_validate_events

WEEK = ("2024-01-05", "2024-01-12")


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def shuffles(text: str) -> int:
    tree = text.split("\n\n\n")[0]
    return len(re.findall(r"Exchange \(\d+\)", tree)) - len(
        re.findall(r"BroadcastExchange \(\d+\)", tree)
    )


@pytest.fixture
def events(spark, schema, events_of):
    stamped = events_of(event("purchase")).withColumn("ingestion_time", F.current_timestamp())
    store_events(stamped, table_name(EVENTS, schema), "load-1")
    return spark.table(table_name(EVENTS, schema))


@pytest.mark.parametrize(
    "operator, columns, expected_shuffles",
    [
        (daily_traffic, 4, 2),
        (sessions, 4, 1),
        (session_products, 9, 1),
    ],
)
def test_summaries_scan_only_what_they_need(
    spark, schema, events, interval, operator, columns, expected_shuffles
):
    """Over what the jobs read: the days of the interval, by partition."""
    week = interval(*WEEK)
    text = plan(operator(read_events(spark, schema, week), week))
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert len(re.findall(r"\w+:", read)) == columns
    assert "GreaterThanOrEqual(event_time" in text and "LessThan(event_time" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date", text)
    assert shuffles(text) == expected_shuffles
    assert "Python" not in text and "Cartesian" not in text


def test_sql_text_pushes_its_bounds_down(events, interval):
    text = plan(sql_text.run_over_events(sql_text.SESSIONS, events, interval(*WEEK)))
    assert "GreaterThanOrEqual(event_time" in text and "LessThan(event_time" in text


@pytest.fixture
def stored(spark, schema):
    return spark.table(table_name(SESSION_PRODUCTS, schema))


def test_reports_read_their_days_only(stored, interval):
    for report in (product_funnel, cart_abandonment):
        text = plan(report(stored, interval(*WEEK)))
        assert re.search(r"PartitionFilters: \[isnotnull\(event_date.*>= 2024-01-05", text)
        assert "Cartesian" not in text and "NestedLoop" not in text
    assert shuffles(plan(product_funnel(stored, interval(*WEEK)))) == 1


@pytest.fixture
def eager_splitting(spark):
    """Thresholds so low that the skew of a test fixture shows."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_cart_rows_of_a_hot_pair_are_split(spark, interval, eager_splitting):
    """A third of all rows in one session and product, each with a product name of its own."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.expr("IF(id % 3 = 0, 'hot', concat('s', id))").alias("session_id"),
        F.expr("IF(id % 3 = 0, 'p', concat('p', id % 50))").alias("product_id"),
        F.concat(F.lit("name "), F.col("id")).alias("product_name"),
        F.lit("x").alias("category"),
        F.expr("DATE'2024-01-05'").alias("event_date"),
        F.lit(True).alias("added_to_cart"),
        (F.col("id") % 1000 == 0).alias("purchased"),
    )
    path = fresh_path(spark, "hot")
    rows.write.parquet(path)
    report = cart_abandonment(spark.read.parquet(path), interval(*WEEK))
    totals = report.groupBy().sum("cart_session_count", "purchased_cart_session_count")
    ((carts, bought),) = totals.collect()
    assert "skew=true" in totals._jdf.queryExecution().executedPlan().toString()
    # The hot pair's 20,000 carts meet its 20 purchases; 40 more pairs buy once.
    assert (carts, bought) == (20_000 * 20 + 40_000, 20_000 * 20 + 40)


def test_documents_are_parsed_once(events_of):
    text = plan(parse_and_validate_events(as_records(events_of(event()))))
    parsed = [line for line in text.splitlines() if "from_json" in line]
    assert sum(line.count("from_json(StructField") for line in parsed) == 1
    assert shuffles(text) == 0


@pytest.mark.parametrize("name", ["cart_abandonment", "cart_abandonment_sql"])
def test_the_abandonment_query_makes_session_products_once(spark, name):
    """The report reads what was written; the events and their shuffle are not in its plan."""
    text = plan(QUERIES[name](spark, SMALL_TABLES))
    assert "events.parquet" not in text and "session-products-" in text
    assert "first_purchase_time" not in text
    assert shuffles(text) <= 4


@pytest.mark.parametrize("name", ["cart_abandonment", "daily_traffic", "sessions", "json_decode"])
def test_queries_stay_on_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SMALL_TABLES))
    assert "Python" not in text and "Arrow" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text
