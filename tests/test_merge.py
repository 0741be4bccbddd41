import pytest

from tests.conftest import event
from trailmart.operators.merge import REPEAT_CHUNK, merged_rows
from trailmart.plans import dataframe_jobs
from trailmart.plans.merge_window import merge_window
from trailmart.schema import (
    ABANDONMENT_MEASURES,
    CART_ABANDONMENT,
    EVENTS,
    PRODUCT_DAY_KEYS,
)
from trailmart.session import shared_folder
from trailmart.sources.tables import append_by_name, partitions, read_table, store_events, table_name

from pyspark.sql import functions as F

WEEK = ("2024-01-05", "2024-01-12")


@pytest.fixture
def result(spark):
    """Abandonment rows from (day of January, product, category, carts)."""

    def build(*rows):
        values = [
            f"(DATE'2024-01-{d:02}', '{p}', 'ring', {'NULL' if c is None else repr(c)}, {n}L, 0L, {n}L, 1.0BD)"
            for d, p, c, n in rows
        ]
        ddl = "DATE'2024-01-01', '', '', '', 0L, 0L, 0L, 1.0BD"
        text = f"SELECT * FROM VALUES {', '.join(values or [f'({ddl})'])}"
        df = spark.sql(text).toDF(*CART_ABANDONMENT.columns)
        df = df.select("*").withColumn("category", F.col("category").cast("string"))
        return df if values else df.limit(0)

    return build


@pytest.fixture
def merge(spark, schema, interval):
    name = table_name(CART_ABANDONMENT, schema)

    def run(source, window=WEEK):
        merge_window(
            source, name, CART_ABANDONMENT, PRODUCT_DAY_KEYS, ABANDONMENT_MEASURES, interval(*window)
        )
        stored = read_table(spark, name, CART_ABANDONMENT).collect()
        return sorted(
            ((r.event_date.day, r.product_id, r.category, r.cart_session_count) for r in stored),
            key=repr,
        )

    run.name = name
    return run


def test_three_clauses(spark, merge, result):
    append_by_name(
        result(
            (4, "p1", "x", 1),  # outside the window
            (5, "p1", "x", 1),  # matched
            (5, "p2", "x", 1),  # vanished
            (6, "p1", "x", 1),  # whole day vanished
            (7, "p1", None, 1),  # null key: replaced
            (12, "p1", "x", 1),  # outside the window
        ),
        merge.name,
        CART_ABANDONMENT,
    )
    source = result((5, "p1", "x", 7), (5, "p3", "x", 7), (7, "p1", None, 7), (11, "p1", "x", 7))
    expected = [
        (11, "p1", "x", 7),
        (12, "p1", "x", 1),
        (4, "p1", "x", 1),
        (5, "p1", "x", 7),
        (5, "p3", "x", 7),
        (7, "p1", None, 7),
    ]
    assert merge(source) == expected
    assert merge(source) == expected
    days = partitions(spark, merge.name, CART_ABANDONMENT).collect()
    assert "2024-01-06" not in {row.event_date for row in days}


def test_duplicates_of_a_key_stay_and_of_a_null_key_go(merge, result):
    for _ in range(3):
        append_by_name(result((5, "p1", "x", 1), (5, "p1", None, 1)), merge.name, CART_ABANDONMENT)
    assert merge(result((5, "p1", "x", 2), (5, "p1", None, 2))) == [
        (5, "p1", "x", 2),
        (5, "p1", "x", 2),
        (5, "p1", "x", 2),
        (5, "p1", None, 2),
    ]


def test_an_empty_source_empties_the_window(merge, result):
    append_by_name(result((4, "p1", "x", 1), (5, "p1", "x", 1)), merge.name, CART_ABANDONMENT)
    assert merge(result()) == [(4, "p1", "x", 1)]
    assert merge(result()) == [(4, "p1", "x", 1)]


def test_an_empty_window_changes_nothing(merge, result):
    append_by_name(result((5, "p1", "x", 1)), merge.name, CART_ABANDONMENT)
    noon = ("2024-01-05 06:00:00", "2024-01-05 18:00:00")
    assert merge(result(), noon) == [(5, "p1", "x", 1)]


def test_source_rows_outside_the_window_are_refused(merge, result):
    with pytest.raises(ValueError, match="outside"):
        merge(result((4, "p1", "x", 1)))


def test_two_source_rows_for_one_stored_row_are_refused(merge, result):
    twice = result((5, "p1", "x", 1), (5, "p1", "x", 2))
    assert len(merge(twice)) == 2  # nothing stored yet: both are inserted
    with pytest.raises(ValueError, match="Several source rows"):
        merge(twice)


def test_many_copies_of_one_key(spark, result):
    copies = 2 * REPEAT_CHUNK + 3
    target = result((5, "p1", "x", 1)).crossJoin(spark.range(copies)).drop("id")
    merged = merged_rows(
        target, result((5, "p1", "x", 4), (5, "p2", "x", 4)), PRODUCT_DAY_KEYS, ABANDONMENT_MEASURES
    )
    counts = merged.groupBy("product_id", "cart_session_count").count().collect()
    assert {tuple(row) for row in counts} == {("p1", 4, copies), ("p2", 4, 1)}


def test_late_events_end_as_if_loaded_at_once(spark, schema, events_of):
    def load(batch, *rows):
        stamped = events_of(*rows).withColumn("ingestion_time", F.current_timestamp())
        store_events(stamped, table_name(EVENTS, schema), batch)

    def stored():
        name = table_name(CART_ABANDONMENT, schema, "_df")
        rows = read_table(spark, name, CART_ABANDONMENT).collect()
        return sorted((r.event_date.day, r.product_id, *r[4:7]) for r in rows)

    load("load-1", event("add_to_cart"), event("add_to_cart", session_id="s2", product_id="p2"))
    dataframe_jobs.build_session_products(spark, "2024-01-05", "2024-01-06", schema)
    dataframe_jobs.merge_daily_product_cart_abandonment(spark, *WEEK, schema)
    assert stored() == [(5, "p1", 1, 0, 1), (5, "p2", 1, 0, 1)]
    load("load-2", event("purchase", event_time="2024-01-06 10:00:00"))
    dataframe_jobs.build_session_products(spark, "2024-01-06", "2024-01-07", schema)
    dataframe_jobs.merge_daily_product_cart_abandonment(spark, *WEEK, schema)
    assert stored() == [(5, "p1", 1, 1, 0), (5, "p2", 1, 0, 1)]


def test_a_merge_leaves_no_copy_of_its_source(spark, merge, result):
    merge(result((5, "p1", "x", 7)))
    with pytest.raises(ValueError, match="outside"):
        merge(result((20, "p1", "x", 7)))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not [f for f in files.listStatus(path) if "merge-source-" in f.getPath().getName()]


def written(spark, name, source, interval, window=WEEK):
    return merge_window(
        source, name, CART_ABANDONMENT, PRODUCT_DAY_KEYS, ABANDONMENT_MEASURES, interval(*window)
    )


def test_only_days_that_change_are_written(spark, merge, result, interval):
    rows = [(5, "p1", "x", 1), (6, "p1", "x", 2), (6, "p2", None, 3), (7, "p1", None, 4)]
    days = ["2024-01-05", "2024-01-06", "2024-01-07"]
    assert written(spark, merge.name, result(*rows), interval) == days
    assert written(spark, merge.name, result(*reversed(rows)), interval) == []
    files = {r[0] for r in spark.table(merge.name).select("_metadata.file_path").collect()}
    changed = [*rows[:2], (6, "p2", None, 9), rows[3]]
    assert written(spark, merge.name, result(*changed), interval) == days[1:2]
    now = {r[0] for r in spark.table(merge.name).select("_metadata.file_path").collect()}
    assert len(files & now) >= 2 and all("01-06" in path for path in files ^ now)
    assert written(spark, merge.name, result(*rows[:3], (8, "p1", "x", 1)), interval) == [
        "2024-01-06", "2024-01-07", "2024-01-08"
    ]


def test_a_null_that_moves_to_another_column_is_a_change(spark, merge, result, interval):
    moved = result((5, "p1", "ring", 1)).withColumn("product_name", F.lit(None).cast("string"))
    written(spark, merge.name, result((5, "p1", None, 1)), interval)
    assert written(spark, merge.name, moved, interval) == ["2024-01-05"]
    assert written(spark, merge.name, moved, interval) == []


def test_copies_that_stay_are_no_change_and_lost_copies_are_one(spark, merge, result, interval):
    for _ in range(3):
        append_by_name(result((5, "p1", "x", 1)), merge.name, CART_ABANDONMENT)
        append_by_name(result((6, "p1", None, 1)), merge.name, CART_ABANDONMENT)
    source = result((5, "p1", "x", 1), (6, "p1", None, 1))
    assert written(spark, merge.name, source, interval) == ["2024-01-06"]
    assert written(spark, merge.name, source, interval) == []


def test_equal_values_of_another_type_are_no_change(spark, merge, result, interval):
    source = result((5, "p1", "x", 1))
    written(spark, merge.name, source, interval)
    wider = source.withColumn("cart_session_count", F.col("cart_session_count").cast("int"))
    assert written(spark, merge.name, wider, interval) == []


def test_the_day_has_to_be_a_key(spark, merge, result, interval):
    with pytest.raises(ValueError, match="event_date has to be a key"):
        merge_window(
            result(), merge.name, CART_ABANDONMENT, PRODUCT_DAY_KEYS[1:], ABANDONMENT_MEASURES,
            interval(*WEEK),
        )
