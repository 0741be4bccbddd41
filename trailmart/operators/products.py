"""Daily product reports over session-product summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.functions.intervals import Interval
from trailmart.functions.metrics import count_where, rate
from trailmart.schema import PRODUCT_DAY_KEYS

# Funnel stage -> the session flag that marks it.
STAGES = {
    "product_view": "viewed_product",
    "add_to_cart": "added_to_cart",
    "checkout_start": "started_checkout",
    "purchase": "purchased",
}


def product_funnel(session_products: DataFrame, interval: Interval) -> DataFrame:
    """Sessions and events per funnel stage, revenue and conversion rates.

    Stages are counted independently, so a rate can exceed 1.
    """
    sessions_at = {stage: f"{stage}_session_count" for stage in STAGES}
    summary = (
        session_products.filter(interval.has_date("event_date"))
        .groupBy(*PRODUCT_DAY_KEYS)
        .agg(
            *[count_where(flag).alias(sessions_at[stage]) for stage, flag in STAGES.items()],
            *[F.sum(f"{stage}_count").alias(f"{stage}_event_count") for stage in STAGES],
            F.sum("revenue").cast("decimal(18,2)").alias("revenue"),
        )
    )
    view, cart, checkout, purchase = sessions_at.values()
    return summary.select(
        "*",
        rate(cart, view).alias("view_to_cart_rate"),
        rate(checkout, cart).alias("cart_to_checkout_rate"),
        rate(purchase, checkout).alias("checkout_to_purchase_rate"),
        rate(purchase, view).alias("view_to_purchase_rate"),
    )


def cart_abandonment(session_products: DataFrame, interval: Interval) -> DataFrame:
    """Carts, bought carts and abandoned carts per day and product.

    A cart row meets every purchase row of its session and product, whatever their
    dates, so a pair stored by several runs counts once per meeting. Purchases are
    counted per pair first: a cart row then stands for that many meetings, and no
    pair's rows are ever multiplied out.
    """
    in_window = session_products.filter(interval.has_date("event_date"))
    carts = in_window.filter("added_to_cart").select("session_id", *PRODUCT_DAY_KEYS)
    purchases = (
        in_window.filter("purchased")
        .groupBy("session_id", "product_id")
        .agg(F.count(F.lit(1)).alias("purchases"))
    )
    # Joining on the pair's hash as well makes Spark shuffle the counted purchases
    # again, which is small, and in return lets it split the cart rows of a hot pair.
    outcomes = _with_pair_hash(carts).join(
        _with_pair_hash(purchases), ["session_id", "product_id", "pair_hash"], "left"
    )
    summary = outcomes.groupBy(*PRODUCT_DAY_KEYS).agg(
        F.sum(F.coalesce("purchases", F.lit(1))).alias("cart_session_count"),
        F.sum(F.coalesce("purchases", F.lit(0))).alias("purchased_cart_session_count"),
        F.count_if(F.col("purchases").isNull()).alias("abandoned_cart_session_count"),
    )
    abandoned = rate("abandoned_cart_session_count", "cart_session_count")
    return summary.select("*", abandoned.alias("cart_abandonment_rate"))


def _with_pair_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("pair_hash", F.xxhash64("session_id", "product_id"))
