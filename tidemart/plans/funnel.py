"""Event funnels and conversion.

Distinct users per stage are counted in two levels: first one row per (group, user) with
a bit per stage reached, then plain sums.  A list of distinct aggregates would instead
copy every event once per stage.  Bits merge in the map tasks, so neither a user nor a
day that holds most of the events makes a large task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import percent
from tidemart.functions.exprs import DateLike
from tidemart.plans.warehouse import Warehouse, recent, with_dates, with_products
from tidemart.schemas import EVENT_TYPES


def _stage_bit(stages: tuple[str, ...]) -> Column:
    bit = F.lit(0)
    for i, stage in enumerate(stages):
        bit = F.when(F.col("event_type") == stage, F.lit(1 << i)).otherwise(bit)
    return bit


def users_per_stage(events: DataFrame, group: str, stages: tuple[str, ...], names: tuple[str, ...]) -> DataFrame:
    """Distinct users of each stage per ``group``."""
    reached = events.select(group, "user_id", _stage_bit(stages).alias("bit")) \
        .groupBy(group, "user_id").agg(F.bit_or("bit").alias("mask"))
    return reached.groupBy(group).agg(*[
        F.count_if(F.col("mask").bitwiseAND(1 << i) != 0).alias(name) for i, name in enumerate(names)
    ])


def event_funnel(wh: Warehouse, as_of: DateLike = None, days: int = 30) -> DataFrame:
    """Daily users of the five funnel stages with the rates between them."""
    names = ("page_viewers", "product_viewers", "cart_adds", "checkouts", "purchases")
    daily = users_per_stage(recent(wh.fact_events, as_of, days), "date_id", EVENT_TYPES, names)
    c = {n: F.col(n) for n in names}
    return with_dates(daily, wh.dim_date, "date").select(
        F.col("date").alias("event_date"), *names,
        percent(c["product_viewers"], c["page_viewers"]).alias("view_to_product_rate"),
        percent(c["cart_adds"], c["product_viewers"]).alias("product_to_cart_rate"),
        percent(c["checkouts"], c["cart_adds"]).alias("cart_to_checkout_rate"),
        percent(c["purchases"], c["checkouts"]).alias("checkout_to_purchase_rate"),
        percent(c["purchases"], c["page_viewers"]).alias("overall_conversion_rate"),
    ).orderBy(F.desc("event_date"))


def event_funnel_3stage(wh: Warehouse, as_of: DateLike = None, days: int = 30) -> DataFrame:
    """Daily viewers, cart adders and purchasers, oldest day first."""
    names = ("viewers", "cart_adds", "purchasers")
    stages = ("page_view", "add_to_cart", "purchase")
    daily = users_per_stage(recent(wh.fact_events, as_of, days), "date_id", stages, names)
    return with_dates(daily, wh.dim_date, "date").select(
        F.col("date").alias("event_date"), *names,
        percent(F.col("cart_adds"), F.col("viewers")).alias("cart_rate"),
        percent(F.col("purchasers"), F.col("cart_adds")).alias("purchase_rate"),
    ).orderBy("event_date")


def product_conversion(wh: Warehouse, as_of: DateLike = None, days: int = 30) -> DataFrame:
    """Viewers, cart adders and buyers per product, best converting first."""
    names = ("product_views", "add_to_carts", "purchases")
    stages = ("view_product", "add_to_cart", "purchase")
    events = recent(wh.fact_events, as_of, days).filter(F.col("product_id").isNotNull())
    per_product = users_per_stage(events, "product_id", stages, names)
    return with_products(per_product, wh.dim_product, "category", "product_name").select(
        "category", "product_id", "product_name", *names,
        percent(F.col("add_to_carts"), F.col("product_views")).alias("atc_rate"),
        percent(F.col("purchases"), F.col("add_to_carts")).alias("purchase_rate"),
    ).orderBy(F.desc_nulls_last("purchase_rate"), "product_id")


def event_counts(wh: Warehouse) -> DataFrame:
    """Events and distinct users per event type, most frequent first.

    Counted per (type, user) first: the same result as a distinct count, with one
    narrow row per pair in the shuffle.
    """
    per_user = wh.fact_events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy("event_type").agg(
        F.count("user_id").alias("unique_users"), F.sum("n").alias("total_events")
    ).orderBy(F.desc("total_events"), "event_type")


def late_events_by_lag(fact_events: DataFrame) -> DataFrame:
    """Events by how many days after their own day they were loaded."""
    event_day = F.to_date(F.col("event_ts"))
    lag = F.date_diff(F.col("load_date"), event_day)
    return fact_events.groupBy(lag.alias("lag_days")).agg(
        F.count("*").alias("events"), F.min(event_day).alias("first_event_day"),
        F.max(event_day).alias("last_event_day"),
    ).orderBy("lag_days")
