"""Customer value, loyalty, tenure and acquisition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_column, mean2, percent, ratio
from tidemart.functions.exprs import DateLike
from tidemart.plans.warehouse import Warehouse

# Tenure buckets in days since signup (upper bounds not included).  The
# last label also takes users without a signup date.
TENURE_BUCKETS = ((30, "0-30 days"), (60, "31-60 days"), (90, "61-90 days"), (180, "91-180 days"),
                  (365, "181-365 days"))
TENURE_REST = "1+ years"
TENURE_GROUPS = ((30, "New"), (90, "Growing"))
TENURE_GROUPS_REST = "Established"


def top_customers(wh: Warehouse, limit: int = 50, min_orders: int = 1) -> DataFrame:
    """The biggest spenders with their order history in numbers."""
    span = F.date_diff(F.col("last_order_ts").cast("date"), F.col("first_order_ts").cast("date"))
    per_user = wh.user_orders().select(
        "user_id",
        "order_count",
        F.col("revenue").alias("total_spent"),
        ratio(F.col("revenue"), F.col("revenue_rows")).alias("avg_order_value"),
        F.col("first_order_ts").alias("first_order_date"),
        F.col("last_order_ts").alias("last_order_date"),
        span.alias("customer_lifespan_days"),
        ratio(F.col("revenue"), span).alias("revenue_per_day"),
    )
    return per_user.filter(F.col("order_count") >= min_orders) \
        .orderBy(F.desc("total_spent"), "user_id").limit(limit)


def repeat_customers(wh: Warehouse, min_orders: int = 2) -> DataFrame:
    """How many customers came back, and what they are worth."""
    per_user = wh.user_orders().select("order_count", F.col("revenue").alias("total_spent")) \
        .filter(F.col("order_count") >= min_orders)
    return per_user.agg(
        F.count("*").alias("repeat_customers"),
        F.sum("total_spent").alias("repeat_customer_revenue"),
        mean2(F.col("order_count")).alias("avg_orders_per_customer"),
        mean2(F.col("total_spent")).alias("avg_lifetime_value"),
    )


def _bucket(tenure: Column, buckets: tuple, rest: str) -> Column:
    label = None
    for bound, name in buckets:
        test = tenure < bound
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return label.otherwise(F.lit(rest))


def _position(label: Column, buckets: tuple) -> Column:
    names = [name for _, name in buckets]
    position = F.array_position(F.array(*map(F.lit, names)), label)
    return F.when(position > 0, position).otherwise(len(names) + 1)


def _by_user_group(wh: Warehouse, group: Column, name: str) -> DataFrame:
    """Users, orders and revenue per user group; groups without orders are kept.

    A left join of users to orders, by parts: the users are counted on their own, the
    paid orders meet the users in an inner join (AQE may split a heavy buyer's partition,
    which it cannot do on the inner side of a left join), and the two small results are
    stacked and summed, which also keeps a NULL group in one piece.
    """
    users = wh.dim_user.select("user_id", group.alias(name))
    # user_id is the key of the dimension, so rows are users.
    counted = users.groupBy(name).agg(F.count("user_id").alias("users"))
    sold = wh.grouped_orders(users, name)
    return counted.unionByName(sold, allowMissingColumns=True).groupBy(name).agg(
        F.sum("users").alias("users"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("rows").alias("rows"),
    )


def tenure_segments(wh: Warehouse, as_of: DateLike = None) -> DataFrame:
    """Users, orders and revenue per tenure bucket, newest customers first."""
    tenure = F.date_diff(day_column(as_of), F.col("signup_date"))
    groups = _by_user_group(wh, _bucket(tenure, TENURE_BUCKETS, TENURE_REST), "tenure_bucket")
    # Buckets are disjoint ranges, so their order is that of their average tenure.
    return groups.orderBy(_position(F.col("tenure_bucket"), TENURE_BUCKETS)).select(
        "tenure_bucket",
        F.col("users").alias("user_count"),
        F.col("orders").alias("total_orders"),
        ratio(F.col("revenue"), F.col("rows")).alias("avg_order_value"),
        F.col("revenue").alias("segment_revenue"),
    )


def tenure_segments_simple(wh: Warehouse, as_of: DateLike = None) -> DataFrame:
    """Users per coarse tenure group."""
    tenure = F.date_diff(day_column(as_of), F.col("signup_date"))
    groups = wh.dim_user.groupBy(_bucket(tenure, TENURE_GROUPS, TENURE_GROUPS_REST).alias("tenure_group"))
    return groups.agg(F.count("user_id").alias("user_count")) \
        .orderBy(_position(F.col("tenure_group"), TENURE_GROUPS))


def marketing_source_performance(wh: Warehouse) -> DataFrame:
    """Users, orders and revenue per acquisition source."""
    groups = _by_user_group(wh, F.col("marketing_source"), "marketing_source")
    return groups.select(
        "marketing_source",
        F.col("users").alias("users_acquired"),
        F.col("orders").alias("orders_from_source"),
        F.col("revenue").alias("revenue_from_source"),
        percent(F.col("orders"), F.col("users")).alias("conversion_rate"),
        ratio(F.col("revenue"), F.col("users")).alias("revenue_per_user"),
    ).orderBy(F.desc_nulls_first("revenue_from_source"), "marketing_source")


def users_by_marketing_source(wh: Warehouse) -> DataFrame:
    """Users per source, and how many different order counts they have.

    ``users_with_orders`` counts distinct *order counts*, which is what the query has
    always returned under that name.  Orders shrink to one row per user before the join.
    """
    per_user = wh.fact_orders.groupBy("user_id").agg(F.count("*").alias("n_orders"))
    joined = wh.dim_user.select("user_id", "marketing_source").join(per_user, "user_id", "left")
    return joined.groupBy("marketing_source").agg(
        F.count("*").alias("user_count"), F.count_distinct("n_orders").alias("users_with_orders")
    )
