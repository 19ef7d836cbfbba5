"""Product performance, price history and stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions import mean2, ratio
from tidemart.functions.exprs import DateLike
from tidemart.operators.merge import as_of_version
from tidemart.plans.warehouse import Warehouse, order_count, recent, with_products

LOW_STOCK = 20


def product_performance(wh: Warehouse, as_of: DateLike = None, days: int = 30, limit: int = 50) -> DataFrame:
    """The best-selling products with volumes and prices.

    Aggregated by product before the catalogue is joined, so the join sees each product
    once and cannot be skewed.
    """
    per_product = recent(wh.paid_orders(), as_of, days).groupBy("product_id").agg(
        order_count(),
        F.sum("quantity").alias("units_sold"),
        F.sum("revenue").alias("total_revenue"),
        mean2(F.col("revenue")).alias("avg_order_value"),
        mean2(F.col("quantity")).alias("avg_units_per_order"),
        ratio(F.sum("revenue"), F.sum("quantity")).alias("actual_avg_price"),
    )
    return with_products(per_product, wh.dim_product, "product_name", "category", "brand", "current_price") \
        .select("product_id", "product_name", "category", "brand", "order_count", "units_sold",
                "total_revenue", "avg_order_value", "avg_units_per_order", "current_price",
                "actual_avg_price") \
        .orderBy(F.desc("total_revenue"), "product_id").limit(limit)


def top_products_by_category(wh: Warehouse, as_of: DateLike = None, days: int = 30, top: int = 5) -> DataFrame:
    """The leading products of every category.

    The rank filter becomes a per-task group limit ahead of the shuffle, so a category
    that holds most of the catalogue still sends ``top`` rows per task.
    """
    per_product = recent(wh.paid_orders(), as_of, days).groupBy("product_id").agg(
        F.sum("revenue").alias("product_revenue"), order_count())
    rows = with_products(per_product, wh.dim_product, "category", "product_name")
    rank = F.row_number().over(
        W.partitionBy("category").orderBy(F.desc("product_revenue"), "product_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "category", "product_id", "product_name", "product_revenue", "order_count", "rank"
    ).orderBy("category", "rank")


def top_products_by_revenue(wh: Warehouse, limit: int = 10) -> DataFrame:
    """The best sellers of all time, over all statuses."""
    per_product = wh.fact_orders.groupBy("product_id").agg(
        F.count("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
    return with_products(per_product, wh.dim_product, "product_name") \
        .orderBy(F.desc("revenue"), "product_id").limit(limit) \
        .select("product_id", "product_name", "orders", "revenue")


def top_products_recent(wh: Warehouse, as_of: DateLike = None, days: int = 30, limit: int = 20) -> DataFrame:
    """The best sellers of the last days with category, brand and units, over all statuses."""
    per_product = recent(wh.fact_orders, as_of, days).groupBy("product_id").agg(
        order_count(), F.sum("revenue").alias("total_revenue"), F.sum("quantity").alias("units_sold"))
    return with_products(per_product, wh.dim_product, "product_name", "category", "brand") \
        .select("product_id", "product_name", "category", "brand", "order_count", "total_revenue",
                "units_sold") \
        .orderBy(F.desc("total_revenue"), "product_id").limit(limit)


def price_at_order(wh: Warehouse, history: DataFrame) -> DataFrame:
    """Each order with the catalogue price that was valid when it was placed."""
    versions = history.select("product_id", "current_price", "effective_from", "effective_to")
    return as_of_version(wh.fact_orders, versions, "product_id", "order_ts").select(
        "order_id", "product_id", "order_ts", "quantity", "revenue",
        F.col("current_price").alias("price_at_order"), "effective_from", "effective_to",
    )


def low_stock(products: DataFrame, threshold: int = LOW_STOCK) -> DataFrame:
    """Products below a stock threshold, emptiest first."""
    return products.filter(F.col("stock") < threshold) \
        .select("product_name", "stock", F.col("current_price").alias("price")).orderBy("stock")


def avg_discount_by_category(products: DataFrame) -> DataFrame:
    """Average discount and number of discounted products per category."""
    discounted = products.filter(F.col("discount_percentage") > 0)
    return discounted.groupBy("category").agg(
        mean2(F.col("discount_percentage"), 6).alias("avg_discount"),
        F.count("*").alias("products_on_sale"),
    ).orderBy(F.desc("avg_discount"), "category")


def discount_revenue_loss(products: DataFrame) -> DataFrame:
    """What the discounts would cost if every product sold once."""
    loss = F.col("current_price").cast("decimal(12,2)") * F.col("discount_percentage").cast("decimal(12,2)") / 100
    return products.agg(F.sum(loss.cast("decimal(24,6)")).alias("potential_revenue_loss"))
