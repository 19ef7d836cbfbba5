"""Revenue by date, category, brand, weekday and time grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions import day_column, mean2, percent
from tidemart.functions.exprs import DateLike
from tidemart.plans.warehouse import Warehouse, order_count, recent, with_dates, with_products

GRAINS = {"day": ["date"], "week": ["year", "week"], "month": ["year", "month"]}


def revenue_by_date(wh: Warehouse, as_of: DateLike = None, days: int = 90) -> DataFrame:
    """Paid orders, revenue and order values per day.

    Aggregated by the integer key first; the calendar joins one row per day.
    """
    daily = recent(wh.paid_orders(), as_of, days).groupBy("date_id").agg(
        order_count(),
        F.sum("revenue").alias("daily_revenue"),
        mean2(F.col("revenue")).alias("avg_order_value"),
        F.max("revenue").alias("max_order_value"),
        F.min("revenue").alias("min_order_value"),
    )
    return with_dates(daily, wh.dim_date, "date").select(
        F.col("date").alias("order_date"), "order_count", "daily_revenue", "avg_order_value",
        "max_order_value", "min_order_value",
    ).orderBy(F.desc("order_date"))


def revenue_by_category(wh: Warehouse, as_of: DateLike = None) -> DataFrame:
    """Paid revenue per category and month of the running year, with its share of the month."""
    year = F.year(day_column(as_of))
    in_year = wh.paid_orders().filter(F.col("date_id").between(year * 10000 + 101, year * 10000 + 1231))
    rows = with_products(with_dates(in_year, wh.dim_date, "year", "month"), wh.dim_product, "category")
    by_category = rows.filter(F.col("year") == year).groupBy("category", "year", "month").agg(
        order_count(),
        F.sum("revenue").alias("category_revenue"),
        mean2(F.col("revenue")).alias("avg_order_value"),
    )
    # The window runs over finished sums: one row per category in each month.
    month_total = F.sum("category_revenue").over(W.partitionBy("year", "month"))
    return by_category.withColumn("revenue_pct", percent(F.col("category_revenue"), month_total)) \
        .orderBy(F.desc("month"), F.desc("category_revenue"), "category")


def revenue_by_brand(wh: Warehouse, as_of: DateLike = None, days: int = 30) -> DataFrame:
    """Paid orders, units and revenue per brand."""
    rows = with_products(recent(wh.paid_orders(), as_of, days), wh.dim_product, "brand")
    return rows.groupBy("brand").agg(
        order_count(),
        F.sum("quantity").alias("units_sold"),
        F.sum("revenue").alias("total_revenue"),
        mean2(F.col("revenue")).alias("avg_order_value"),
        mean2(F.col("quantity")).alias("avg_units_per_order"),
    ).orderBy(F.desc("total_revenue"), "brand")


def category_revenue_simple(wh: Warehouse, as_of: DateLike = None, days: int | None = None) -> DataFrame:
    """Orders and revenue per category over all statuses, all time or the last ``days``.

    Plain sums add up, so the facts shrink to one row per product before the join.
    """
    facts = wh.fact_orders if days is None else recent(wh.fact_orders, as_of, days)
    per_product = facts.groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("revenue").alias("r"), F.count("revenue").alias("k"))
    return with_products(per_product, wh.dim_product, "category").groupBy("category").agg(
        F.sum("n").alias("orders"),
        F.sum("r").alias("total_revenue"),
        F.round(F.sum("r").cast("decimal(22,2)") / F.sum("k").cast("decimal(20,0)"), 2).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"), "category")


def daily_sales_summary(wh: Warehouse, latest: int = 30) -> DataFrame:
    """Orders, revenue and average value of the ``latest`` days that have orders."""
    daily = wh.fact_orders.groupBy("date_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("revenue").alias("daily_revenue"),
        mean2(F.col("revenue"), 6).alias("avg_order_value"),
    )
    return with_dates(daily, wh.dim_date, "date") \
        .select("date", "orders", "daily_revenue", "avg_order_value") \
        .orderBy(F.desc("date")).limit(latest)


def daily_revenue_trend(wh: Warehouse, as_of: DateLike = None, days: int = 90) -> DataFrame:
    """Orders and revenue per day over all statuses, oldest first."""
    daily = recent(wh.fact_orders, as_of, days).groupBy("date_id").agg(
        F.count("*").alias("order_count"),
        F.sum("revenue").alias("daily_revenue"),
        mean2(F.col("revenue"), 6).alias("avg_order_value"),
        F.max("revenue").alias("max_order_value"),
    )
    return with_dates(daily, wh.dim_date, "date").select(
        F.col("date").alias("order_date"), "order_count", "daily_revenue", "avg_order_value",
        "max_order_value",
    ).orderBy("order_date")


def orders_by_weekday(wh: Warehouse) -> DataFrame:
    """Orders and revenue per weekday, Sunday first."""
    daily = wh.fact_orders.groupBy("date_id").agg(F.count("*").alias("n"), F.sum("revenue").alias("r"))
    return with_dates(daily, wh.dim_date, "day_name", "day_of_week").groupBy("day_name", "day_of_week").agg(
        F.sum("n").alias("order_count"), F.sum("r").alias("revenue")
    ).orderBy("day_of_week")


def revenue_by_grain(wh: Warehouse, grain: str) -> DataFrame:
    """Paid orders and revenue per day, week or month."""
    keys = GRAINS[grain]
    rows = with_dates(wh.paid_orders(), wh.dim_date, *keys)
    return rows.groupBy(*keys).agg(order_count(), F.sum("revenue").alias("revenue")).orderBy(*keys)


def orders_between_date_ids(wh: Warehouse, first: int, last: int) -> DataFrame:
    """Fact orders in a range of date keys, both included."""
    return wh.fact_orders.filter(F.col("date_id").between(first, last))


def week_over_week(wh: Warehouse, as_of: DateLike = None, iso_year: bool = False) -> DataFrame:
    """Weekly revenue and orders of the running year with growth over the week before.

    By default ISO weeks are paired with the calendar year, so the first days of January
    can fall into the year's last week; ``iso_year`` pairs them with the ISO year.  The
    year's first week has no predecessor.  Only one year's weeks reach the window.
    """
    day = day_column(as_of)
    paid = wh.paid_orders()
    if iso_year:
        # The ISO year is the calendar year of the week's Thursday.
        thursday = F.date_add(F.date_trunc("week", F.col("date")).cast("date"), 3)
        dates = wh.dim_date.withColumn("year", F.year(thursday))
        year = F.year(F.date_add(F.date_trunc("week", day).cast("date"), 3))
        in_year = paid.filter(F.col("date_id").between((year - 1) * 10000 + 1229, (year + 1) * 10000 + 103))
    else:
        dates = wh.dim_date
        year = F.year(day)
        in_year = paid.filter(F.col("date_id").between(year * 10000 + 101, year * 10000 + 1231))
    weekly = with_dates(in_year, dates, "year", "week").filter(F.col("year") == year) \
        .groupBy("year", "week").agg(
            F.sum("revenue").alias("weekly_revenue"), F.count_distinct("order_id").alias("weekly_orders"))
    before = W.partitionBy("year").orderBy("week")
    out = weekly.withColumn("prev_week_revenue", F.lag("weekly_revenue").over(before)) \
        .withColumn("prev_week_orders", F.lag("weekly_orders").over(before))
    return out.select(
        "week", "weekly_revenue", "weekly_orders", "prev_week_revenue",
        percent(F.col("weekly_revenue") - F.col("prev_week_revenue"), F.col("prev_week_revenue"))
        .alias("revenue_growth_pct"),
        "prev_week_orders",
        percent(F.col("weekly_orders") - F.col("prev_week_orders"), F.col("prev_week_orders"))
        .alias("orders_growth_pct"),
    ).orderBy(F.desc("week"))


def day_of_week_seasonality(wh: Warehouse, as_of: DateLike = None, days: int = 90) -> DataFrame:
    """Average daily revenue and orders per weekday over days that had paid orders."""
    daily = recent(wh.paid_orders(), as_of, days).groupBy("date_id").agg(
        F.count("*").alias("daily_orders"), F.sum("revenue").alias("daily_revenue"))
    return with_dates(daily, wh.dim_date, "day_name", "day_of_week", "date") \
        .groupBy("day_name", "day_of_week").agg(
            F.count_distinct("date").alias("num_days"),
            mean2(F.col("daily_revenue")).alias("avg_daily_revenue"),
            mean2(F.col("daily_orders")).alias("avg_daily_orders"),
        ).orderBy("day_of_week")
