"""All-time measures of users from parts that add up, instead of a scan of every fact.

``mv_user_orders`` has a row for each user and load day.  Its sums are exact but for one
thing: an order id may be loaded again on another day and must count once.  Such ids are
few; ``recurring_orders`` keeps their fact rows, and the copies beyond the first are taken
off the sums, for whatever group of users is asked for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.store import TableStore

# Fixed value: the status of orders that count.
PAID = "paid"
PARTS, RECURRING, FACT = "warehouse.mv_user_orders", "warehouse.recurring_orders", "warehouse.fact_orders"


def month_of(day: Column) -> Column:
    """The first day of a day's month."""
    return F.trunc(day, "month")


def user_parts(fact_orders: DataFrame) -> DataFrame:
    """Paid orders by user and load day; an order id occurs once in a load day, so rows are orders there."""
    return fact_orders.filter(F.col("status") == PAID).groupBy("user_id", "load_date").agg(
        F.count(F.lit(1)).alias("order_rows"), F.sum("revenue").cast("decimal(22,2)").alias("revenue"),
        F.count("revenue").alias("revenue_rows"), F.min("order_ts").alias("first_order_ts"),
        F.max("order_ts").alias("last_order_ts")).withColumn("load_month", month_of(F.col("load_date")))


def recurring(fact_orders: DataFrame, keys: DataFrame | None = None, mine: Column | None = None) -> DataFrame:
    """The fact rows of order ids (those in ``keys``, or all) that were loaded on more than one day.

    First and last day of an id tell, which partial aggregation keeps small for a hot id.
    Rows for which ``mine`` holds are known to have their ids in ``keys``: only the others look for theirs.
    """
    ids = fact_orders.select("order_id", "load_date")
    if keys is not None:
        own = F.lit(False) if mine is None else F.coalesce(mine, F.lit(False))
        ids = ids.filter(own).unionByName(ids.filter(~own).join(keys, "order_id", "left_semi"))
    days = ids.groupBy("order_id").agg(F.min("load_date").alias("a"), F.max("load_date").alias("b")).filter("a < b")
    return fact_orders.join(days.select("order_id"), "order_id", "left_semi") \
        .select("order_id", "load_date", "user_id", "status")


def refresh(store: TableStore, days: list[dt.date]) -> None:
    """Bring both tables in line with the facts of some load days.

    The parts of other days in the same months are copied: half a month of small rows a day,
    for which an all-time measure opens few folders.  Finding recurring ids takes the
    order ids of these days to the order id column of the other facts, a scan of one column
    that Spark narrows with a Bloom filter of the smaller side.
    """
    facts, fresh = store.read(FACT), not store.exists(PARTS)
    if fresh:
        # A warehouse that was loaded before this table existed: all its days at once.
        store.reload_days(PARTS, user_parts(facts))
        store.write_snapshot(RECURRING, recurring(facts))
        return
    months = sorted({d.replace(day=1) for d in days})
    mine = F.col("load_date").isin(days)
    others = store.read(PARTS).filter(F.col("load_month").isin(months) & ~mine)
    store.replace_folders(PARTS, others.unionByName(user_parts(facts.filter(mine))), [(m,) for m in months])
    # Ids that these days hold now, or did when they were last looked at.
    held = store.read(RECURRING)
    keys = facts.filter(mine).select("order_id").unionByName(held.filter(mine).select("order_id")).distinct()
    found = recurring(facts, keys, mine)
    store.merge(RECURRING, keys, lambda current: current.join(keys, "order_id", "left_anti").unionByName(found))


def _copies(recurring_orders: DataFrame, group: str) -> DataFrame:
    """How many paid rows of a group repeat an order that the group already has: (group, copies)."""
    paid = recurring_orders.filter(F.col("status") == PAID).groupBy(group, "order_id").agg(F.count(F.lit(1)).alias("n"))
    return paid.groupBy(group).agg(F.sum(F.col("n") - 1).alias("copies"))


def _totals(parts: DataFrame, copies: DataFrame, group: str) -> DataFrame:
    """Parts summed by group, less the copies.  Stacked instead of joined, which keeps a NULL group whole."""
    stacked = parts.select(group, "order_rows", "revenue", "revenue_rows", "first_order_ts", "last_order_ts").unionByName(
        copies.select(group, (-F.col("copies")).alias("order_rows")), allowMissingColumns=True)
    return stacked.groupBy(group).agg(
        F.sum("order_rows").alias("order_count"), F.sum("revenue").alias("revenue"),
        F.sum("revenue_rows").alias("revenue_rows"), F.min("first_order_ts").alias("first_order_ts"),
        F.max("last_order_ts").alias("last_order_ts"))


def user_totals(parts: DataFrame, recurring_orders: DataFrame) -> DataFrame:
    """order_count, revenue, revenue_rows, first_order_ts, last_order_ts of each user's paid orders."""
    return _totals(parts, _copies(recurring_orders, "user_id"), "user_id")


def group_totals(parts: DataFrame, recurring_orders: DataFrame, users: DataFrame, group: str) -> DataFrame:
    """orders, revenue, rows of each group of users (one row a user in ``users``).

    A user's parts are added before they meet the groups.
    """
    empty = _copies(recurring_orders.limit(0), "user_id")
    sums = _totals(parts, empty, "user_id").withColumnRenamed("order_count", "order_rows").join(users, "user_id")
    copies = _copies(recurring_orders.join(users, "user_id"), group)
    return _totals(sums, copies, group).select(
        group, F.col("order_count").alias("orders"), "revenue", F.col("revenue_rows").alias("rows"))
