"""The star schema as a bundle of DataFrames: the input of every analytic query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.exprs import DateLike, date_key_ago
from tidemart.operators import lifetime
from tidemart.operators.facts import calendar
from tidemart.operators.store import TableStore

PAID = lifetime.PAID


class Warehouse:
    """Facts and dimensions; where they come from (tables, views) does not matter here.

    Sources are opened on first use, so a query touches only the tables it reads.
    """

    fact_orders: DataFrame
    fact_events: DataFrame
    dim_date: DataFrame
    dim_user: DataFrame
    dim_product: DataFrame

    def paid_orders(self) -> DataFrame:
        return self.fact_orders.filter(F.col("status") == PAID)

    def user_orders(self) -> DataFrame:
        """Paid orders of each user: order_count, revenue, revenue_rows, first_order_ts, last_order_ts."""
        return self.paid_orders().groupBy("user_id").agg(
            order_count(), F.sum("revenue").alias("revenue"), F.count("revenue").alias("revenue_rows"),
            F.min("order_ts").alias("first_order_ts"), F.max("order_ts").alias("last_order_ts"))

    def grouped_orders(self, users: DataFrame, group: str) -> DataFrame:
        """Paid orders of each group of users: ``group``, orders, revenue, rows.  ``users`` has one row a user."""
        sold = self.paid_orders().select("user_id", "order_id", "revenue").join(users, "user_id")
        return sold.groupBy(group).agg(
            F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"), F.count("revenue").alias("rows"))


class StoredWarehouse(Warehouse):
    """The star schema as stored: fact scans prune by their ``date_id`` partitions and push filters down.

    All-time measures of users come from their parts by load day, where these are kept.
    """

    def __init__(self, store: TableStore):
        self.store = store

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Warehouse.__annotations__:
            raise AttributeError(name)
        frame = self.store.read(f"warehouse.{name}")
        setattr(self, name, frame)
        return frame


    def user_orders(self) -> DataFrame:
        if not self.store.exists(lifetime.PARTS):
            return super().user_orders()
        return lifetime.user_totals(self.store.read(lifetime.PARTS), self.store.read(lifetime.RECURRING))

    def grouped_orders(self, users: DataFrame, group: str) -> DataFrame:
        if not self.store.exists(lifetime.PARTS):
            return super().grouped_orders(users, group)
        return lifetime.group_totals(self.store.read(lifetime.PARTS), self.store.read(lifetime.RECURRING), users, group)


def recent(facts: DataFrame, as_of: DateLike, days: int) -> DataFrame:
    """Fact rows of the last ``days`` days, by the stored integer key: the bound folds to
    a constant, so stored facts open only the partitions of those days.  Late rows are
    found by their own day, whenever they were loaded."""
    return facts.filter(F.col("date_id") >= date_key_ago(as_of, days))


def order_count() -> Column:
    """Distinct orders.  An order id may recur on another load day, so rows do not do."""
    return F.count_distinct("order_id").alias("order_count")


def with_dates(per_day: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Attach calendar columns to rows keyed by ``date_id`` (unknown days drop out)."""
    return per_day.join(calendar(dim_date, "date_id", *columns), "date_id")


def with_products(rows: DataFrame, dim_product: DataFrame, *columns: str) -> DataFrame:
    """Attach product columns (unknown products drop out).

    No broadcast hint: the catalogue may be large.  Spark broadcasts these few columns
    when their measured size allows it and otherwise sort-merges, and AQE splits the
    partition of a product that dominates the fact rows.
    """
    return rows.join(dim_product.select("product_id", *columns), "product_id")
