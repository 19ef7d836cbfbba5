"""The shared test tables seen as the warehouse's layers.

Order lines play the orders (their key repeats, so keeping the latest copy does real
work), ``events`` the click stream, ``part`` the catalogue and ``customer`` the users.
Every view is a lazy expression over the Parquet tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions import date_key, raw_line
from tidemart.operators import dimensions, facts, metrics, quality
from tidemart.operators.merge import history_from_snapshots
from tidemart.operators.staging import Staged, keep_latest, stage_events, stage_orders
from tidemart.plans.warehouse import Warehouse
from tidemart.schemas import CONTRACTS

# The last order date and the day after the last event.
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"

ORDER_STATUS = {"F": "paid", "O": "pending", "P": "cancelled"}
EVENT_TYPE = {
    "view": "page_view", "click": "view_product", "signup": "add_to_cart", "error": "checkout",
    "purchase": "purchase",
}
_SCHEMAS: dict[str, StructType] = {}
LATEST_LINE = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def mapped(col: Column, values: dict[str, str]) -> Column:
    """A lookup as a CASE expression; other values pass through."""
    out = col
    for key, value in values.items():
        out = F.when(col == key, F.lit(value)).otherwise(out)
    return out


def money(col: Column, kind: str = "decimal(26,12)") -> Column:
    return col.cast(kind)


class DriverTables(Warehouse):
    """Layer views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One test table; its schema is read from the footer once per process."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # ---- orders ------------------------------------------------------------------
    @functools.cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with their header, one row per delivered copy."""
        header = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate",
            "o_orderpriority")
        return self._identified(self.table("lineitem").join(header, "l_orderkey"))

    @functools.cached_property
    def latest_lines(self) -> DataFrame:
        """The latest copy of each order line with its header.

        Copies are dropped before the header is joined: the join then handles one row
        per order line.
        """
        newest = [F.col(c).desc() for c in LATEST_LINE]
        lines = keep_latest(self.table("lineitem"), ["l_orderkey", "l_linenumber"], newest)
        header = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate")
        return self._identified(lines.join(header, "l_orderkey"))

    @staticmethod
    def _identified(lines: DataFrame) -> DataFrame:
        return lines.select(
            "*",
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
            F.col("o_custkey").cast("string").alias("user_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            mapped(F.col("o_orderstatus"), ORDER_STATUS).alias("status"),
            F.to_date("o_orderdate").alias("run_date"),
        )

    @staticmethod
    def order_document(**overrides: Column) -> Column:
        """An order line as a JSON document."""
        fields = {
            "order_id": F.col("order_id"), "user_id": F.col("user_id"), "product_id": F.col("product_id"),
            "quantity": F.col("quantity"), "price": F.col("l_extendedprice"),
            "timestamp": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), "status": F.col("status"),
        } | overrides
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))

    def raw_orders(self, **overrides: Column) -> DataFrame:
        """``raw.orders_json``: one document per delivered copy."""
        # The file name carries the rest of the copy's identity, so ties break the same
        # way as in the typed view.
        copy = F.concat_ws("/", *[F.lpad(F.col(c).cast("bigint").cast("string"), 12, "0")
                                  for c in ("l_partkey", "l_suppkey", "l_quantity")])
        return self.order_lines.select(
            copy.alias("file_name"),
            F.col("l_shipdate").alias("ingested_at"),
            self.order_document(**overrides).alias("raw_json"),
            "run_date",
        )

    @property
    def copy_order(self) -> list[Column]:
        return [F.col("file_name").desc(), F.col("doc_price").try_cast("decimal(26,12)").desc()]

    def staged_from_documents(self, **overrides: Column) -> Staged:
        """Orders staged through their JSON documents."""
        return stage_orders(self.raw_orders(**overrides), loaded_at=F.lit("2025-01-01").cast("timestamp_ntz"),
                            tiebreak=self.copy_order)

    def messy_orders(self) -> Staged:
        """The same documents with the defects a source can have."""
        nothing = F.lit(None).cast("string")
        return self.staged_from_documents(
            order_id=F.when(F.col("l_quantity") != 50, F.col("order_id")).otherwise(nothing),
            user_id=F.when(F.col("o_orderpriority") != "5-LOW", F.col("user_id")).otherwise(nothing),
            quantity=F.when(F.col("l_tax") == 0, F.lit("n/a")).otherwise(F.col("quantity").cast("string")),
            price=F.when(F.col("l_discount") == 0.1, F.col("l_extendedprice").cast("decimal(12,2)") * 10000)
            .otherwise(F.col("l_extendedprice").cast("decimal(12,2)")).cast("string"),
            timestamp=F.when(F.col("l_returnflag") == "R", F.lit("unknown"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")),
        )

    @staticmethod
    def _typed(lines: DataFrame) -> DataFrame:
        """Typed staging columns straight from the line columns."""
        price = money(F.col("l_extendedprice"))
        return lines.select(
            "order_id", "user_id", "product_id", "quantity",
            price.cast("decimal(10,2)").alias("unit_price"),
            (F.col("quantity") * price).cast("decimal(12,2)").alias("revenue"),
            F.col("o_orderdate").alias("order_ts"),
            "status",
            F.col("o_orderdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
            F.col("run_date").alias("load_date"),
            *[c for c in ("l_returnflag",) if c in lines.columns],
        )

    @functools.cached_property
    def staged_orders(self) -> DataFrame:
        """``staging.orders_clean``, typed without the detour through JSON."""
        return self._typed(self.latest_lines).select(*CONTRACTS["staging.orders_clean"].column_names)

    @functools.cached_property
    def loaded_orders(self) -> DataFrame:
        """Typed lines before deduplication, returned items with negative revenue: what
        the quality checks are there to catch."""
        rows = self._typed(self.order_lines)
        signed = F.when(F.col("l_returnflag") == "R", -F.col("revenue")).otherwise(F.col("revenue"))
        return rows.withColumn("revenue", signed.cast("decimal(12,2)")) \
            .select(*CONTRACTS["staging.orders_clean"].column_names)

    @functools.cached_property
    def fact_orders(self) -> DataFrame:
        return self.staged_orders.withColumn("date_id", date_key(F.col("order_ts"))) \
            .select(*CONTRACTS["warehouse.fact_orders"].column_names)

    # ---- events ------------------------------------------------------------------
    @functools.cached_property
    def event_rows(self) -> DataFrame:
        """``events`` with the warehouse's names and types; page views have no product."""
        kind = mapped(F.col("event_type"), EVENT_TYPE)
        product = F.when(F.col("event_type") == "view", F.lit("")) \
            .otherwise(F.get_json_object("props", "$.k"))
        return self.table("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            product.alias("product_id"),
            kind.alias("event_type"),
            F.col("ts").alias("event_ts"),
            F.col("event_type").alias("source_type"),
            "value",
        )

    @functools.cached_property
    def raw_events(self) -> DataFrame:
        """``raw.events_csv`` with every event delivered twice, the later copy in upper case."""
        fields = ["event_id", "user_id", "product_id", "event_type", "event_ts"]
        copies = []
        for hours, kind in ((1, F.col("event_type")), (2, F.upper("event_type"))):
            copies.append(self.event_rows.withColumn("event_type", kind).select(
                F.lit(f"copy-{hours}").alias("file_name"),
                (F.col("event_ts") + F.expr(f"interval {hours} hour")).alias("ingested_at"),
                raw_line(fields).alias("raw_line"),
                *fields,
                F.to_date("event_ts").alias("run_date"),
            ))
        return copies[0].unionByName(copies[1])

    def messy_events(self) -> Staged:
        """Raw events with unreadable times, missing users and an unknown type."""
        rows = self.event_rows.select("*", F.col("event_ts").alias("_day"))
        nothing = F.lit(None)
        messy = rows.withColumn(
            "event_ts", F.when((F.col("source_type") == "error") & (F.col("value") > 20), nothing)
            .otherwise(F.col("event_ts"))
        ).withColumn(
            "user_id", F.when(F.col("value") < 1, nothing).otherwise(F.col("user_id"))
        ).withColumn(
            "event_type", F.when(F.col("source_type") == "signup", F.lit("signup")).otherwise(F.col("event_type"))
        )
        fields = ["event_id", "user_id", "product_id", "event_type", "event_ts"]
        raw = messy.select(
            F.lit("events").alias("file_name"), F.col("_day").alias("ingested_at"),
            F.concat_ws(",", "event_id", "source_type").alias("raw_line"), *fields,
            F.to_date("_day").alias("run_date"))
        return stage_events(raw, check_types=True, loaded_at=F.lit("2025-01-01").cast("timestamp_ntz"))

    @functools.cached_property
    def staged_events(self) -> DataFrame:
        """``staging.events_clean``: the ids are unique in the source, so nothing to merge."""
        stamp = F.col("event_ts")
        return self.event_rows.select(
            "event_id", "user_id", F.nullif("product_id", F.lit("")).alias("product_id"), "event_type",
            "event_ts", stamp.alias("created_at"), stamp.alias("updated_at"),
            F.to_date("event_ts").alias("load_date"))

    @functools.cached_property
    def late_events(self) -> DataFrame:
        """Staged events that arrive zero to two days after their own day."""
        days = (F.col("event_id").cast("bigint") % 3).cast("int")
        return self.staged_events.withColumn("load_date", F.date_add(F.to_date("event_ts"), days))

    @functools.cached_property
    def fact_events(self) -> DataFrame:
        return self.staged_events.withColumn("date_id", date_key(F.col("event_ts"))) \
            .select(*CONTRACTS["warehouse.fact_events"].column_names)

    # ---- dimensions ----------------------------------------------------------------
    @functools.cached_property
    def dim_date(self) -> DataFrame:
        early = dimensions.build_dim_date(self.spark, "1995-01-01", "2001-12-31")
        return early.unionByName(dimensions.build_dim_date(self.spark, "2024-01-01", "2024-12-31"))

    @functools.cached_property
    def dim_user(self) -> DataFrame:
        """Customers with city, first order date and market segment."""
        city = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
        signup = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.to_date(F.min("o_orderdate")).alias("signup_date"))
        return self.table("customer").join(city, "c_nationkey").join(signup, "c_custkey", "left").select(
            F.col("c_custkey").cast("string").alias("user_id"), "city", "signup_date",
            F.col("c_mktsegment").alias("marketing_source"))

    @functools.cached_property
    def dim_product(self) -> DataFrame:
        return self._products(self.table("part"))

    @staticmethod
    def _products(part: DataFrame) -> DataFrame:
        return part.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            money(F.col("p_retailprice")).cast("decimal(10,2)").alias("current_price"),
        )

    @functools.cached_property
    def listed_products(self) -> DataFrame:
        """Products in smaller sizes: a catalogue that does not know every product sold."""
        return self._products(self.table("part").filter("p_size <= 25"))

    @functools.cached_property
    def good_users(self) -> DataFrame:
        """Users in credit: a user dimension that does not know every buyer."""
        return self.table("customer").filter("c_acctbal >= 0").select(
            F.col("c_custkey").cast("string").alias("user_id"))

    @functools.cached_property
    def stocked_products(self) -> DataFrame:
        """The catalogue with stock (part size) and the average discount it sold at."""
        sold = self.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
            F.sum(F.col("l_discount").cast("decimal(12,2)")).alias("d"), F.count("l_discount").alias("n"))
        part = self.table("part").join(sold, "p_partkey", "left")
        average = F.round(F.col("d") * 100 / F.col("n").cast("decimal(20,0)"), 2).cast("decimal(12,2)")
        return part.select(
            F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_size").alias("stock"),
            money(F.col("p_retailprice")).cast("decimal(10,2)").alias("current_price"),
            average.alias("discount_percentage"))

    # ---- run metrics and audit -------------------------------------------------------
    def checked_fact_orders(self) -> DataFrame:
        return facts.load_fact_orders(self.staged_orders, self.dim_date, self.listed_products, self.good_users)

    def checked_fact_events(self) -> DataFrame:
        return facts.load_fact_events(self.staged_events, self.dim_date, self.good_users)

    def check_report(self, *only: str) -> DataFrame:
        return quality.check_report(self.loaded_orders, self.staged_events,
                                    as_of=F.lit("2001-01-01").cast("timestamp_ntz"), only=only or None)

    def dq_failures(self) -> DataFrame:
        return quality.failures(self.check_report())

    def raw_order_days(self) -> DataFrame:
        """Raw orders as far as counting needs them."""
        return self.order_lines.select("run_date")

    def metrics(self) -> DataFrame:
        """Run metrics per day; the runtime is a stand-in derived from the volume."""
        events = self.event_rows.select(F.to_date("event_ts").alias("run_date"))
        rows = metrics.daily_metrics({
            "raw_orders_count": self.raw_order_days(),
            "staging_orders_count": self.staged_orders,
            "fact_orders_count": self.checked_fact_orders(),
            "raw_events_count": events.unionAll(events),
            "staging_events_count": self.staged_events,
            "fact_events_count": self.checked_fact_events(),
            "dq_failed_count": self.dq_failures(),
        })
        return rows.withColumn(
            "runtime_seconds", (F.col("raw_orders_count") * 200 + F.col("raw_events_count")).cast("bigint"))

    def bad_records(self) -> DataFrame:
        """Quarantined and rejected orders together."""
        rejected = facts.reject_fact_orders(
            self.staged_orders, self.dim_date, self.listed_products, self.good_users)
        return self.messy_orders().bad.unionByName(rejected)

    def product_history(self) -> DataFrame:
        """Two catalogue versions: from 1998 on the smaller parts cost a tenth more."""
        first = self.dim_product.withColumn("load_date", F.lit("1995-01-01").cast("date"))
        raised = self._products(self.table("part").filter("p_size <= 25")) \
            .withColumn("current_price", (F.col("current_price") * F.lit(1.1).cast("decimal(3,1)")).cast("decimal(10,2)")) \
            .withColumn("load_date", F.lit("1998-01-01").cast("date"))
        return history_from_snapshots(first.unionByName(raised), ["product_id"], dimensions.PRODUCT_ATTRIBUTES)
