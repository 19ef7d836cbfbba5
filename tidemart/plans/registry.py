"""Every operator as a named query over the shared test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import exprs, raw_line
from tidemart.operators import dimensions, facts, lifetime, merge, metrics, quality, staging
from tidemart.operators.store import TableStore
from tidemart.plans import backfill, customers, funnel, health, increments, products, revenue
from tidemart.plans.warehouse import StoredWarehouse
from tidemart.plans.driver_tables import EVENTS_AS_OF, ORDERS_AS_OF, DriverTables, money
from tidemart.schemas import CONTRACTS
from tidemart.session import scratch_dir
from tidemart.sources import documents, landing
from tidemart.streaming import ingest, late

TENURE_AS_OF = "1995-12-31"
# The days that landed files are spread over, and the one whose orders fail a check.
JANUARY = ("2024-01-01", "2024-01-30")
FAILING_DAY = "2024-01-15"
# Large landed files are compressed; readers tell by the name.
LANDED = "gzip"
QUERIES: dict[str, Callable[[DriverTables], DataFrame]] = {}

EVENT_FIELDS = ["event_id", "user_id", "product_id", "event_type", "event_ts"]
NO_RAW = ["source_table", "record_id", "failure_reason", "failed_value", "run_date"]


def query(fn: Callable[[DriverTables], DataFrame]) -> Callable[[DriverTables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Columns in the few types that every engine prints alike."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col, ",")
        out.append(col.alias(field.name))
    return df.select(*out)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return portable(QUERIES[name](DriverTables(spark, folder)))


# ---- sources ---------------------------------------------------------------------------


def _fields(raw: DataFrame, *columns: str) -> DataFrame:
    """The order fields of raw documents under their own names."""
    return staging.order_documents(raw).select(
        *columns, *[F.col(f"doc_{f}").alias(f) for f in staging.ORDER_FIELDS])


@query
def raw_orders_scan(t: DriverTables) -> DataFrame:
    """Land order documents (objects and arrays, one per line), then scan them."""
    root = scratch_dir(t.spark, "landing")
    path = landing.landing_path(root, "orders", ORDERS_AS_OF)
    doc = t.order_document()
    line = F.when(F.col("status") == "paid", F.concat(F.lit("["), doc, F.lit("]"))).otherwise(doc)
    t.order_lines.select(line).write.text(path)
    rows = landing.read_orders(t.spark, path, ORDERS_AS_OF)
    return _fields(rows, "run_date")


@query
def raw_events_scan(t: DriverTables) -> DataFrame:
    """Land event CSV files, then scan them."""
    path = landing.landing_path(scratch_dir(t.spark, "landing"), "events", EVENTS_AS_OF)
    _event_text(t).write.csv(path, header=True)
    return landing.read_events(t.spark, path, EVENTS_AS_OF).select(
        "run_date", "raw_line", *EVENT_FIELDS)


@query
def raw_events_by_header(t: DriverTables) -> DataFrame:
    """Land events in two files groups with other column orders, one with a column more."""
    path = landing.landing_path(scratch_dir(t.spark, "landing"), "events", EVENTS_AS_OF)
    text = _event_text(t)
    odd = F.col("event_id").cast("bigint") % 2 == 1
    text.filter(~odd).write.csv(f"{path}/a", header=True)
    text.filter(odd).select("user_id", "event_ts", F.lit("web").alias("channel"), "event_type", "event_id", "product_id") \
        .write.csv(f"{path}/b", header=True)
    return landing.read_events(t.spark, path, EVENTS_AS_OF).select("run_date", *EVENT_FIELDS)


def _event_text(t: DriverTables) -> DataFrame:
    ts = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.event_rows.select("event_id", "user_id", "product_id", "event_type", ts.alias("event_ts"))


def _catalog_documents(t: DriverTables) -> DataFrame:
    """The part table as catalogue documents, some fields left out here and there."""
    part = t.table("part")
    size = F.col("p_size")
    return part.select(F.to_json(F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.when(size >= 10, F.col("p_type")).alias("category"),
        F.when(size <= 40, F.col("p_brand")).alias("brand"),
        F.concat_ws(" ", "p_brand", "p_name").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_type") != "PROMO", F.struct(
            (size / 10).cast("double").alias("rate"), size.alias("count"))).alias("rating"),
    )).alias("raw_json"))


def _raw_products(t: DriverTables) -> DataFrame:
    """``raw.products_json``: the catalogue fetched twice, a unit dearer the second time."""
    part = t.table("part")
    copies = []
    for hour, extra in ((1, 0), (2, 1)):
        doc = F.to_json(F.struct(
            F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
            (money(F.col("p_retailprice"), "decimal(12,2)") + extra).alias("current_price")))
        copies.append(part.select(
            F.lit(f"{ORDERS_AS_OF} 0{hour}:00:00").cast("timestamp_ntz").alias("fetched_at"),
            doc.alias("raw_json"), F.lit(ORDERS_AS_OF).cast("date").alias("run_date")))
    return copies[0].unionByName(copies[1])


@query
def raw_products_scan(t: DriverTables) -> DataFrame:
    """Land a catalogue snapshot, then scan it."""
    path = landing.landing_path(scratch_dir(t.spark, "landing"), "products", "2001-07-30")
    _catalog_documents(t).write.text(path)
    rows = landing.read_products(t.spark, path, "2001-07-30")
    doc = F.from_json("raw_json", "id STRING, title STRING, category STRING, brand STRING, price DOUBLE")
    return rows.select("run_date", doc.alias("d")).select("run_date", "d.*")


@query
def first_available_source(t: DriverTables) -> DataFrame:
    """Two catalogue days: one has landed; the other has not and comes from nested documents."""
    root = scratch_dir(t.spark, "landing")
    landed = landing.landing_path(root, "products", "2001-07-23")
    smaller = t.table("part").filter("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"))
    smaller.select(F.to_json(F.struct("product_id", "product_name"))).write.text(landed)
    days = []
    for day in ("2001-07-23", "2001-07-30"):
        file = landing.read_products(t.spark, landing.landing_path(root, "products", day), day)
        catalogue = documents.to_raw_products(documents.normalize_catalog(_catalog(t)), day, _seen())
        days.append(landing.first_available(file, file.limit(0), catalogue))
    raw = days[0].unionByName(days[1])
    return staging.document_fields(raw, ("product_id", "product_name")).select(
        "run_date", F.col("doc_product_id").alias("product_id"), F.col("doc_product_name").alias("product_name"))


@query
def events_raw_line(t: DriverTables) -> DataFrame:
    rows = _event_text(t)
    return rows.select("event_id", raw_line(rows.columns).alias("raw_line"))


@query
def events_fallback_id(t: DriverTables) -> DataFrame:
    """Checkout events arrive without an id and get the md5 of their line."""
    blanked = F.when(F.col("event_type") == "checkout", F.lit("")).otherwise(F.col("event_id"))
    rows = _event_text(t).withColumn("event_id", blanked)
    return landing.shape_events(rows, F.lit("events.csv"), EVENTS_AS_OF).select("raw_line", "event_id", "event_type")


@query
def weekly_snapshot_filter(t: DriverTables) -> DataFrame:
    days = t.table("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    return landing.weekly_snapshot_filter(days, "day")


def _carts(t: DriverTables) -> DataFrame:
    """Orders as cart documents, their items gathered from all order lines in a fixed order.

    An order has few lines, so a cart is small; partial aggregation starts it in the map
    tasks.  Orders without lines are empty carts.
    """
    line = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")]
    items = t.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list(F.struct(*line))).alias("lines"))
    products = F.transform("lines", lambda x: F.struct(
        x["l_partkey"].alias("productId"), x["l_quantity"].cast("int").alias("quantity"),
        x["l_extendedprice"].cast("decimal(12,2)").cast("string").alias("price")))
    orders = t.table("orders").join(items, "o_orderkey", "left").withColumn("products", F.coalesce(products, F.array()))
    docs = orders.select(F.to_json(F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("userId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("total"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("discountedTotal"),
        F.size("products").alias("totalProducts"),
        F.aggregate("products", F.lit(0), lambda n, x: n + x["quantity"]).alias("totalQuantity"),
        "products",
    )).alias("raw_json"))
    return documents.parse_documents(docs, documents.CART_SCHEMA)


def _seen() -> Column:
    return F.lit("2001-08-01 12:00:00").cast("timestamp_ntz")


@query
def carts_to_orders(t: DriverTables) -> DataFrame:
    orders = documents.carts_to_orders(_carts(t), _seen())
    return orders.withColumn("products", F.size("products"))


@query
def cart_order_lines(t: DriverTables) -> DataFrame:
    """Cart items as order lines, all the way through order staging."""
    lines = documents.cart_order_lines(_carts(t), _seen())
    raw = documents.to_raw_orders(lines, "carts", ORDERS_AS_OF, _seen())
    return staging.stage_orders(raw, loaded_at=_seen()).good.drop("created_at", "updated_at")


@query
def catalog_normalize(t: DriverTables) -> DataFrame:
    return documents.normalize_catalog(
        documents.parse_documents(_catalog_documents(t), documents.CATALOG_SCHEMA)
    ).drop("stock", "discount_percentage")


def _catalog(t: DriverTables) -> DataFrame:
    return documents.parse_documents(_catalog_documents(t), documents.CATALOG_SCHEMA)


@query
def derive_view_events(t: DriverTables) -> DataFrame:
    return documents.view_events(_catalog(t), ORDERS_AS_OF, _seen())


@query
def derive_cart_events(t: DriverTables) -> DataFrame:
    return documents.cart_events(_carts(t), ORDERS_AS_OF)


@query
def derive_events_union(t: DriverTables) -> DataFrame:
    return documents.derived_events(_catalog(t), _carts(t), ORDERS_AS_OF, _seen())


# ---- staging ---------------------------------------------------------------------------


@query
def stg_orders(t: DriverTables) -> DataFrame:
    return t.staged_from_documents().good.drop("created_at", "updated_at")


@query
def stg_events(t: DriverTables) -> DataFrame:
    return staging.stage_events(t.raw_events).good.drop("created_at", "updated_at")


@query
def stg_products(t: DriverTables) -> DataFrame:
    return staging.stage_products(_raw_products(t)).good.drop("created_at", "updated_at", *dimensions.PRODUCT_EXTRAS)


@query
def json_extract_orders(t: DriverTables) -> DataFrame:
    return _fields(t.raw_orders())


@query
def dedup_latest_order(t: DriverTables) -> DataFrame:
    docs = staging.order_documents(t.raw_orders())
    return staging.latest_orders(docs, t.copy_order).select(
        F.col("doc_order_id").alias("order_id"), F.col("doc_product_id").alias("product_id"), "ingested_at")


@query
def dedup_latest_event(t: DriverTables) -> DataFrame:
    latest = staging.keep_latest(
        t.raw_events, ["event_id", "run_date"], [F.desc("ingested_at"), F.desc("file_name")])
    return latest.select("event_id", "event_type", "ingested_at")


@query
def quarantine_orders(t: DriverTables) -> DataFrame:
    return t.messy_orders().bad.select(*NO_RAW)


@query
def quarantine_events(t: DriverTables) -> DataFrame:
    return t.messy_events().bad.select(*NO_RAW)


@query
def event_type_domain(t: DriverTables) -> DataFrame:
    rows = t.event_rows.select(F.lower("source_type").alias("event_type"))
    return quality.unknown_event_types(rows)


@query
def date_key(t: DriverTables) -> DataFrame:
    return t.table("orders").select("o_orderkey", exprs.date_key(F.col("o_orderdate")).alias("date_id"))


# ---- quality ---------------------------------------------------------------------------


@query
def dq_orders_volume(t: DriverTables) -> DataFrame:
    return t.check_report("orders_volume")


@query
def dq_events_volume(t: DriverTables) -> DataFrame:
    return t.check_report("events_volume")


@query
def dq_orders_duplicates(t: DriverTables) -> DataFrame:
    return t.check_report("orders_no_duplicates")


@query
def dq_events_duplicates(t: DriverTables) -> DataFrame:
    """The event check over a staging table that holds every event twice."""
    twice = t.staged_events.unionByName(t.staged_events)
    return quality.check_report(t.loaded_orders, twice, only=["events_no_duplicates"])


@query
def dq_negative_revenue(t: DriverTables) -> DataFrame:
    return t.check_report("orders_revenue_valid")


@query
def dq_future_timestamps(t: DriverTables) -> DataFrame:
    return t.check_report("timestamps_not_future")


@query
def dq_report(t: DriverTables) -> DataFrame:
    return t.check_report()


@query
def dq_failures_log(t: DriverTables) -> DataFrame:
    return t.dq_failures()


@query
def duplicate_order_ids(t: DriverTables) -> DataFrame:
    return quality.duplicate_ids(t.loaded_orders, "order_id")


@query
def cross_day_duplicate_events(t: DriverTables) -> DataFrame:
    return quality.cross_day_duplicates(t.staged_events.unionByName(t.late_events), "event_id")


@query
def constraint_violations(t: DriverTables) -> DataFrame:
    contract = CONTRACTS["staging.orders_clean"]
    return quality.constraint_violations(t.messy_orders().typed.filter("order_id IS NOT NULL").select(*contract.column_names), contract)


@query
def constraint_violations_loaded(t: DriverTables) -> DataFrame:
    return quality.constraint_violations(t.loaded_orders, CONTRACTS["staging.orders_clean"])


@query
def constraint_report(t: DriverTables) -> DataFrame:
    """Order lines with every kind of breach and the events, by year and month of load, against
    dimensions that do not know them all."""
    price = F.col("l_extendedprice").cast("decimal(30,2)")
    lines = t.latest_lines.select(
        "order_id", F.when(F.col("l_tax") != 0, F.col("user_id")).alias("user_id"), "product_id",
        exprs.date_key(F.col("o_orderdate")).alias("date_id"), "quantity",
        (F.col("quantity") * price * F.when(F.col("l_discount") == 0.1, 100_000).otherwise(1)).cast("decimal(38,2)").alias("revenue"),
        F.col("o_orderdate").alias("order_ts"), F.when(F.col("l_returnflag") == "R", F.repeat("status", F.lit(9))).otherwise(F.col("status")).alias("status"),
        F.trunc("o_orderdate", "year").alias("load_date"), "l_linenumber")
    orders = lines.unionByName(lines.filter("l_linenumber = 1")).drop("l_linenumber")
    events = t.fact_events.withColumn("load_date", F.trunc("load_date", "month"))
    return quality.constraint_report(
        {"warehouse.fact_orders": orders, "warehouse.fact_events": events},
        {"warehouse.dim_date": t.dim_date.filter("year >= 1997"), "warehouse.dim_user": t.good_users,
         "warehouse.dim_product": t.listed_products})


# ---- dimensions ------------------------------------------------------------------------


@query
def dim_date(t: DriverTables) -> DataFrame:
    """The calendar spanned by the orders."""
    span = t.table("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d"))
    return days.select(*dimensions.date_attributes(F.col("d")))


@query
def date_attributes(t: DriverTables) -> DataFrame:
    """Calendar columns of every event and order day that occurs."""
    days = t.table("orders").select(F.to_date("o_orderdate").alias("d")).union(
        t.table("events").select(F.to_date("ts"))).distinct()
    return days.select(*dimensions.date_attributes(F.col("d")))


@query
def insert_absent_dim_date(t: DriverTables) -> DataFrame:
    """A calendar of the year 2001 to which the days of all orders are added."""
    current = dimensions.build_dim_date(t.spark, "2001-01-01", "2001-12-31").withColumn("day_name", F.lit("kept"))
    days = t.table("orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    incoming = days.select(*dimensions.date_attributes(F.col("d")))
    return merge.insert_absent(current, incoming, ["date_id"])


@query
def dim_user_load(t: DriverTables) -> DataFrame:
    return dimensions.users_of_day(t.staged_orders)


def _stamped(df: DataFrame, at: str) -> DataFrame:
    stamp = F.lit(at).cast("timestamp_ntz")
    return df.withColumn("created_at", stamp).withColumn("updated_at", stamp)


@query
def upsert_dim_user(t: DriverTables) -> DataFrame:
    """Users in credit are known; all buyers are merged into the stored table, with all customers' attributes."""
    known = _stamped(t.good_users.select(
        "user_id", F.lit("old").alias("city"), F.lit(None).cast("date").alias("signup_date"),
        F.lit(None).cast("string").alias("marketing_source")), "2001-01-01 00:00:00")
    attributes = t.dim_user.filter(F.col("marketing_source") != "FURNITURE")
    store, table = TableStore(t.spark, scratch_dir(t.spark, "users"), buckets=16), "warehouse.dim_user"
    store.write_snapshot(table, known)
    touching = dimensions.users_of_day(t.staged_orders).unionByName(attributes.select("user_id"))
    store.merge(table, touching, lambda current: dimensions.load_dim_user(current, t.staged_orders, None, attributes, _seen()))
    return store.read(table)


@query
def upsert_dim_product(t: DriverTables) -> DataFrame:
    """Smaller parts are known; larger ones arrive dearer, the largest without a brand."""
    part = t.table("part")
    known = _stamped(t._products(part.filter("p_size <= 30")), "2001-01-01 00:00:00").select(
        "*", F.lit("2001-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"))
    known = known.select(*[c for c in CONTRACTS["warehouse.dim_product"].column_names if c in known.columns])
    arriving = part.filter("p_size >= 20").withColumn(
        "p_brand", F.when(F.col("p_size") <= 40, F.col("p_brand")))
    staged = t._products(arriving).withColumn("current_price", (F.col("current_price") + 1).cast("decimal(10,2)"))
    staged = staged.withColumn("load_date", F.lit(ORDERS_AS_OF).cast("date"))
    return dimensions.load_dim_product(known, staged, ORDERS_AS_OF, _seen())


@query
def scd2_dim_product(t: DriverTables) -> DataFrame:
    """Three catalogue snapshots merged one after the other into a version history."""
    part = t.table("part")
    columns = [c for c in CONTRACTS["warehouse.dim_product_history"].column_names if c not in dimensions.PRODUCT_EXTRAS]
    history = t._products(part.filter("p_size <= 40")).select(
        "*", F.lit("1995-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to")).select(*columns)
    dearer = (F.col("current_price") + F.when(F.col("p_size") <= 25, 5).otherwise(0)).cast("decimal(10,2)")
    second = _part_snapshot(t, part.filter("p_size >= 10"), current_price=dearer)
    history = merge.merge_history(history, second, ["product_id"], dimensions.PRODUCT_ATTRIBUTES, "1998-01-01")
    third = _part_snapshot(t, part.filter("p_size <= 20"), current_price=dearer,
                           brand=F.when(F.col("p_size") > 5, F.col("brand")))
    return merge.merge_history(history, third, ["product_id"], dimensions.PRODUCT_ATTRIBUTES, "2000-01-01")


def _part_snapshot(t: DriverTables, part: DataFrame, **changes) -> DataFrame:
    rows = part.select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        money(F.col("p_retailprice")).cast("decimal(10,2)").alias("current_price"), "p_size")
    return rows.withColumns(changes).drop("p_size")


@query
def product_price_asof(t: DriverTables) -> DataFrame:
    return products.price_at_order(t, t.product_history())


# ---- facts and metrics -----------------------------------------------------------------


@query
def fact_orders_load(t: DriverTables) -> DataFrame:
    return t.checked_fact_orders()


@query
def fact_events_load(t: DriverTables) -> DataFrame:
    return t.checked_fact_events()


@query
def fact_events_late_days(t: DriverTables) -> DataFrame:
    """Late events through the job's calendar step, from an empty calendar."""
    empty = t.spark.createDataFrame([], CONTRACTS["warehouse.dim_date"].ddl)
    calendar = dimensions.load_dim_date(empty, EVENTS_AS_OF, t.late_events.select("event_ts"))
    return facts.load_fact_events(t.late_events, calendar, t.good_users)


@query
def fact_orders_rejects(t: DriverTables) -> DataFrame:
    return facts.reject_fact_orders(
        t.staged_orders, t.dim_date, t.listed_products, t.good_users).select(*NO_RAW)


@query
def fact_events_rejects(t: DriverTables) -> DataFrame:
    return facts.reject_fact_events(t.staged_events, t.dim_date, t.good_users).select(*NO_RAW)


@query
def fact_row_ids(t: DriverTables) -> DataFrame:
    """Stored facts with the ids that the store gives them, after a day was loaded twice."""
    store = TableStore(t.spark, scratch_dir(t.spark, "ids"))
    day = F.date_add(F.lit(JANUARY[0]).cast("date"), F.pmod(F.split_part("order_id", F.lit("-"), F.lit(1)).cast("int"), F.lit(30)))
    rows = t.fact_orders.withColumn("load_date", day).withColumn("date_id", exprs.date_key(day))
    store.reload_days("warehouse.fact_orders", rows)
    store.reload_day("warehouse.fact_orders", rows.filter(F.col("load_date") == F.lit(JANUARY[0])), JANUARY[0])
    return store.read("warehouse.fact_orders", identified=True).select(
        "fact_orders_id", "order_id", "load_date", F.col("created_at").isNotNull().alias("stamped"))


@query
def mv_daily_orders_summary(t: DriverTables) -> DataFrame:
    return facts.daily_orders_summary(facts.orders_summary_parts(t.fact_orders))


@query
def mv_daily_revenue(t: DriverTables) -> DataFrame:
    return facts.daily_revenue(facts.revenue_parts(t.fact_orders))


@query
def daily_metrics(t: DriverTables) -> DataFrame:
    return t.metrics()


@query
def layer_counts(t: DriverTables) -> DataFrame:
    return metrics.layer_counts({
        "raw_orders": t.raw_order_days(), "staging_orders": t.staged_orders,
        "fact_orders": t.checked_fact_orders(), "raw_events": t.event_rows.unionAll(t.event_rows),
        "fact_events": t.checked_fact_events(),
    })


@query
def reload_day_idempotent(t: DriverTables) -> DataFrame:
    """Load all days twice, then one day again with fewer rows and one with none."""
    store = TableStore(t.spark, scratch_dir(t.spark, "store"))
    table, rows = "staging.events_clean", t.late_events
    store.reload_days(table, rows)
    store.reload_days(table, rows)
    fewer = rows.filter((F.col("load_date") == F.lit("2024-01-10")) & (F.col("event_type") == "purchase"))
    store.reload_day(table, fewer, "2024-01-10")
    store.reload_day(table, rows.filter("false"), "2024-01-20")
    return store.read(table).select(*EVENT_FIELDS, "load_date")


def _land_january(t: DriverTables, root: str) -> None:
    """All order lines and events as thirty days of landed files, with a catalogue each Monday.

    On Monday the 15th some orders have negative prices.  Catalogues grow from week to
    week, and the smallest parts cost more each time.
    """
    text = _event_text(t).withColumn("date", F.to_date("event_ts"))
    text.write.partitionBy("date").csv(f"{root}/incoming/events", header=True, compression=LANDED)
    day = F.date_add(F.lit(JANUARY[0]).cast("date"), (F.col("l_orderkey") % 30).cast("int"))
    lines = t.latest_lines.withColumn("date", day)
    refunded = (F.col("date") == F.lit(FAILING_DAY)) & (F.col("l_returnflag") == "R")
    price = F.when(refunded, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    doc = t.order_document(price=price, timestamp=F.concat(F.col("date").cast("string"), F.lit("T12:00:00")))
    # The first line of an order arrives twice.
    copies = F.explode(F.when(F.col("l_linenumber") == 1, F.array(doc, doc)).otherwise(F.array(doc)))
    lines.select(copies.alias("value"), "date").write.partitionBy("date").text(f"{root}/incoming/orders", compression=LANDED)
    for week, monday in enumerate(("2024-01-01", "2024-01-08", FAILING_DAY, "2024-01-22", "2024-01-29"), 1):
        price = money(F.col("p_retailprice"), "decimal(12,2)") + F.when(F.col("p_size") <= 5, week).otherwise(0)
        part = t.table("part").filter(F.col("p_size") <= 10 * week)
        part.select(F.to_json(F.struct(
            F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), price.alias("current_price"))).alias("value")) \
            .write.text(landing.landing_path(root, "products", monday))


def _loaded_rows(store: TableStore) -> DataFrame:
    """Facts and dimensions of a stored warehouse in one shape."""
    nothing = F.lit(None)
    parts = [
        store.read("warehouse.fact_orders").select(
            F.lit("order").alias("kind"), F.col("order_id").alias("id"), "user_id", "product_id",
            F.col("load_date").alias("day"), nothing.cast("date").alias("until"), F.col("revenue").alias("amount")),
        store.read("warehouse.fact_events").select(
            F.lit("event"), "event_id", "user_id", "product_id", "load_date", nothing.cast("date"), nothing.cast("decimal(12,2)")),
        store.read("warehouse.dim_product").select(
            F.lit("product"), "product_id", nothing.cast("string"), nothing.cast("string"), "effective_from",
            "effective_to", F.col("current_price").cast("decimal(12,2)")),
        store.read("warehouse.dim_product_history").select(
            F.lit("version"), "product_id", nothing.cast("string"), nothing.cast("string"), "effective_from",
            "effective_to", F.col("current_price").cast("decimal(12,2)")),
        store.read("warehouse.dim_user").select(
            F.lit("user"), "user_id", nothing.cast("string"), nothing.cast("string"), nothing.cast("date"),
            nothing.cast("date"), nothing.cast("decimal(12,2)")),
    ]
    return reduce(DataFrame.union, parts)


@query
def backfill_days(t: DriverTables) -> DataFrame:
    """Thirty landed days loaded in one plan; the day that fails its checks is left out."""
    root = scratch_dir(t.spark, "january")
    _land_january(t, root)
    store = TableStore(t.spark, f"{root}/tables", buckets=16)
    everything = (1, 2**62)
    backfill.backfill_days(store, root, *JANUARY, as_of=dt.datetime(2024, 2, 1), orders_range=everything,
                           events_range=everything, scratch=f"{root}/scratch")
    return _loaded_rows(store)


# ---- analytics -------------------------------------------------------------------------


@query
def revenue_by_date(t: DriverTables) -> DataFrame:
    return revenue.revenue_by_date(t, ORDERS_AS_OF)


@query
def revenue_by_category(t: DriverTables) -> DataFrame:
    return revenue.revenue_by_category(t, "2000-12-31")


@query
def revenue_by_brand(t: DriverTables) -> DataFrame:
    return revenue.revenue_by_brand(t, ORDERS_AS_OF)


@query
def category_revenue_simple(t: DriverTables) -> DataFrame:
    return revenue.category_revenue_simple(t)


@query
def category_revenue_recent(t: DriverTables) -> DataFrame:
    return revenue.category_revenue_simple(t, ORDERS_AS_OF, 30)


@query
def daily_sales_summary(t: DriverTables) -> DataFrame:
    return revenue.daily_sales_summary(t)


@query
def daily_revenue_trend(t: DriverTables) -> DataFrame:
    return revenue.daily_revenue_trend(t, ORDERS_AS_OF)


@query
def orders_by_weekday(t: DriverTables) -> DataFrame:
    return revenue.orders_by_weekday(t)


@query
def revenue_by_grain(t: DriverTables) -> DataFrame:
    parts = []
    for grain, keys in revenue.GRAINS.items():
        rows = revenue.revenue_by_grain(t, grain)
        period = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
        parts.append(rows.select(F.lit(grain).alias("grain"), period.alias("period"), "order_count", "revenue"))
    return reduce(DataFrame.unionByName, parts)


@query
def orders_between_date_ids(t: DriverTables) -> DataFrame:
    return revenue.orders_between_date_ids(t, 19970101, 19991231)


@query
def wow_growth(t: DriverTables) -> DataFrame:
    return revenue.week_over_week(t, "2000-12-31")


@query
def wow_growth_iso(t: DriverTables) -> DataFrame:
    return revenue.week_over_week(t, "1998-06-30", iso_year=True)


@query
def day_of_week_seasonality(t: DriverTables) -> DataFrame:
    return revenue.day_of_week_seasonality(t, ORDERS_AS_OF)


@query
def top_customers(t: DriverTables) -> DataFrame:
    return customers.top_customers(t)


@query
def repeat_customers(t: DriverTables) -> DataFrame:
    return customers.repeat_customers(t)


def _lifetime_facts(t: DriverTables, days: list[dt.date]) -> DataFrame:
    """Facts of some of eight weeks of load days; a third of the orders come a second time on another day.

    Orders that these days do not load are filtered out before anything else, and the others evaluated once.
    """
    number = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("int")

    def day(shift: int) -> Column:
        return F.date_add(F.lit(JANUARY[0]).cast("date"), F.pmod(number + shift, F.lit(56)))

    once, again = day(0).isin(days), (number % 3 == 0) & day(17).isin(days)
    loads = F.array_compact(F.array(F.when(once, day(0)), F.when(again, day(17))))
    rows = t.fact_orders.filter(once | again).withColumn("load_date", F.explode(loads))
    return rows.withColumn("date_id", exprs.date_key(F.col("load_date")))


def _lifetime_warehouse(t: DriverTables) -> StoredWarehouse:
    """Facts stored over eight weeks of load days; the days are then refreshed in two halves."""
    store = TableStore(t.spark, scratch_dir(t.spark, "lifetime"), buckets=16)
    first, days = dt.date.fromisoformat(JANUARY[0]), [dt.timedelta(days=n) for n in range(56)]
    for half in ([first + d for d in days[:30]], [first + d for d in days[30:]]):
        store.reload_days("warehouse.fact_orders", _lifetime_facts(t, half), half)
        lifetime.refresh(store, half)
    # dim_user is read from the shared tables.
    warehouse = StoredWarehouse(store)
    warehouse.dim_user = t.dim_user
    return warehouse


@query
def lifetime_top_customers(t: DriverTables) -> DataFrame:
    return customers.top_customers(_lifetime_warehouse(t))


@query
def lifetime_marketing_source(t: DriverTables) -> DataFrame:
    return customers.marketing_source_performance(_lifetime_warehouse(t))


@query
def tenure_segments(t: DriverTables) -> DataFrame:
    return customers.tenure_segments(t, TENURE_AS_OF)


@query
def tenure_segments_simple(t: DriverTables) -> DataFrame:
    return customers.tenure_segments_simple(t, TENURE_AS_OF)


@query
def marketing_source_performance(t: DriverTables) -> DataFrame:
    return customers.marketing_source_performance(t)


@query
def users_by_marketing_source(t: DriverTables) -> DataFrame:
    return customers.users_by_marketing_source(t)


@query
def product_performance(t: DriverTables) -> DataFrame:
    return products.product_performance(t, ORDERS_AS_OF)


@query
def top_products_by_category(t: DriverTables) -> DataFrame:
    return products.top_products_by_category(t, ORDERS_AS_OF)


@query
def top_products_by_revenue(t: DriverTables) -> DataFrame:
    return products.top_products_by_revenue(t)


@query
def top_products_recent(t: DriverTables) -> DataFrame:
    return products.top_products_recent(t, ORDERS_AS_OF)


def _stored_catalogue(t: DriverTables) -> DataFrame:
    """The product dimension of a stored warehouse, loaded from catalogue documents with stock and discount."""
    store = TableStore(t.spark, scratch_dir(t.spark, "catalogue"))
    document = F.to_json(F.struct(*staging.PRODUCT_FIELDS))
    raw = t.stocked_products.withColumn("brand", F.lit("any")).select(
        _seen().alias("fetched_at"), document.alias("raw_json"), F.lit(ORDERS_AS_OF).cast("date").alias("run_date"))
    store.append("raw.products_json", raw)
    staged = staging.stage_products(store.read("raw.products_json"), ORDERS_AS_OF, loaded_at=_seen())
    store.reload_day("staging.products_clean", staged.good, ORDERS_AS_OF)
    table = "warehouse.dim_product"
    store.write_snapshot(table, dimensions.load_dim_product(
        store.read(table), store.read("staging.products_clean"), ORDERS_AS_OF, _seen()))
    return StoredWarehouse(store).dim_product


@query
def low_stock(t: DriverTables) -> DataFrame:
    return products.low_stock(_stored_catalogue(t))


@query
def avg_discount_by_category(t: DriverTables) -> DataFrame:
    return products.avg_discount_by_category(_stored_catalogue(t))


@query
def discount_revenue_loss(t: DriverTables) -> DataFrame:
    return products.discount_revenue_loss(_stored_catalogue(t))


@query
def event_funnel(t: DriverTables) -> DataFrame:
    return funnel.event_funnel(t, EVENTS_AS_OF)


@query
def event_funnel_3stage(t: DriverTables) -> DataFrame:
    return funnel.event_funnel_3stage(t, EVENTS_AS_OF)


@query
def product_conversion(t: DriverTables) -> DataFrame:
    return funnel.product_conversion(t, EVENTS_AS_OF)


@query
def event_counts(t: DriverTables) -> DataFrame:
    return funnel.event_counts(t)


@query
def late_events_by_lag(t: DriverTables) -> DataFrame:
    return funnel.late_events_by_lag(t.late_events)


# ---- health ----------------------------------------------------------------------------


@query
def metrics_dashboard(t: DriverTables) -> DataFrame:
    return health.metrics_dashboard(t.metrics(), ORDERS_AS_OF)


@query
def pipeline_health(t: DriverTables) -> DataFrame:
    return health.pipeline_health(t.metrics())


@query
def ops_latest_metrics(t: DriverTables) -> DataFrame:
    return health.latest_metrics(t.metrics())


@query
def ops_recent_failures(t: DriverTables) -> DataFrame:
    return health.recent_failures(t.dq_failures(), ORDERS_AS_OF)


@query
def ops_alerts(t: DriverTables) -> DataFrame:
    return health.alerts(t.metrics(), ORDERS_AS_OF, days=30, seconds=6000, failures=2)


@query
def dq_failure_trend(t: DriverTables) -> DataFrame:
    return health.failure_trend(t.dq_failures(), ORDERS_AS_OF)


@query
def bad_records_audit(t: DriverTables) -> DataFrame:
    return health.bad_records_audit(t.bad_records(), ORDERS_AS_OF, days=3000)


@query
def lineage_orders(t: DriverTables) -> DataFrame:
    return health.lineage(t.raw_orders(), t.staged_orders, t.checked_fact_orders()).drop("file_name")


@query
def change_tracking(t: DriverTables) -> DataFrame:
    raw = t.order_lines.select(F.col("l_shipdate").alias("ingested_at"))
    return health.change_tracking(t.staged_orders, raw)


@query
def distinct_product_names(t: DriverTables) -> DataFrame:
    return health.distinct_product_names(_raw_products(t))


# ---- streaming -------------------------------------------------------------------------


@query
def stream_ingest_events(t: DriverTables) -> DataFrame:
    """Land event CSV files and stream them into the raw table."""
    root = scratch_dir(t.spark, "stream")
    _event_text(t).write.csv(f"{root}/landing", header=True)
    store = TableStore(t.spark, f"{root}/tables")
    ingest.ingest_to_table(ingest.event_stream(t.spark, f"{root}/landing"), store, "raw.events_csv",
                           f"{root}/checkpoint").awaitTermination()
    return store.read("raw.events_csv").select("raw_line", *EVENT_FIELDS)


@query
def stream_dedup_events(t: DriverTables) -> DataFrame:
    """Stream every event, then every event again in capitals: the first deliveries stay."""
    root = scratch_dir(t.spark, "stream")
    text = _event_text(t)
    store = TableStore(t.spark, f"{root}/tables")
    for copy in (text, text.withColumn("event_type", F.upper("event_type"))):
        copy.write.mode("append").csv(f"{root}/landing", header=True)
        once = ingest.first_deliveries(ingest.event_stream(t.spark, f"{root}/landing"), delay="10000 days")
        ingest.ingest_to_table(once, store, "raw.events_csv", f"{root}/checkpoint").awaitTermination()
    return store.read("raw.events_csv").select(*EVENT_FIELDS)


@query
def stream_late_recovery(t: DriverTables) -> DataFrame:
    """Stream a month of events in three polls under a delay of a day, then what was held back and
    copies of old ones; the daily load recovers what came too late."""
    root = scratch_dir(t.spark, "stream")
    store = TableStore(t.spark, f"{root}/tables")
    text = _event_text(t)
    day, number = F.dayofmonth(F.col("event_ts").cast("timestamp_ntz")), F.col("event_id").cast("bigint")
    held = number % 10 == 0
    polls = [text.filter(~held & (day > low) & (day <= high)) for low, high in ((0, 10), (10, 20), (20, 31))]
    polls[1] = polls[1].unionByName(polls[1].filter(number % 3 == 0))  # repeated within the delay
    polls.append(text.filter(held | ((number % 7 == 0) & (day <= 5))))
    for rows in polls:
        rows.write.mode("append").csv(f"{root}/landing", header=True)
        events = ingest.event_stream(t.spark, f"{root}/landing").withColumn("run_date", F.lit(EVENTS_AS_OF).cast("date"))
        late.ingest_once(events, store, root)
    late.recover_late(store, EVENTS_AS_OF)
    return staging.stage_events(store.read("raw.events_csv"), EVENTS_AS_OF).good.drop("created_at", "updated_at")


@query
def stream_upsert_orders(t: DriverTables) -> DataFrame:
    """Stream order documents and keep staging current through micro-batches."""
    root = scratch_dir(t.spark, "stream")
    doc = t.order_document(ingested=F.date_format("l_shipdate", "yyyy-MM-dd"), supplier=F.col("l_suppkey"))
    t.order_lines.select(doc).write.text(f"{root}/landing", compression=LANDED)
    store = TableStore(t.spark, f"{root}/tables")
    raw = ingest.order_stream(t.spark, f"{root}/landing")
    # The documents carry their own ingest date, so the latest copy is that of the batch
    # path; all of them arrive on one day.
    raw = raw.withColumn("ingested_at", F.get_json_object("raw_json", "$.ingested").cast("timestamp_ntz")) \
        .withColumn("run_date", F.lit(ORDERS_AS_OF).cast("date"))
    ingest.keep_orders_current(
        raw, store, f"{root}/checkpoint", tiebreak=_document_ties(), loaded_at=_seen()).awaitTermination()
    return store.read("staging.orders_clean").drop("created_at", "updated_at")


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Rows written to a folder and read from there, so that they are gathered once for several uses."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _document_ties() -> list[Column]:
    return [F.col("doc_product_id").cast("bigint").desc(),
            F.get_json_object("raw_json", "$.supplier").cast("bigint").desc(),
            F.col("doc_quantity").cast("int").desc(), F.col("doc_price").try_cast("decimal(26,12)").desc()]


@query
def stream_then_batch_orders(t: DriverTables) -> DataFrame:
    """Stream a quarter of the lines over several micro-batches, append half in batch and
    stage, then stream the rest: staging covers what all of them delivered."""
    root = scratch_dir(t.spark, "stream")
    doc = t.order_document(ingested=F.date_format("l_shipdate", "yyyy-MM-dd"), supplier=F.col("l_suppkey"))
    number = F.xxhash64("order_id", "l_suppkey", "l_shipdate")
    share, half = F.pmod(number, F.lit(4)), F.pmod(F.shiftright(number, 2), F.lit(2))
    lines = t.order_lines.select(doc.alias("value"), share.alias("share"), half.alias("half"))
    store = TableStore(t.spark, f"{root}/tables")

    def delivered(raw: DataFrame) -> DataFrame:
        return raw.withColumn("ingested_at", F.get_json_object("raw_json", "$.ingested").cast("timestamp_ntz")) \
            .withColumn("run_date", F.lit(ORDERS_AS_OF).cast("date"))

    def land_and_poll(number: int) -> None:
        # Every task lands a file for each half; a micro-batch takes half of the files.
        landing_folder = f"{root}/landing/{number}"
        lines.filter(F.col("share") == number).select("value", "half").write.partitionBy("half").text(landing_folder, compression=LANDED)
        files = len(t.spark.read.text(landing_folder).inputFiles())
        ingest.keep_orders_current(
            delivered(ingest.order_stream(t.spark, f"{root}/landing/*/*", max_files=max(1, -(-files // 2)))), store, f"{root}/checkpoint",
            tiebreak=_document_ties(), loaded_at=_seen()).awaitTermination()

    land_and_poll(0)
    lines.filter("share >= 2").select("value").write.text(f"{root}/batch", compression=LANDED)
    store.append("raw.orders_json", delivered(landing.read_orders(t.spark, f"{root}/batch", ORDERS_AS_OF)))
    staged = staging.stage_orders(store.read("raw.orders_json"), ORDERS_AS_OF, tiebreak=_document_ties(), loaded_at=_seen())
    store.reload_day("staging.orders_clean", staged.good, ORDERS_AS_OF)
    land_and_poll(1)
    return store.read("staging.orders_clean").drop("created_at", "updated_at")


@query
def stream_to_facts(t: DriverTables) -> DataFrame:
    """Stream every order line as pending, merge corrections of a third in batch, stream those of the rest.

    The facts follow by key.  Corrections are of a later day, so that they also move between
    the fact table's folders.
    """
    root = scratch_dir(t.spark, "stream")
    store = TableStore(t.spark, f"{root}/tables", buckets=16)
    listed = t.listed_products.withColumn("load_date", F.lit(JANUARY[0]).cast("date"))
    store.merge("warehouse.dim_product", listed, lambda current: dimensions.load_dim_product(current, listed, loaded_at=_seen()))
    day = F.date_add(F.lit(JANUARY[0]).cast("date"), (F.col("l_orderkey") % 5).cast("int"))
    # The lines land three times, so they are gathered once.
    lines = _stored(t.latest_lines.withColumn("day", day).select(
        "order_id", "user_id", "product_id", "quantity", "l_extendedprice", "o_orderdate", "status", "day"), f"{root}/lines")

    def documents_of(rows: DataFrame, hour: int, status: Column, days: int) -> DataFrame:
        doc = t.order_document(status=status, day=F.col("day").cast("string"), hour=F.lit(hour),
                               timestamp=F.concat(F.date_add("day", days).cast("string"), F.lit("T12:00:00")))
        return rows.select(doc.alias("value"))

    def delivered(raw: DataFrame) -> DataFrame:
        """Raw rows with the load day and the hour of arrival that the documents name."""
        named = raw.select("*", F.json_tuple("raw_json", "hour", "day").alias("_hour", "_day"))
        hour = F.col("_hour").cast("int")
        return named.withColumn("ingested_at", F.timestamp_add("HOUR", hour, F.lit(JANUARY[0]).cast("timestamp_ntz"))) \
            .withColumn("run_date", F.col("_day").cast("date")).drop("_hour", "_day")

    def poll() -> None:
        increments.keep_facts_current(
            delivered(ingest.order_stream(t.spark, f"{root}/landing")), store, f"{root}/checkpoint", loaded_at=_seen(),
            scratch=f"{root}/scratch").awaitTermination()

    documents_of(lines, 1, F.lit("pending"), 0).write.text(f"{root}/landing", compression=LANDED)
    poll()
    third = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    documents_of(lines.filter(third), 3, F.col("status"), 1).write.text(f"{root}/batch", compression=LANDED)
    store.append("raw.orders_json", delivered(landing.read_orders(t.spark, f"{root}/batch", JANUARY[0])))
    documents_of(lines.filter(~third), 2, F.col("status"), 1).write.mode("append").text(f"{root}/landing", compression=LANDED)
    poll()
    return store.read("warehouse.fact_orders")


@query
def stream_then_batch_events(t: DriverTables) -> DataFrame:
    """Stream half of the events, append the other half in batch: readers see both."""
    root = scratch_dir(t.spark, "stream")
    text = _event_text(t)
    odd = F.col("event_id").cast("bigint") % 2 == 1
    text.filter(odd).write.csv(f"{root}/landing", header=True)
    text.filter(~odd).write.csv(f"{root}/batch", header=True)
    store = TableStore(t.spark, f"{root}/tables")
    ingest.ingest_to_table(ingest.event_stream(t.spark, f"{root}/landing", max_files=2), store, "raw.events_csv",
                           f"{root}/checkpoint").awaitTermination()
    store.append("raw.events_csv", landing.read_events(t.spark, f"{root}/batch", EVENTS_AS_OF))
    return store.read("raw.events_csv").select("raw_line", *EVENT_FIELDS)
