"""Nested cart and catalogue documents -> orders, products and events.

Item ids are read from ``productId`` or ``id``, whichever a document carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_column
from tidemart.functions.exprs import DateLike

CART_SCHEMA = (
    "id STRING, userId STRING, date STRING, total DOUBLE, discountedTotal DOUBLE, totalProducts BIGINT, "
    "totalQuantity BIGINT, products ARRAY<STRUCT<productId: STRING, id: STRING, title: STRING, "
    "price: STRING, quantity: BIGINT, total: DOUBLE>>"
)
CATALOG_SCHEMA = (
    "id STRING, title STRING, category STRING, brand STRING, description STRING, price DOUBLE, "
    "stock BIGINT, discountPercentage DOUBLE, rating STRUCT<rate: DOUBLE, count: BIGINT>"
)

# What a document gets when it leaves a field out.
DEFAULT_USER = "unknown"
DEFAULT_CATEGORY = "uncategorized"
DEFAULT_BRAND = "Fake Store"
CART_STATUS = "completed"


def parse_documents(raw: DataFrame, schema: str, column: str = "raw_json") -> DataFrame:
    """Type a JSON text column with an explicit schema, one pass over the text."""
    return raw.select(F.from_json(column, schema).alias("doc")).select("doc.*")


def carts_to_orders(carts: DataFrame, placed_at: Column | None = None) -> DataFrame:
    """One order document per cart, its item list kept as it is."""
    stamp = F.current_timestamp() if placed_at is None else placed_at
    return carts.select(
        F.concat(F.lit("CART_"), F.col("id").cast("string")).alias("order_id"),
        F.coalesce(F.col("userId").cast("string"), F.lit(DEFAULT_USER)).alias("user_id"),
        "products",
        F.coalesce(F.col("total"), F.lit(0)).cast("double").alias("total"),
        F.coalesce(F.col("discountedTotal"), F.lit(0)).cast("double").alias("discounted_total"),
        F.coalesce(F.col("totalProducts"), F.lit(0)).cast("bigint").alias("total_products"),
        F.coalesce(F.col("totalQuantity"), F.lit(0)).cast("bigint").alias("total_quantity"),
        stamp.cast("timestamp_ntz").alias("timestamp"),
        F.lit(CART_STATUS).alias("status"),
    )


def item_id(item: Column) -> Column:
    return F.coalesce(item["productId"].cast("string"), item["id"].cast("string"))


def cart_order_lines(carts: DataFrame, placed_at: Column | None = None) -> DataFrame:
    """One flat order document per cart item, in the shape the staging layer types.

    A cart has no product, quantity or price of its own, so whole carts can never pass
    the order contract; their items can.
    """
    stamp = F.current_timestamp() if placed_at is None else placed_at
    items = carts.select("id", "userId", stamp.alias("_at"), F.posexplode("products").alias("n", "item"))
    return items.select(
        F.concat(F.lit("CART_"), F.col("id").cast("string"), F.lit("-"), F.col("n") + 1).alias("order_id"),
        F.coalesce(F.col("userId").cast("string"), F.lit(DEFAULT_USER)).alias("user_id"),
        item_id(F.col("item")).alias("product_id"),
        F.col("item.quantity").cast("string").alias("quantity"),
        F.col("item.price").cast("string").alias("price"),
        F.date_format(F.col("_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(CART_STATUS).alias("status"),
    )


def normalize_catalog(products: DataFrame) -> DataFrame:
    """Catalogue documents -> product documents, with stock and discount where present."""
    optional = [
        F.col(source).alias(target)
        for source, target in (("stock", "stock"), ("discountPercentage", "discount_percentage"))
        if source in products.columns
    ]
    return products.select(
        F.col("id").cast("string").alias("product_id"),
        F.col("title").alias("product_name"),
        F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(F.col("brand"), F.lit(DEFAULT_BRAND)).alias("brand"),
        "description",
        F.col("price").cast("double").alias("current_price"),
        F.coalesce(F.col("rating.rate"), F.lit(0)).cast("double").alias("rating"),
        F.coalesce(F.col("rating.count"), F.lit(0)).cast("bigint").alias("count"),
        *optional,
    )


def view_events(products: DataFrame, run_date: DateLike, seen_at: Column | None = None) -> DataFrame:
    """One ``view_product`` event per catalogue product.

    The event id is built from the product id, which is unique by itself; a running
    counter would force the whole catalogue through one task.
    """
    day = day_column(run_date).cast("string")
    stamp = F.current_timestamp() if seen_at is None else seen_at
    pid = F.col("id").cast("string")
    return products.select(
        F.concat(F.lit("EVT_"), day, F.lit("_view_"), pid).alias("event_id"),
        (F.col("id").cast("bigint") % 10 + 1).cast("string").alias("user_id"),
        pid.alias("product_id"),
        F.lit("view_product").alias("event_type"),
        stamp.cast("timestamp_ntz").alias("event_ts"),
    )


def cart_events(carts: DataFrame, run_date: DateLike) -> DataFrame:
    """One ``add_to_cart`` event per cart item, numbered within its cart."""
    day = day_column(run_date).cast("string")
    items = carts.select("id", "userId", "date", F.posexplode("products").alias("n", "item"))
    pid = item_id(F.col("item"))
    return items.select(
        F.concat(F.lit("EVT_"), day, F.lit("_addcart_"), pid, F.lit("_"), F.col("id").cast("string"),
                 F.lit("_"), F.col("n") + 1).alias("event_id"),
        F.col("userId").cast("string").alias("user_id"),
        pid.alias("product_id"),
        F.lit("add_to_cart").alias("event_type"),
        F.col("date").try_cast("timestamp_ntz").alias("event_ts"),
    )


def derived_events(products: DataFrame, carts: DataFrame, run_date: DateLike,
                   seen_at: Column | None = None) -> DataFrame:
    """Both event families as one stream of rows."""
    return view_events(products, run_date, seen_at).unionByName(cart_events(carts, run_date))


def to_raw_orders(orders: DataFrame, source_label: str, run_date: DateLike,
                  ingested_at: Column | None = None) -> DataFrame:
    """Order rows -> ``raw.orders_json`` rows."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return orders.select(
        F.lit(source_label).alias("file_name"),
        stamp.cast("timestamp_ntz").alias("ingested_at"),
        F.to_json(F.struct(*orders.columns)).alias("raw_json"),
        day_column(run_date).alias("run_date"),
    )


def to_raw_products(products: DataFrame, run_date: DateLike, fetched_at: Column | None = None) -> DataFrame:
    """Product rows -> ``raw.products_json`` rows."""
    stamp = F.current_timestamp() if fetched_at is None else fetched_at
    return products.select(
        stamp.cast("timestamp_ntz").alias("fetched_at"),
        F.to_json(F.struct(*products.columns)).alias("raw_json"),
        day_column(run_date).alias("run_date"),
    )


def to_raw_events(events: DataFrame, source_label: str, run_date: DateLike,
                  ingested_at: Column | None = None) -> DataFrame:
    """Event rows -> ``raw.events_csv`` rows, the document kept as the raw line."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return events.select(
        F.lit(source_label).alias("file_name"),
        stamp.cast("timestamp_ntz").alias("ingested_at"),
        F.to_json(F.struct(*events.columns)).alias("raw_line"),
        *events.columns,
        day_column(run_date).alias("run_date"),
    )
