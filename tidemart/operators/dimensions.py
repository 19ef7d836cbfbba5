"""Dimension builders: calendar, users, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import date_key, day_column
from tidemart.functions.exprs import DateLike
from tidemart.operators.merge import insert_absent, merge_history, merge_snapshots, upsert
from tidemart.operators.staging import slice_of

USER_ATTRIBUTES = ["city", "signup_date", "marketing_source"]
PRODUCT_ATTRIBUTES = ["product_name", "category", "brand", "current_price"]
# Kept where both the catalogue and the table have them.
PRODUCT_EXTRAS = ["stock", "discount_percentage"]


def product_attributes(*frames: DataFrame) -> list[str]:
    """The product columns that all ``frames`` carry."""
    return PRODUCT_ATTRIBUTES + [c for c in PRODUCT_EXTRAS if all(c in f.columns for f in frames)]


def date_attributes(day: Column) -> list[Column]:
    """The calendar columns of a date; weeks are ISO weeks, Sunday is day 0."""
    weekday = F.dayofweek(day) - 1
    return [
        date_key(day).alias("date_id"),
        day.alias("date"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]


def build_dim_date(spark: SparkSession, start: DateLike, stop: DateLike) -> DataFrame:
    """One row per day from ``start`` to ``stop``, both included."""
    span = F.sequence(day_column(start), day_column(stop), F.expr("interval 1 day"))
    days = spark.range(1).select(F.explode(span).alias("d"))
    return days.select(*date_attributes(F.col("d")))


def seed_dim_date(spark: SparkSession, as_of: DateLike = None) -> DataFrame:
    """The calendar from one year before ``as_of`` to two years after it."""
    day = day_column(as_of)
    return build_dim_date(spark, F.add_months(day, -12), F.add_months(day, 24))


def load_dim_date(dim_date: DataFrame, run_date: DateLike, *times: DataFrame, seed: bool = False) -> DataFrame:
    """The calendar with ``run_date`` added if it was missing.

    ``times`` are frames of one timestamp column: their days are added too, so that rows
    which arrive late find theirs.  ``seed`` adds a year before and two years after.
    """
    spark = dim_date.sparkSession
    days = seed_dim_date(spark, run_date) if seed else build_dim_date(spark, run_date, run_date)
    for frame in times:
        day = F.col(frame.columns[0]).cast("date")
        found = frame.select(day.alias("d")).filter(F.col("d").isNotNull()).distinct()
        days = days.unionByName(found.select(*date_attributes(F.col("d"))))
    return insert_absent(dim_date, days.dropDuplicates(["date_id"]), ["date_id"])


def users_of_day(orders: DataFrame, run_date: DateLike = None) -> DataFrame:
    """The distinct users of a day's staged orders (or of all days)."""
    return slice_of(orders, run_date, "load_date").filter(F.col("user_id").isNotNull()) \
        .select("user_id").distinct()


def load_dim_user(dim_user: DataFrame, orders: DataFrame, run_date: DateLike = None,
                  attributes: DataFrame | None = None, loaded_at: Column | None = None) -> DataFrame:
    """The user dimension with the day's buyers merged in.

    ``attributes`` (user_id, city, signup_date, marketing_source) fills what orders do
    not carry; users it does not list keep what they have, new ones start with none.
    """
    stamp = (F.current_timestamp() if loaded_at is None else loaded_at).cast("timestamp_ntz")
    users = users_of_day(orders, run_date)
    incoming = users.withColumn("created_at", stamp).withColumn("updated_at", stamp)
    merged = upsert(dim_user, incoming, ["user_id"], keep=["created_at"])
    if attributes is None:
        return merged
    known = attributes.withColumn("_known", F.lit(True)).alias("a")
    joined = merged.alias("m").join(known, "user_id", "left")
    filled = [
        F.when(F.col("_known"), F.col(f"a.{c}")).otherwise(F.col(f"m.{c}")).alias(c)
        if c in USER_ATTRIBUTES and c in attributes.columns
        else (F.col(c) if c == "user_id" else F.col(f"m.{c}"))
        for c in dim_user.columns
    ]
    return joined.select(*filled)


def load_dim_product(dim_product: DataFrame, products: DataFrame, run_date: DateLike = None,
                     loaded_at: Column | None = None) -> DataFrame:
    """The product dimension with a day's staged products merged in (current values only).

    ``effective_from`` stays at the first insert, ``effective_to`` stays empty.
    """
    stamp = (F.current_timestamp() if loaded_at is None else loaded_at).cast("timestamp_ntz")
    day = slice_of(products, run_date, "load_date").filter(F.col("product_id").isNotNull())
    incoming = day.select(
        "product_id", *product_attributes(dim_product, products),
        F.col("load_date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
    )
    return upsert(dim_product, incoming, ["product_id"],
                  keep=["effective_from", "effective_to", "created_at"])


def catalogue_of(products: DataFrame) -> DataFrame:
    """Many days' staged products as one catalogue: the latest values, ``load_date`` the first day seen.

    Merged by ``load_dim_product``, it leaves what the days would leave one after the other.
    """
    values = [c for c in products.columns if c not in ("product_id", "load_date")]
    latest = products.groupBy("product_id").agg(
        F.max_by(F.struct(*values), "load_date").alias("_v"), F.min("load_date").alias("load_date"))
    return latest.select("product_id", "_v.*", "load_date")


def first_days(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys that ``dim`` does not have yet and the day that brings them: (key, known_from)."""
    days = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("load_date").alias("known_from"))
    return days.join(dim.select(key), key, "left_anti")


def since(dim: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The keys of ``dim`` with the day from which a load could see them; old ones from the beginning."""
    always = F.lit("0001-01-01").cast("date")
    return dim.select(key).join(fresh, key, "left").select(key, F.coalesce("known_from", always).alias("known_from"))


def load_product_history(history: DataFrame, products: DataFrame, run_date: DateLike) -> DataFrame:
    """The versioned product dimension with a day's staged products merged in."""
    day = slice_of(products, run_date, "load_date")
    return merge_history(history, day, ["product_id"], product_attributes(history, products), run_date)


def load_product_snapshots(history: DataFrame, products: DataFrame) -> DataFrame:
    """The versioned product dimension with many days' staged products merged in."""
    return merge_snapshots(history, products, ["product_id"], product_attributes(history, products))
