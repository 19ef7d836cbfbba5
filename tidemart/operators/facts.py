"""Fact loads: staged rows whose keys exist in the dimensions, and the rows that miss one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import date_key
from tidemart.functions.exprs import DateLike
from tidemart.operators.staging import slice_of
from tidemart.schemas import CONTRACTS


def calendar(dim_date: DataFrame, *columns: str) -> DataFrame:
    """Calendar columns marked for broadcast: one row per day, so the size is bounded
    by the length of the calendar whatever the fact tables grow to."""
    return F.broadcast(dim_date.select(*columns))


def _keyed_orders(orders: DataFrame, run_date: DateLike) -> DataFrame:
    return slice_of(orders, run_date, "load_date").withColumn("date_id", date_key(F.col("order_ts")))


def _keyed_events(events: DataFrame, run_date: DateLike) -> DataFrame:
    return slice_of(events, run_date, "load_date").withColumn("date_id", date_key(F.col("event_ts")))


def known(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` the dimension has; with a ``known_from`` day, has on the day of their load.

    Semi-joined without a hint: Spark broadcasts the key column when it is measured to be
    small and otherwise shuffles, splitting skewed partitions.
    """
    if "known_from" not in dim.columns:
        return rows.join(dim.select(key), key, "left_semi")
    d = dim.select(F.col(key).alias("_key"), "known_from")
    return rows.join(d, (rows[key] == d["_key"]) & (rows["load_date"] >= d["known_from"]), "left_semi")


def load_fact_orders(orders: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                     dim_user: DataFrame, run_date: DateLike = None) -> DataFrame:
    """Staged orders whose date, product and user are all known (``known``)."""
    rows = _keyed_orders(orders, run_date).join(calendar(dim_date, "date_id"), "date_id", "left_semi")
    rows = known(known(rows, dim_product, "product_id"), dim_user, "user_id")
    return rows.select(*CONTRACTS["warehouse.fact_orders"].column_names)


def dimension_keys(dim: DataFrame, key: str) -> DataFrame:
    """Each key of a dimension with the day it is known from (if any) and how often it is there."""
    since = "MIN(known_from)" if "known_from" in dim.columns else "CAST(NULL AS DATE)"
    return dim.groupBy(key).agg(F.expr(since).alias("_since"), F.count(F.lit(1)).cast("int").alias(f"_n_{key}"))


def check_orders(orders: DataFrame, dates: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """Staged orders, each with the keys that no dimension has (``_missing``).

    ``passed_orders`` and ``rejected_orders`` of it are what ``load_fact_orders`` and
    ``reject_fact_orders`` give: written once, it meets the dimensions once for both.
    The dimensions come as ``dimension_keys``.  Those of products and users are best
    stored: AQE splits a hot key only where it joins what was shuffled, not aggregated.
    """
    rows = _keyed_orders(orders, None)
    kept = [c for c in rows.columns if c not in ("created_at", "updated_at")]
    flagged, found = rows.select(*kept), ("date_id", "product_id", "user_id")
    for keys, key in zip((F.broadcast(dates), products, users), found, strict=True):
        flagged = flagged.join(keys, key, "left")
        early = F.coalesce(F.col("load_date") < F.col("_since"), F.lit(False))
        flagged = flagged.withColumn(f"_has_{key}", F.col(f"_n_{key}").isNotNull() & ~early).drop("_since")
    # A key that came twice rejects a row twice, as a join with it does.
    missing = F.array_compact(F.array(*[
        F.when(~F.col(f"_has_{key}"), F.struct(
            F.lit(f"{key} not in dimension").alias("reason"), F.col(key).cast("string").alias("value")))
        for key in found]))
    times = reduce(lambda a, b: a * b, [F.coalesce(F.col(f"_n_{key}"), F.lit(1)) for key in found])
    repeated = F.when(times > 1, F.flatten(F.array_repeat(missing, times))).otherwise(missing)
    return flagged.select(*kept, repeated.alias("_missing"))


def passed_orders(checked: DataFrame) -> DataFrame:
    """The fact rows among ``check_orders``."""
    return checked.filter(F.size("_missing") == 0).select(*CONTRACTS["warehouse.fact_orders"].column_names)


def rejected_orders(checked: DataFrame) -> DataFrame:
    """The others, one row per missing key."""
    columns = [c for c in checked.columns if c != "_missing"]
    return checked.withColumn("_p", F.explode("_missing")).select(*_reject_columns(columns, "staging.orders_clean", "order_id"))


def _reject_columns(columns: list[str], source: str, record_id: str) -> list[Column]:
    return [
        F.lit(source).alias("source_table"),
        F.col(record_id).alias("record_id"),
        F.col("_p.reason").alias("failure_reason"),
        F.col("_p.value").alias("failed_value"),
        F.to_json(F.struct(*[c for c in columns if c not in ("created_at", "updated_at")])).alias("raw_data"),
        F.col("load_date").alias("run_date"),
    ]


def load_fact_events(events: DataFrame, dim_date: DataFrame, dim_user: DataFrame,
                     run_date: DateLike = None) -> DataFrame:
    """Staged events whose date and user are known; the product may be unknown or absent."""
    rows = _keyed_events(events, run_date).join(calendar(dim_date, "date_id"), "date_id", "left_semi")
    rows = known(rows, dim_user, "user_id")
    return rows.select(*CONTRACTS["warehouse.fact_events"].column_names)


def _misses(rows: DataFrame, dims: list[tuple[DataFrame, str]], source: str, record_id: str) -> DataFrame:
    """One bad-record row per missing dimension key, in one chain of flag joins.

    Each dimension contributes its (unique) key with a flag through a left join, so the
    fact rows are read once however many dimensions are checked.  A key that a dimension
    knows from a later day on (``known_from``) is missing before it.
    """
    flagged = rows
    for dim, key in dims:
        since = "known_from" if "known_from" in dim.columns else "DATE '0001-01-01'"
        flagged = flagged.join(dim.select(key, F.expr(since).alias("_since")), key, "left") \
            .withColumn(f"_has_{key}", F.when(F.col("load_date") >= F.col("_since"), True)).drop("_since")
    missing = F.array_compact(F.array(*[
        F.when(
            F.col(f"_has_{key}").isNull(),
            F.struct(F.lit(f"{key} not in dimension").alias("reason"),
                     F.col(key).cast("string").alias("value")),
        )
        for _, key in dims
    ]))
    return flagged.withColumn("_p", F.explode(missing)).select(*_reject_columns(rows.columns, source, record_id))


def _keys(dim: DataFrame, key: str) -> DataFrame:
    return dim.select(key, *[c for c in dim.columns if c == "known_from"])


def reject_fact_orders(orders: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                       dim_user: DataFrame, run_date: DateLike = None) -> DataFrame:
    """What ``load_fact_orders`` leaves out, one row per missing key."""
    dims = [
        (calendar(dim_date, "date_id"), "date_id"),
        (_keys(dim_product, "product_id"), "product_id"),
        (_keys(dim_user, "user_id"), "user_id"),
    ]
    return _misses(_keyed_orders(orders, run_date), dims, "staging.orders_clean", "order_id")


def reject_fact_events(events: DataFrame, dim_date: DataFrame, dim_user: DataFrame,
                       run_date: DateLike = None) -> DataFrame:
    """What ``load_fact_events`` leaves out, one row per missing key."""
    dims = [(calendar(dim_date, "date_id"), "date_id"), (_keys(dim_user, "user_id"), "user_id")]
    return _misses(_keyed_events(events, run_date), dims, "staging.events_clean", "event_id")


def orders_summary_parts(fact_orders: DataFrame, run_date: DateLike = None) -> DataFrame:
    """Orders, revenue and units per event day *and* load day.

    All three measures add up, so a summary kept per load day is refreshed by replacing
    that load day alone; a rerun or an emptied day needs no look at other days.
    """
    rows = slice_of(fact_orders, run_date, "load_date")
    return rows.groupBy("date_id", "load_date").agg(
        F.count("*").alias("order_count"),
        F.sum("revenue").alias("daily_revenue"),
        F.sum("quantity").alias("units_sold"),
    )


def daily_orders_summary(parts: DataFrame) -> DataFrame:
    """Orders, revenue and units per event day, from the per-load-day parts."""
    return parts.groupBy("date_id").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("daily_revenue").alias("daily_revenue"),
        F.sum("units_sold").alias("units_sold"),
    )


def revenue_parts(fact_orders: DataFrame, run_date: DateLike = None) -> DataFrame:
    """Revenue per order date and load day."""
    rows = slice_of(fact_orders, run_date, "load_date")
    return rows.groupBy(F.to_date("order_ts").alias("order_date"), "load_date").agg(
        F.sum("revenue").alias("daily_revenue")
    )


def daily_revenue(parts: DataFrame) -> DataFrame:
    """Revenue per order date, from the per-load-day parts."""
    return parts.groupBy("order_date").agg(F.sum("daily_revenue").alias("daily_revenue"))
