"""Pipeline health: metrics, alerts, failures, bad records, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions import day_column, percent
from tidemart.functions.exprs import DateLike
from tidemart.operators.staging import document_fields, slice_of

# Status labels of the dashboard and thresholds of the alerts.
PASS_LABEL, FAIL_LABEL = "✓ PASS", "✗ FAIL"
SLOW_RUN_SECONDS = 5400
MANY_FAILURES = 100
FEW_RAW_ORDERS = 100


def _since(df: DataFrame, as_of: DateLike, days: int) -> DataFrame:
    return df.filter(F.col("run_date") >= F.date_sub(day_column(as_of), days))


def metrics_dashboard(metrics: DataFrame, as_of: DateLike = None, days: int = 30) -> DataFrame:
    """Recent runs with completion rates and a pass/fail label."""
    return _since(metrics, as_of, days).select(
        "run_date", "raw_orders_count", "staging_orders_count", "fact_orders_count",
        "raw_events_count", "staging_events_count", "fact_events_count", "dq_failed_count",
        "runtime_seconds",
        percent(F.col("fact_orders_count"), F.col("raw_orders_count")).alias("orders_completion_pct"),
        percent(F.col("fact_events_count"), F.col("raw_events_count")).alias("events_completion_pct"),
        F.when(F.col("dq_failed_count") == 0, PASS_LABEL).otherwise(FAIL_LABEL).alias("dq_status"),
    ).orderBy(F.desc("run_date"))


def pipeline_health(metrics: DataFrame, latest: int = 10) -> DataFrame:
    """The core counts of the latest runs."""
    return metrics.orderBy(F.desc("run_date")).limit(latest).select(
        "run_date", "raw_orders_count", "staging_orders_count", "fact_orders_count",
        "dq_failed_count", "runtime_seconds",
    )


def latest_metrics(metrics: DataFrame, latest: int = 1) -> DataFrame:
    """The latest metrics rows, all columns."""
    return metrics.orderBy(F.desc("run_date")).limit(latest)


def recent_failures(dq_failures: DataFrame, as_of: DateLike = None, days: int = 1) -> DataFrame:
    """The failures of the last days."""
    return _since(dq_failures, as_of, days)


def slow_runs(metrics: DataFrame, as_of: DateLike = None, days: int = 7,
              seconds: int = SLOW_RUN_SECONDS) -> DataFrame:
    """Recent runs that took too long."""
    return _since(metrics, as_of, days).filter(F.col("runtime_seconds") > seconds)


def failing_runs(metrics: DataFrame, failures: int = MANY_FAILURES, latest: int = 7) -> DataFrame:
    """The latest runs with too many failed checks."""
    return metrics.filter(F.col("dq_failed_count") > failures) \
        .orderBy(F.desc("run_date")).limit(latest).select("run_date", "dq_failed_count")


def thin_runs(metrics: DataFrame, as_of: DateLike = None, days: int = 7,
              orders: int = FEW_RAW_ORDERS) -> DataFrame:
    """Recent runs that received too few orders."""
    return _since(metrics, as_of, days).filter(F.col("raw_orders_count") < orders) \
        .select("run_date", "raw_orders_count")


def alerts(metrics: DataFrame, as_of: DateLike = None, days: int = 7, seconds: int = SLOW_RUN_SECONDS,
           failures: int = MANY_FAILURES, orders: int = FEW_RAW_ORDERS, latest: int = 7) -> DataFrame:
    """All alerts as (alert, run_date, value), from one pass over the metrics.

    Of the runs with many failures the ``latest`` are reported, whatever their day.  The
    window ranks the runs of each alert: one row per day at most.
    """
    recent = F.col("run_date") >= F.date_sub(day_column(as_of), days)

    def alert(name: str, condition: Column, value: str) -> Column:
        return F.when(condition, F.struct(
            F.lit(name).alias("alert"), F.col(value).cast("bigint").alias("value")))

    raised = F.array_compact(F.array(
        alert("slow_run", recent & (F.col("runtime_seconds") > seconds), "runtime_seconds"),
        alert("many_failures", F.col("dq_failed_count") > failures, "dq_failed_count"),
        alert("few_orders", recent & (F.col("raw_orders_count") < orders), "raw_orders_count"),
    ))
    rows = metrics.select("run_date", F.explode(raised).alias("a")).select("a.alert", "run_date", "a.value")
    rank = F.row_number().over(W.partitionBy("alert").orderBy(F.desc("run_date")))
    return rows.withColumn("_r", rank) \
        .filter((F.col("alert") != "many_failures") | (F.col("_r") <= latest)).drop("_r")


def failure_trend(dq_failures: DataFrame, as_of: DateLike = None, days: int = 90) -> DataFrame:
    """Failures per week and check with the distinct messages.

    Failures are kept once per check and day, so a (week, check) holds seven at most.
    """
    week = F.date_trunc("week", F.col("run_date")).cast("date")
    return _since(dq_failures, as_of, days).groupBy(week.alias("week_start"), "check_name", "check_type").agg(
        F.count("*").alias("failure_count"),
        F.sort_array(F.collect_set("failure_message")).alias("messages"),
    ).orderBy(F.desc("week_start"), F.desc("failure_count"), "check_name")


def bad_records_audit(bad_records: DataFrame, as_of: DateLike = None, days: int = 7, samples: int = 5) -> DataFrame:
    """Bad records per table and reason with the first few record ids.

    One bad source can hold most of the rows, so its ids are never gathered: rows are
    counted per id, every task keeps its lowest ids per reason (a group limit), and only
    those few are collected.

    Totals and ids use the same columns of the counts, a NULL id (last, and not collected)
    included, and are stacked: what differs between them, like the filters of a join, would
    keep Spark from evaluating the records once.
    """
    keys = ["source_table", "failure_reason"]
    per_id = _since(bad_records, as_of, days).groupBy(*keys, "record_id").agg(F.count("*").alias("n"))
    totals = per_id.groupBy(*keys).agg(F.sum("n").alias("bad_record_count"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.asc_nulls_last("record_id"), "n"))
    lowest = per_id.withColumn("_r", rank).filter(F.col("_r") <= samples).groupBy(*keys) \
        .agg(F.sort_array(F.collect_list("record_id")).alias("sample_ids"))
    both = totals.unionByName(lowest, allowMissingColumns=True).groupBy(*keys).agg(
        F.max("bad_record_count").alias("bad_record_count"), F.first("sample_ids", ignorenulls=True).alias("_ids"))
    # A record without a table or reason has no samples.
    named = F.when(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull(), F.col("_ids"))
    return both.select(
        *keys, "bad_record_count", F.coalesce(named, F.array().cast("array<string>")).alias("sample_ids")
    ).orderBy(F.desc("bad_record_count"), *keys)


def lineage(raw_orders: DataFrame, orders: DataFrame, fact_orders: DataFrame, run_date: DateLike = None) -> DataFrame:
    """Every raw order document with the staging and fact rows it led to.

    Staging and facts are joined first (one row per order and day on both sides), so the
    large raw side is shuffled once, as the outer side of one left join that AQE can
    split when one order id dominates.  A fact belongs to the load day of its document:
    an id that recurs on other days is not linked to their facts.
    """
    docs = document_fields(slice_of(raw_orders, run_date), ("order_id",)).select(
        "run_date", "file_name", "ingested_at", F.col("doc_order_id").alias("order_id"))
    staged = slice_of(orders, run_date, "load_date").select("order_id", F.col("load_date").alias("run_date"))
    facts = slice_of(fact_orders, run_date, "load_date").select(
        "order_id", F.col("load_date").alias("run_date"),
        F.col("order_id").alias("fact_order_id"), F.col("load_date").alias("fact_load_date"))
    loaded = staged.join(facts, ["run_date", "order_id"], "left").withColumn("staging_order_id", F.col("order_id"))
    return docs.join(loaded, ["run_date", "order_id"], "left").select(
        "run_date", "file_name", "ingested_at", "order_id", "staging_order_id", "fact_order_id", "fact_load_date")


def change_tracking(orders: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Staged orders with how many raw documents arrived on the day they were last updated.

    The raw side shrinks to one row per day before the join; that many rows are safe to
    broadcast, since a calendar bounds them.
    """
    per_day = raw_orders.groupBy(F.to_date("ingested_at").alias("_day")).agg(F.count("*").alias("_n"))
    return orders.withColumn("_day", F.to_date("updated_at")).join(F.broadcast(per_day), "_day", "left").select(
        "order_id", "created_at", "updated_at", F.coalesce("_n", F.lit(0)).alias("raw_records_that_day")
    ).orderBy(F.desc("updated_at"), "order_id")


def distinct_product_names(raw_products: DataFrame, limit: int | None = None) -> DataFrame:
    """The product names in the raw catalogue documents, in order."""
    names = raw_products.select(F.get_json_object("raw_json", "$.product_name").alias("product_name")).distinct()
    return names.orderBy("product_name") if limit is None else names.orderBy("product_name").limit(limit)
