"""Run metrics: how many rows each layer holds per day."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_column
from tidemart.functions.exprs import DateLike
from tidemart.operators.staging import slice_of

# Metric column -> the stored table it counts.
LAYERS = {
    "raw_orders_count": "raw.orders_json", "staging_orders_count": "staging.orders_clean",
    "fact_orders_count": "warehouse.fact_orders", "raw_events_count": "raw.events_csv",
    "staging_events_count": "staging.events_clean", "fact_events_count": "warehouse.fact_events",
    "dq_failed_count": "audit.dq_failures",
}
# Metric column -> day column of the table it counts.
METRIC_DAYS = {
    "raw_orders_count": "run_date",
    "staging_orders_count": "load_date",
    "fact_orders_count": "load_date",
    "raw_events_count": "run_date",
    "staging_events_count": "load_date",
    "fact_events_count": "load_date",
    "dq_failed_count": "run_date",
}


def daily_metrics(layers: dict[str, DataFrame], run_date: DateLike = None,
                  runtime_seconds: int | None = None, days: list[dt.date] | None = None) -> DataFrame:
    """One row per day (or for ``run_date`` alone) with the row count of every layer.

    Each of ``days`` gets a row, also one without any rows; other days get none.

    Each table is counted once per day; the counts are stacked and summed, so the layers
    are never joined.
    """
    parts = []
    for metric, day in METRIC_DAYS.items():
        rows = slice_of(layers[metric], run_date, day)
        if days is not None:
            rows = rows.filter(F.col(day).isin(days))
        counted = rows.groupBy(F.col(day).alias("run_date"))
        parts.append(counted.agg(F.count("*").alias(metric)))
    if run_date is not None:
        spark = next(iter(layers.values())).sparkSession
        parts.append(spark.range(1).select(day_column(run_date).alias("run_date")))
    if days is not None:
        spark = next(iter(layers.values())).sparkSession
        parts.append(spark.createDataFrame([(d,) for d in days], "run_date DATE"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy("run_date").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in METRIC_DAYS]
    ).withColumn("runtime_seconds", F.lit(runtime_seconds).cast("bigint"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row with the total row count of each named layer."""
    tagged = [df.agg(F.count("*").alias(name)) for name, df in layers.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return stacked.agg(*[F.sum(name).alias(name) for name in layers])
