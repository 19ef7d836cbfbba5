"""Data-quality checks: one aggregation per table, one report row per check and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_column
from tidemart.functions.exprs import DateLike
from tidemart.operators.staging import slice_of
from tidemart.schemas import CONTRACTS, EVENT_TYPES, TableContract

# Accepted daily volumes, bounds included.
ORDERS_MIN, ORDERS_MAX = 100, 500_000
EVENTS_MIN, EVENTS_MAX = 500, 2_000_000

# Check names and their types, in report order.
CHECKS = {
    "orders_volume": "volume",
    "events_volume": "volume",
    "orders_no_duplicates": "uniqueness",
    "events_no_duplicates": "uniqueness",
    "orders_revenue_valid": "range",
    "timestamps_not_future": "range",
}

_COUNTS = ("orders", "events", "order_dups", "event_dups", "negative", "orders_future", "events_future")


class QualityGateError(RuntimeError):
    """At least one check failed, so the loads behind the gate must not run."""


def _now(as_of: Column | None) -> Column:
    return (F.current_timestamp() if as_of is None else as_of).cast("timestamp_ntz")


def order_counts(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per day: rows, order ids seen more than once, negative revenues, future times.

    The first level is keyed by (day, id), so no task sees more than its share however
    large a day is; the duplicate count falls out of the same pass.
    """
    per_id = orders.groupBy("load_date", "order_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("revenue") < 0).alias("neg"),
        F.count_if(F.col("order_ts") > _now(as_of)).alias("fut"),
    )
    return per_id.groupBy(F.col("load_date").alias("run_date")).agg(
        F.sum("n").alias("orders"),
        F.count_if(F.col("n") > 1).alias("order_dups"),
        F.sum("neg").alias("negative"),
        F.sum("fut").alias("orders_future"),
    )


def event_counts_by_day(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per day: rows, event ids seen more than once, future times."""
    per_id = events.groupBy("load_date", "event_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_ts") > _now(as_of)).alias("fut"),
    )
    return per_id.groupBy(F.col("load_date").alias("run_date")).agg(
        F.sum("n").alias("events"),
        F.count_if(F.col("n") > 1).alias("event_dups"),
        F.sum("fut").alias("events_future"),
    )


def _check(name: str, failed: Column, count: Column, message: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(CHECKS[name]).alias("check_type"),
        failed.alias("failed"),
        F.when(failed, count).otherwise(F.lit(0)).cast("bigint").alias("failed_count"),
        F.when(failed, message).alias("failure_message"),
        F.when(failed, F.to_json(details)).alias("details"),
    )


# The messages below, and the wording of the checks, are fixed values of the report.
def _volume(name: str, noun: str, count: Column, low: int, high: int) -> Column:
    text = F.concat(F.lit(f"{noun} count "), count, F.lit(f" outside range [{low}, {high}]"))
    details = F.struct(count.alias("count"), F.lit(low).alias("min"), F.lit(high).alias("max"))
    return _check(name, ~count.between(low, high), count, text, details)


def _found(name: str, count: Column, what: str, details: Column) -> Column:
    text = F.concat(F.lit("Found "), count, F.lit(f" {what}"))
    return _check(name, count > 0, count, text, details)


def check_report(orders: DataFrame, events: DataFrame, run_date: DateLike = None,
                 as_of: Column | None = None, only: Iterable[str] | None = None,
                 orders_range: tuple[int, int] = (ORDERS_MIN, ORDERS_MAX),
                 events_range: tuple[int, int] = (EVENTS_MIN, EVENTS_MAX),
                 days: list[dt.date] | None = None) -> DataFrame:
    """The checks, one row per check and day (every day present, or just ``run_date``).

    A given ``run_date`` is reported even when it has no rows at all, and so is each of
    ``days``, which the rows are expected to be filtered to.  ``only`` names the
    checks to run; counts that none of them needs are pruned from the plan.  The accepted
    volumes default to the fixed ones; a larger shop passes its own.
    """
    parts = [
        order_counts(slice_of(orders, run_date, "load_date"), as_of),
        event_counts_by_day(slice_of(events, run_date, "load_date"), as_of),
    ]
    if run_date is not None:
        spark = orders.sparkSession
        parts.append(spark.range(1).select(day_column(run_date).alias("run_date")))
    if days is not None:
        parts.append(orders.sparkSession.createDataFrame([(d,) for d in days], "run_date DATE"))
    # Stacking the small per-day counts and summing them needs no join.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    n = {c: F.col(c) for c in _COUNTS}
    per_day = stacked.groupBy("run_date").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]
    )
    future = n["orders_future"] + n["events_future"]
    checks = {
        "orders_volume": _volume("orders_volume", "Orders", n["orders"], *orders_range),
        "events_volume": _volume("events_volume", "Events", n["events"], *events_range),
        "orders_no_duplicates": _found(
            "orders_no_duplicates", n["order_dups"], "duplicate order IDs",
            F.struct(n["order_dups"].alias("duplicates"))),
        "events_no_duplicates": _found(
            "events_no_duplicates", n["event_dups"], "duplicate event IDs",
            F.struct(n["event_dups"].alias("duplicates"))),
        "orders_revenue_valid": _found(
            "orders_revenue_valid", n["negative"], "orders with negative revenue",
            F.struct(n["negative"].alias("invalid_records"))),
        "timestamps_not_future": _found(
            "timestamps_not_future", future, "records with future timestamps",
            F.struct(n["orders_future"].alias("orders"), n["events_future"].alias("events"))),
    }
    wanted = F.array(*[checks[name] for name in (only or CHECKS)])
    return per_day.select("run_date", F.explode(wanted).alias("c")).select("run_date", "c.*")


def failures(report: DataFrame) -> DataFrame:
    """The failed checks of a report, in the shape of ``audit.dq_failures``."""
    return report.filter("failed").select(*CONTRACTS["audit.dq_failures"].column_names)


def gate(report: DataFrame) -> DataFrame:
    """Whether all checks of a day passed: (run_date, passed), the gate as a column."""
    return report.groupBy("run_date").agg(F.bool_and(~F.col("failed")).alias("passed"))


def duplicate_ids(df: DataFrame, key: str, day: str = "load_date") -> DataFrame:
    """Ids that occur more than once within a day, with their counts."""
    return df.groupBy(day, key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def cross_day_duplicates(df: DataFrame, key: str, day: str = "load_date") -> DataFrame:
    """Ids loaded on more than one day: legal for the key, but sums count them twice.

    Min and max of the day are enough to tell, so no distinct list is built.
    """
    spans = df.groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("copies")
    )
    return spans.filter(F.col("first_day") < F.col("last_day"))


def unknown_event_types(events: DataFrame, allowed: Iterable[str] = EVENT_TYPES) -> DataFrame:
    """How many events carry a type outside the known list, by type."""
    return (
        events.filter(~F.col("event_type").isin(*allowed))
        .groupBy("event_type").agg(F.count("*").alias("events"))
    )


def constraint_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows that break each declared rule of a table: (constraint_name, violations).

    Required columns and value lengths are counted in one pass; the key check adds a
    first level keyed by the key, which partial aggregation keeps even for a hot key.
    """
    rules: dict[str, Column] = {}
    for name in contract.required:
        if name in df.columns:
            rules[f"{name} not null"] = F.col(name).isNull()
    for name, limit in contract.max_length.items():
        if name in df.columns:
            rules[f"{name} length <= {limit}"] = F.char_length(name) > limit
    names = list(rules)
    flags = [F.count_if(rules[r]).alias(f"r{i}") for i, r in enumerate(names)]
    if contract.key:
        per_key = df.groupBy(*contract.key).agg(F.count("*").alias("_n"), *flags)
        sums = [F.sum(f"r{i}").alias(f"r{i}") for i in range(len(names))]
        totals = per_key.agg(*sums, F.sum(F.col("_n") - 1).alias("r_key"))
        names.append("unique(" + ", ".join(contract.key) + ")")
        columns = [*[f"r{i}" for i in range(len(names) - 1)], "r_key"]
    else:
        totals = df.agg(*flags)
        columns = [f"r{i}" for i in range(len(names))]
    rows = F.array(*[
        F.struct(F.lit(n).alias("constraint_name"),
                 F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
        for n, c in zip(names, columns)
    ])
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def _breaches(df: DataFrame, contract: TableContract) -> dict[str, Column]:
    """What breaks each rule of a row by itself: NOT NULL, length, NUMERIC(p,s)."""
    rules = {f"{name} not null": F.col(name).isNull() for name in contract.required if name in df.columns}
    rules |= {f"{name} length <= {limit}": F.char_length(name) > limit
              for name, limit in contract.max_length.items() if name in df.columns}
    for name, (precision, scale) in contract.decimals.items():
        if name in df.columns:
            # A value is stored rounded to its scale; it breaks the type when that needs too many digits.
            exact = F.col(name).try_cast(f"decimal(38,{scale})")
            limit = F.lit(10 ** (precision - scale)).cast(f"decimal(38,{scale})")
            rules[f"{name} numeric({precision},{scale})"] = F.col(name).isNotNull() & (exact.isNull() | (F.abs(exact) >= limit))
    return rules


def table_constraints(df: DataFrame, contract: TableContract, dimensions: dict[str, DataFrame]) -> DataFrame:
    """All declared rules of a table by its day: (run_date, constraint_name, checked, violations).

    One pass: the unique key of each referenced dimension flags the rows through a left
    join, all breaches are counted by key first (which partial aggregation keeps small
    even for a hot key), then summed by day.  A NULL reference breaks NOT NULL where that
    is declared, and no reference.  Days come from the partition column; a table without
    one has a single row of each rule, with no day.
    """
    flagged, rules = df, _breaches(df, contract)
    for key, table in contract.references.items():
        name = f"_has_{key}"
        flagged = flagged.join(dimensions[table].select(key).withColumn(name, F.lit(True)), key, "left")
        rules[f"{key} references {table}"] = F.col(key).isNotNull() & F.col(name).isNull()
    day = F.col(contract.partition) if contract.partition in df.columns else F.lit(None).cast("date")
    names = list(rules)
    flags = [F.count_if(rules[r]).alias(f"r{i}") for i, r in enumerate(names)]
    level = [day.alias("run_date"), *[F.col(k) for k in contract.key if k != contract.partition]]
    per_key = flagged.groupBy(*level).agg(F.count(F.lit(1)).alias("n"), *flags)
    totals = per_key.groupBy("run_date").agg(
        F.sum("n").alias("checked"), F.sum(F.col("n") - 1).alias("repeats"),
        *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(names))])
    counted = {r: F.col(f"r{i}") for i, r in enumerate(names)}
    if contract.key:
        counted[f"unique({', '.join(contract.key)})"] = F.col("repeats")
    rows = F.array(*[F.struct(F.lit(r).alias("constraint_name"), c.cast("bigint").alias("violations")) for r, c in counted.items()])
    return totals.select("run_date", "checked", F.explode(rows).alias("r")).select(
        "run_date", "r.constraint_name", "checked", "r.violations")


def constraint_report(tables: dict[str, DataFrame], dimensions: dict[str, DataFrame]) -> DataFrame:
    """``table_constraints`` of several tables, in the shape of ``audit.constraint_report``.

    ``tables`` maps contract names to rows, ``dimensions`` the referenced tables to theirs.
    """
    parts = [table_constraints(df, CONTRACTS[name], dimensions).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).select(*CONTRACTS["audit.constraint_report"].column_names)


def stored_constraints(read: Callable[[str], DataFrame], days: list[dt.date]) -> DataFrame:
    """The report over staging and facts of some days; ``read`` opens a table by name."""
    names = ("staging.orders_clean", "staging.events_clean", "warehouse.fact_orders", "warehouse.fact_events")
    referenced = {table for name in names for table in CONTRACTS[name].references.values()}
    return constraint_report({name: read(name).filter(F.col("load_date").isin(days)) for name in names},
                             {table: read(table) for table in sorted(referenced)})
