"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is timed to a ``noop`` sink, which computes every row and column and keeps
none; the best of ``$BENCH_RUNS`` runs counts, after one untimed warm-up query.  ``warehouse_build`` writes the star
schema once, by load day as the job does, and the ``stored_*`` queries read it back, the way an analyst would.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from tidemart.operators import lifetime  # noqa: E402
from tidemart.operators.store import TableStore  # noqa: E402
from tidemart.plans import customers, funnel, products, registry, revenue  # noqa: E402
from tidemart.plans.driver_tables import EVENTS_AS_OF, ORDERS_AS_OF, DriverTables  # noqa: E402
from tidemart.plans.warehouse import StoredWarehouse, Warehouse  # noqa: E402
from tidemart.session import build_session, scratch_dir  # noqa: E402

HEADLINE = (
    "revenue_by_date", "revenue_by_category", "revenue_by_brand", "top_customers", "repeat_customers",
    "marketing_source_performance", "product_performance", "top_products_by_category", "event_funnel",
    "product_conversion", "wow_growth", "day_of_week_seasonality", "event_counts", "stg_orders",
    "stg_events", "fact_orders_load", "fact_events_load", "dq_report", "quarantine_orders",
    "daily_metrics", "lineage_orders", "scd2_dim_product",
)

STORED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stored_revenue_by_date": lambda wh: revenue.revenue_by_date(wh, ORDERS_AS_OF),
    "stored_revenue_by_category": lambda wh: revenue.revenue_by_category(wh, "2000-12-31"),
    "stored_top_customers": lambda wh: customers.top_customers(wh),
    "stored_marketing_source": lambda wh: customers.marketing_source_performance(wh),
    "stored_product_performance": lambda wh: products.product_performance(wh, ORDERS_AS_OF),
    "stored_event_funnel": lambda wh: funnel.event_funnel(wh, EVENTS_AS_OF),
}


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None], runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def build(store: TableStore, tables: DriverTables) -> None:
    """Write the star schema."""
    for name, rows in (("dim_date", tables.dim_date), ("dim_user", tables.dim_user), ("dim_product", tables.dim_product)):
        contract = store.contract(f"warehouse.{name}")
        missing = [c for c in contract.column_names if c not in rows.columns]
        full = rows.selectExpr("*", *[f"NULL AS {c}" for c in missing])
        store.write_snapshot(f"warehouse.{name}", full)
    for name, rows in (("fact_orders", tables.fact_orders), ("fact_events", tables.fact_events)):
        store.reload_days(f"warehouse.{name}", rows)
    lifetime.refresh(store, [])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    tables, times = DriverTables(spark, folder), {}
    # One untimed query starts the JVM's compilers, so that the first timed one is not charged for it.
    drain(registry.run(HEADLINE[0], spark, folder))
    for name in HEADLINE:
        times[name] = timed(lambda: drain(registry.run(name, spark, folder)), runs)
    store = TableStore(spark, scratch_dir(spark, "bench"))
    times["warehouse_build"] = timed(lambda: build(store, tables), 1)
    warehouse = StoredWarehouse(store)
    for name, plan in STORED.items():
        times[name] = timed(lambda: drain(plan(warehouse)), runs)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
