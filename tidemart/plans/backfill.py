"""Many days in one plan: one scan a source, one evaluation a layer, one dynamic overwrite a table.

The result is what ``daily.run_daily`` leaves when it is run for one day after the other,
but the number of jobs does not grow with the number of days.  What orders the days there
is expressed as data here:

* the gate is a column: a day with a failed check keeps its raw and staged rows, its
  failures and its metrics, and takes no part in the loads;
* a dimension key is known from the first passed day that brings it, and a fact row must
  not be older than its keys;
* the catalogue keeps its latest values and its first day, the history all its versions.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, lifetime, metrics, quality, staging
from tidemart.operators.store import CODEC, TableStore
from tidemart.plans.daily import _RunLog, _utc_now
from tidemart.schemas import CONTRACTS
from tidemart.session import folders_side_by_side, scratch_dir, shuffles_released
from tidemart.sources import landing
from tidemart.streaming import late

RAW = {"orders": "raw.orders_json", "events": "raw.events_csv", "products": "raw.products_json"}


def calendar_days(first: dt.date | str, last: dt.date | str) -> list[dt.date]:
    day, stop = dt.date.fromisoformat(str(first)), dt.date.fromisoformat(str(last))
    return [day + dt.timedelta(days=n) for n in range((stop - day).days + 1)]


class _Backfill:
    """One range of days over a store."""

    def __init__(self, store: TableStore, landing_root: str, days: list[dt.date], now: Column, options: dict):
        self.store, self.spark, self.root, self.days, self.now = store, store.spark, landing_root, days, now
        self.options = options
        self.scratch = scratch_dir(store.spark, "backfill", options["scratch"])
        self.log = _RunLog(str(days[-1]))
        self.passed: list[dt.date] = []

    def rows(self, table: str, days: list[dt.date] | None = None) -> DataFrame:
        """A table's rows of the given days (all days of the range); the list is a partition filter."""
        day = CONTRACTS[table].partition
        return self.store.read(table).filter(F.col(day).isin(self.days if days is None else days))

    def aside(self, df: DataFrame, purpose: str) -> DataFrame:
        df.write.option("compression", CODEC).parquet(self.path_of(purpose))
        return self.spark.read.schema(df.schema).parquet(self.path_of(purpose))

    def path_of(self, purpose: str) -> str:
        return f"{self.scratch}/{purpose}"

    def extract(self) -> None:
        """Append what landed, all days of a kind as one delivery; notes the days that have a catalogue."""
        delivery = f"backfill-{uuid.uuid4().hex}"

        def step(kind: str):
            def action() -> None:
                rows = landing.read_days(self.spark, self.root, kind, self.days[0], self.days[-1],
                                         whole_file=kind != "events" and self.options["whole_file"])
                # Landed files are of one day each, so without a shuffle no more files come out.
                self.store.append(RAW[kind], rows, delivery)
            return action

        self.log.together({f"extract_{kind}": step(kind) for kind in RAW})
        for day in self.days if self.store.exists(late.LATE) else []:
            self.log.run("recover_late_events", lambda day=day: late.recover_late(self.store, day))
        fetched: list[dt.date] = []
        if self.store.exists(RAW["products"]):
            # Partition values only; no file is opened.
            found = self.store.delivered(RAW["products"], delivery).select("run_date").distinct()
            fetched = sorted(r.run_date for r in found.collect())
        self.catalogue_days = fetched

    def transform(self) -> None:
        options = {"strict": self.options["strict"], "loaded_at": self.now}
        staged = {
            "staging.orders_clean": (staging.stage_orders(self.rows(RAW["orders"]), **options), self.days),
            "staging.events_clean": (staging.stage_events(
                self.rows(RAW["events"]), check_types=self.options["check_types"], **options), self.days),
        }
        if self.catalogue_days:
            staged["staging.products_clean"] = (staging.stage_products(
                self.rows(RAW["products"], self.catalogue_days), **options), self.catalogue_days)

        def step(table: str, load: staging.Staged, days: list[dt.date]):
            def action() -> None:
                purpose = f"typed-{table}"
                typed = self.aside(load.typed, purpose)
                halves = staging.divide(typed, table, *staging.SOURCES[table], self.options["strict"])
                self.store.reload_days(table, halves.good, days)
                self.store.reload_days("audit.bad_records", halves.bad, days, table.split(".")[1])
                self.store.drop_scratch(self.path_of(purpose))
            return action

        self.log.together({f"transform_{t.split('.')[1]}": step(t, *load) for t, load in staged.items()})

    def check(self) -> None:
        def action() -> None:
            report = self.aside(quality.check_report(
                self.rows("staging.orders_clean"), self.rows("staging.events_clean"), as_of=self.now, days=self.days,
                orders_range=self.options["orders_range"], events_range=self.options["events_range"]), "report")
            self.store.reload_days("audit.dq_failures", quality.failures(report), self.days)
            # One row a day.
            self.passed = sorted(r.run_date for r in quality.gate(report).filter("passed").collect())

        self.log.run("quality_checks", action)

    def load_dimensions(self) -> None:
        store, passed = self.store, self.passed
        orders = self.rows("staging.orders_clean", passed)
        products = self.rows("staging.products_clean", [d for d in passed if d in self.catalogue_days])
        users, attributes = dimensions.users_of_day(orders), self.options["user_attributes"]
        # The dimensions as they are now tell which keys are new, so this is kept before they change.
        self.new_users = self.aside(dimensions.first_days(orders, store.read("warehouse.dim_user"), "user_id"), "users")
        self.new_products = self.aside(
            dimensions.first_days(products, store.read("warehouse.dim_product"), "product_id"), "products")
        days = self.spark.createDataFrame([(d,) for d in passed], "d DATE")
        sold = products.select("product_id")
        loads = {
            "dim_date": (None, lambda current: dimensions.load_dim_date(
                current, passed[0], orders.select("order_ts"), self.rows("staging.events_clean", passed).select("event_ts"),
                days, seed=not store.exists("warehouse.dim_date"))),
            "dim_user": (
                users if attributes is None else users.unionByName(attributes.select("user_id")),
                lambda current: dimensions.load_dim_user(current, orders, None, attributes, self.now)),
            "dim_product": (sold, lambda current: dimensions.load_dim_product(
                current, dimensions.catalogue_of(products), loaded_at=self.now)),
            "dim_product_history": (sold, lambda current: dimensions.load_product_snapshots(current, products)),
        }

        def step(name: str, touching, change):
            return lambda: store.merge(f"warehouse.{name}", touching, change)

        self.log.together({f"load_{name}": step(name, *load) for name, load in loads.items()})

    def load_facts(self) -> None:
        store, passed, read = self.store, self.passed, self.store.read
        orders, events = self.rows("staging.orders_clean", passed), self.rows("staging.events_clean", passed)
        dates = read("warehouse.dim_date")
        users = dimensions.since(read("warehouse.dim_user"), self.new_users, "user_id")
        items = dimensions.since(read("warehouse.dim_product"), self.new_products, "product_id")
        # The orders meet the dimensions once, for facts and rejects; events follow, so that less lies on disk at a time.
        keys = [self.aside(facts.dimension_keys(dim, key), f"keys-{key}")
                for dim, key in ((dates, "date_id"), (items, "product_id"), (users, "user_id"))]
        checked = self.aside(facts.check_orders(orders, *keys), "checked")
        self.log.together({
            "load_fact_orders": lambda: store.reload_days("warehouse.fact_orders", facts.passed_orders(checked), passed),
            "reject_fact_orders": lambda: store.reload_days(
                "audit.bad_records", facts.rejected_orders(checked), passed, "fact_orders"),
        })
        store.drop_scratch(self.path_of("checked"))
        self.log.run("load_fact_events", lambda: store.reload_days(
            "warehouse.fact_events", facts.load_fact_events(events, dates, users), passed))
        # A table has one writer at a time.
        self.log.run("reject_fact_events", lambda: store.reload_days(
            "audit.bad_records", facts.reject_fact_events(events, dates, users), passed, "fact_events"))
        self.log.run("constraint_report", lambda: store.reload_days(
            "audit.constraint_report", quality.stored_constraints(read, passed), passed))
        loaded = self.rows("warehouse.fact_orders", passed)
        self.log.together({
            "refresh_orders_summary": lambda: store.reload_days(
                "warehouse.mv_daily_orders_summary", facts.orders_summary_parts(loaded), passed),
            "refresh_revenue": lambda: store.reload_days("warehouse.mv_daily_revenue", facts.revenue_parts(loaded), passed),
            "refresh_user_orders": lambda: lifetime.refresh(store, passed),
        })

    def finish(self) -> None:
        layers = {m: self.store.read(t) for m, t in metrics.LAYERS.items()}
        rows = metrics.daily_metrics(layers, runtime_seconds=self.log.seconds, days=self.days)
        self.log.run("compute_metrics", lambda: self.store.upsert("warehouse.daily_metrics", rows))
        self.store.append("audit.pipeline_runs",
                          self.spark.createDataFrame(self.log.rows, CONTRACTS["audit.pipeline_runs"].ddl))
        if self.store.published():
            self.store.publish()


def backfill_days(
    store: TableStore, landing_root: str, first: dt.date | str, last: dt.date | str, *, whole_file: bool = False,
    strict: bool = False, check_types: bool = False, as_of: dt.datetime | None = None,
    user_attributes: DataFrame | None = None,
    orders_range: tuple[int, int] = (quality.ORDERS_MIN, quality.ORDERS_MAX),
    events_range: tuple[int, int] = (quality.EVENTS_MIN, quality.EVENTS_MAX),
    scratch: str | None = None,
) -> dict[str, bool]:
    """Load every day from ``first`` to ``last`` at once; returns which days passed the gate.

    Days that did not are left out of the loads and reported, without stopping the others.
    Options as in ``daily.run_daily``.  The days are expected to follow those already
    loaded: a catalogue older than the open version of a product does not change its
    history.  Running a range again replaces what it left, like reruns of its days; the
    users and products it brought are known by then.
    """
    days = calendar_days(first, last)
    if not days:
        return {}
    now = F.lit(as_of or _utc_now()).cast("timestamp_ntz")
    run = _Backfill(store, landing_root, days, now, {
        "whole_file": whole_file, "strict": strict, "check_types": check_types, "user_attributes": user_attributes,
        "orders_range": orders_range, "events_range": events_range, "scratch": scratch})
    store.recover()
    try:
        # What is written aside on the way, and the shuffle files of each step, go again.
        with shuffles_released(store.spark), folders_side_by_side(store.spark):
            _load(run)
    finally:
        store.drop_scratch(run.scratch)
    return {str(d): d in run.passed for d in days}


def _load(run: _Backfill) -> None:
    try:
        run.extract()
        run.transform()
        run.check()
        if run.passed:
            run.load_dimensions()
            run.load_facts()
    except Exception as stopped:
        try:
            run.finish()
        except Exception as later:
            stopped.add_note(f"metrics were not written either: {later}")
        raise
    run.finish()
