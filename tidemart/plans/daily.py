"""The daily job: extract, stage, check, load, measure -- in that order, for one day."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, lifetime, metrics, quality, staging
from tidemart.operators.store import TableStore
from tidemart.schemas import CONTRACTS
from tidemart.session import scratch_dir
from tidemart.sources import landing
from tidemart.streaming import late

JOB_NAME = "warehouse_daily"


@dataclass
class RunResult:
    """Rows written per step, and whether the checks passed."""

    run_date: str
    rows: dict[str, int] = field(default_factory=dict)
    passed: bool = False


def _utc_now() -> dt.datetime:
    """Wall time without a zone, in UTC like every other stamp."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class _RunLog:
    """Collects one row per step for ``audit.pipeline_runs``."""

    def __init__(self, run_date: str):
        self.run_date = run_date
        self.started = _utc_now()
        self.rows: list[tuple] = []

    def run(self, name: str, action: Callable[[], None]) -> None:
        started, status, error = _utc_now(), "success", None
        try:
            action()
        except Exception as exc:
            status, error = "failed", f"{type(exc).__name__}: {exc}"
            raise
        finally:
            ended = _utc_now()
            self.rows.append((
                JOB_NAME, name, self.started, status, started, ended,
                int((ended - started).total_seconds()), error, dt.date.fromisoformat(self.run_date)))

    def together(self, steps: dict[str, Callable[[], None]]) -> None:
        """Submit independent steps at once, so that one step's last tasks do not leave the
        cluster idle.  Each writes a table of its own."""
        with ThreadPoolExecutor(max_workers=max(len(steps), 1)) as pool:
            running = [pool.submit(self.run, name, action) for name, action in steps.items()]
        for step in running:
            step.result()

    @property
    def seconds(self) -> int:
        return int((_utc_now() - self.started).total_seconds())


class _Run:
    """One day's run over a store."""

    def __init__(self, store: TableStore, landing_root: str, day: str, now: Column, options: dict):
        self.store, self.spark, self.root, self.day, self.now = store, store.spark, landing_root, day, now
        self.options = options
        self.result, self.log = RunResult(day), _RunLog(day)

    def reload(self, table: str, df: DataFrame, within: str | None = None, name: str | None = None) -> None:
        self.result.rows[name or table] = self.store.reload_day(table, df, self.day, within)

    def extract(self) -> None:
        day, whole = self.day, self.options["whole_file"]
        readers = {
            "orders": ("raw.orders_json", lambda p: landing.read_orders(self.spark, p, day, whole_file=whole)),
            "events": ("raw.events_csv", lambda p: landing.read_events(self.spark, p, day)),
        }
        if landing.is_weekly_snapshot_day(day):
            readers["products"] = (
                "raw.products_json", lambda p: landing.read_products(self.spark, p, day, whole_file=whole))

        def step(kind: str, table: str, read: Callable[[str], DataFrame]) -> Callable[[], None]:
            def action() -> None:
                landed = read(landing.landing_path(self.root, kind, day))
                others = [source(day) for source in self.options["alternatives"].get(kind, ())]
                self.result.rows[table] = self.store.append(table, landing.first_available(landed, *others))
            return action

        self.log.together({f"extract_{k}": step(k, table, read) for k, (table, read) in readers.items()})
        # What a stream had to leave out is staged with the rest.
        self.log.run("recover_late_events", lambda: late.recover_late(self.store, day))

    def transform(self) -> None:
        store, day, strict = self.store, self.day, self.options["strict"]
        staged = {
            "staging.orders_clean": staging.stage_orders(
                store.read("raw.orders_json"), day, strict=strict, loaded_at=self.now),
            "staging.events_clean": staging.stage_events(
                store.read("raw.events_csv"), day, strict=strict,
                check_types=self.options["check_types"], loaded_at=self.now),
        }
        if self.result.rows.get("raw.products_json"):
            staged["staging.products_clean"] = staging.stage_products(
                store.read("raw.products_json"), day, strict=strict, loaded_at=self.now)

        def step(table: str, load: staging.Staged) -> Callable[[], None]:
            def action() -> None:
                # One evaluation of the input, written with its problems; both halves are
                # filters over what was written.
                path = scratch_dir(self.spark, "typed", self.options["scratch"])
                load.typed.write.parquet(path)
                typed = self.spark.read.schema(load.typed.schema).parquet(path)
                halves = staging.divide(typed, table, *staging.SOURCES[table], strict)
                self.reload(table, halves.good)
                self.reload("audit.bad_records", halves.bad, kind(table), f"{table} quarantined")
            return action

        def kind(table: str) -> str:
            return table.split(".")[1]

        self.log.together({f"transform_{kind(table)}": step(table, load) for table, load in staged.items()})

    def check(self) -> None:
        report = quality.check_report(
            self.store.read("staging.orders_clean"), self.store.read("staging.events_clean"),
            self.day, as_of=self.now, orders_range=self.options["orders_range"],
            events_range=self.options["events_range"])

        def action() -> None:
            self.reload("audit.dq_failures", quality.failures(report))
            failed = self.result.rows["audit.dq_failures"]
            self.result.passed = failed == 0
            if failed:
                raise quality.QualityGateError(f"{failed} quality checks failed for {self.day}")

        self.log.run("quality_checks", action)

    def load_dimensions(self) -> None:
        store, day = self.store, self.day
        read = store.read
        orders, products = read("staging.orders_clean"), read("staging.products_clean")
        users, attributes = dimensions.users_of_day(orders, day), self.options["user_attributes"]
        sold = staging.slice_of(products, day, "load_date").select("product_id")
        # Each load: the keys it touches, and the new state of what they touch.
        loads = {
            # The calendar covers what arrives late: it is seeded once, and days found in the
            # slice are added.
            "dim_date": (None, lambda current: dimensions.load_dim_date(
                current, day,
                staging.slice_of(orders, day, "load_date").select("order_ts"),
                staging.slice_of(read("staging.events_clean"), day, "load_date").select("event_ts"),
                seed=not store.exists("warehouse.dim_date"))),
            "dim_user": (
                users if attributes is None else users.unionByName(attributes.select("user_id")),
                lambda current: dimensions.load_dim_user(current, orders, day, attributes, self.now)),
        }
        if self.result.rows.get("staging.products_clean"):
            loads["dim_product"] = (sold, lambda current: dimensions.load_dim_product(current, products, day, self.now))
            loads["dim_product_history"] = (sold, lambda current: dimensions.load_product_history(current, products, day))

        def step(name: str, touching: DataFrame | None, change: Callable[[DataFrame], DataFrame]) -> Callable[[], None]:
            def action() -> None:
                self.result.rows[f"warehouse.{name}"] = store.merge(f"warehouse.{name}", touching, change)
            return action

        self.log.together({f"load_{name}": step(name, *load) for name, load in loads.items()})

    def load_facts(self) -> None:
        read, day = self.store.read, self.day
        orders, events = read("staging.orders_clean"), read("staging.events_clean")
        dates, items, users = (read(f"warehouse.{d}") for d in ("dim_date", "dim_product", "dim_user"))
        self.log.together({
            "load_fact_orders": lambda: self.reload(
                "warehouse.fact_orders", facts.load_fact_orders(orders, dates, items, users, day)),
            "load_fact_events": lambda: self.reload(
                "warehouse.fact_events", facts.load_fact_events(events, dates, users, day)),
        })
        rejects = {
            "fact_orders": facts.reject_fact_orders(orders, dates, items, users, day),
            "fact_events": facts.reject_fact_events(events, dates, users, day),
        }
        for name, rows in rejects.items():
            self.log.run(f"reject_{name}", functools.partial(
                self.reload, "audit.bad_records", rows, name, f"{name} rejected"))
        self.log.run("constraint_report", lambda: self.reload(
            "audit.constraint_report", quality.stored_constraints(read, [dt.date.fromisoformat(day)])))
        loaded = read("warehouse.fact_orders")
        self.log.together({
            "refresh_orders_summary": lambda: self.reload(
                "warehouse.mv_daily_orders_summary", facts.orders_summary_parts(loaded, day)),
            "refresh_revenue": lambda: self.reload(
                "warehouse.mv_daily_revenue", facts.revenue_parts(loaded, day)),
            "refresh_user_orders": lambda: lifetime.refresh(self.store, [dt.date.fromisoformat(day)]),
        })


def run_daily(
    store: TableStore, landing_root: str, run_date: dt.date | str | None = None, *, whole_file: bool = False,
    strict: bool = False, check_types: bool = False, as_of: dt.datetime | None = None,
    user_attributes: DataFrame | None = None,
    orders_range: tuple[int, int] = (quality.ORDERS_MIN, quality.ORDERS_MAX),
    events_range: tuple[int, int] = (quality.EVENTS_MIN, quality.EVENTS_MAX),
    scratch: str | None = None,
    alternatives: dict[str, list[Callable[[str], DataFrame]]] | None = None,
) -> RunResult:
    """Load one day; raises ``QualityGateError`` when a check fails.

    Every step replaces what an earlier run of the same day left, except the raw tables,
    which keep every delivery (staging keeps the latest copy of each key).  When the gate
    stops the run, failures, metrics and the run log are still written.  No ``run_date``
    means today (UTC).  ``scratch`` is a folder that all executors reach; the one named by
    ``spark.checkpoint.dir`` if not given.  Tables that are published are published again.

    ``alternatives`` names what to read where a day's files are missing or empty: for
    orders, events or products a list of functions from the day to rows of the raw table;
    the first that has rows is taken (``documents.to_raw_*`` shape other sources so).
    """
    now = F.lit(as_of or _utc_now()).cast("timestamp_ntz")
    run = _Run(store, landing_root, str(run_date or _utc_now().date()), now, {
        "whole_file": whole_file, "strict": strict, "check_types": check_types,
        "user_attributes": user_attributes, "orders_range": orders_range, "events_range": events_range,
        "scratch": scratch, "alternatives": alternatives or {}})
    store.recover()
    try:
        run.extract()
        run.transform()
        run.check()
        run.load_dimensions()
        run.load_facts()
    except Exception as stopped:
        try:
            _finish(store, run)
        except Exception as later:
            stopped.add_note(f"metrics were not written either: {later}")
        raise
    _finish(store, run)
    return run.result


def _finish(store: TableStore, run: _Run) -> None:
    _write_metrics(store, run.result, run.log)
    if store.published():
        store.publish()


def _write_metrics(store: TableStore, result: RunResult, log: _RunLog) -> None:
    """The day's metrics row and the run log: a handful of rows, whatever the day's size."""
    row = metrics.daily_metrics({m: store.read(t) for m, t in metrics.LAYERS.items()}, result.run_date, log.seconds)
    log.run("compute_metrics", lambda: store.upsert("warehouse.daily_metrics", row))
    store.append("audit.pipeline_runs",
                 store.spark.createDataFrame(log.rows, CONTRACTS["audit.pipeline_runs"].ddl))


def backfill(store: TableStore, landing_root: str, first: dt.date | str, last: dt.date | str,
             **options) -> dict[str, RunResult | Exception]:
    """Run every day from ``first`` to ``last`` in order; a day stopped by the gate is
    reported and does not stop the days after it."""
    day, stop = dt.date.fromisoformat(str(first)), dt.date.fromisoformat(str(last))
    results: dict[str, RunResult | Exception] = {}
    while day <= stop:
        try:
            results[str(day)] = run_daily(store, landing_root, day, **options)
        except quality.QualityGateError as stopped:
            results[str(day)] = stopped
        day += dt.timedelta(days=1)
    return results
