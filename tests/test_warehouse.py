"""Merges, dimensions, facts, checks, metrics."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, merge, metrics, quality
from tidemart.schemas import CONTRACTS

DAY = dt.date(2024, 3, 4)
TS = dt.datetime(2024, 3, 4, 10)


def table(spark, name, *rows):
    """Rows given as dicts; columns left out are NULL."""
    columns = CONTRACTS[name].column_names
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], CONTRACTS[name].ddl)


def order(order_id="O1", **changes):
    return {"order_id": order_id, "user_id": "U1", "product_id": "P1", "quantity": 1,
            "unit_price": Decimal("2.00"), "revenue": Decimal("2.00"), "order_ts": TS, "status": "paid",
            "load_date": DAY} | changes


def event(event_id="E1", **changes):
    return {"event_id": event_id, "user_id": "U1", "product_id": "P1", "event_type": "purchase",
            "event_ts": TS, "load_date": DAY} | changes


@pytest.mark.parametrize("day, week, dow, weekend", [
    ("2024-12-29", 52, 0, True), ("2024-12-30", 1, 1, False), ("2021-01-03", 53, 0, True)])
def test_calendar(spark, day, week, dow, weekend):
    row = dimensions.build_dim_date(spark, day, day).collect()[0]
    assert (row.week, row.day_of_week, row.is_weekend) == (week, dow, weekend)
    assert row.date_id == int(day.replace("-", "")) and row.year == int(day[:4])
    assert row.day_name == dt.date.fromisoformat(day).strftime("%A")


def test_calendar_seed_span(spark):
    rows = dimensions.seed_dim_date(spark, "2024-02-29")
    first, last = rows.agg(F.min("date"), F.max("date")).collect()[0]
    assert (first, last) == (dt.date(2023, 2, 28), dt.date(2026, 2, 28))
    assert rows.count() == (last - first).days + 1


def test_upsert_takes_nulls_and_keeps_first_insert(spark):
    known = table(spark, "warehouse.dim_product",
                  {"product_id": "P1", "brand": "old", "category": "c", "effective_from": dt.date(2024, 1, 1)},
                  {"product_id": "P2", "brand": "same", "effective_from": dt.date(2024, 1, 1)})
    staged = table(spark, "staging.products_clean",
                   {"product_id": "P1", "category": "d", "load_date": DAY},
                   {"product_id": "P3", "brand": "new", "load_date": DAY},
                   {"product_id": "P9", "brand": "other day", "load_date": dt.date(2024, 3, 5)})
    rows = {r.product_id: r for r in dimensions.load_dim_product(known, staged, DAY).collect()}
    assert set(rows) == {"P1", "P2", "P3"}
    assert rows["P1"].brand is None and rows["P1"].category == "d"
    assert rows["P1"].effective_from == dt.date(2024, 1, 1) and rows["P3"].effective_from == DAY
    assert rows["P2"].brand == "same" and all(r.effective_to is None for r in rows.values())


def test_insert_absent_leaves_known_rows(spark):
    current = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    incoming = spark.createDataFrame([(1, "new"), (2, "new")], "k INT, v STRING")
    assert {tuple(r) for r in merge.insert_absent(current, incoming, ["k"]).collect()} == {(1, "old"), (2, "new")}


def test_users_keep_attributes_they_have(spark):
    known = table(spark, "warehouse.dim_user", {"user_id": "U1", "city": "Rome", "created_at": TS, "updated_at": TS})
    orders = table(spark, "staging.orders_clean", order(), order("O2", user_id="U2"), order("O3", user_id="U2"))
    rows = {r.user_id: r for r in dimensions.load_dim_user(known, orders, DAY).collect()}
    assert set(rows) == {"U1", "U2"} and rows["U1"].city == "Rome"
    assert rows["U1"].created_at == TS and rows["U1"].updated_at > TS
    feed = spark.createDataFrame([("U2", "Oslo", DAY, "ads")],
                                 "user_id STRING, city STRING, signup_date DATE, marketing_source STRING")
    rows = {r.user_id: r for r in dimensions.load_dim_user(known, orders, DAY, feed).collect()}
    assert rows["U1"].city == "Rome" and rows["U2"].city == "Oslo" and rows["U2"].marketing_source == "ads"


def history_rows(df):
    return sorted(tuple(r) for r in df.select("product_id", "brand", "effective_from", "effective_to")
                  .withColumn("effective_to", F.coalesce("effective_to", F.lit("9999-12-31").cast("date"))).collect())


def test_history_versions(spark):
    d1, d2, d3, end = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(9999, 12, 31)

    def snap(day, **brands):
        return table(spark, "staging.products_clean",
                     *[{"product_id": p, "brand": b, "load_date": day} for p, b in brands.items()])

    empty = spark.createDataFrame([], CONTRACTS["warehouse.dim_product_history"].ddl)
    h1 = dimensions.load_product_history(empty, snap(d1, A="x", B="y"), d1)
    h2 = dimensions.load_product_history(h1, snap(d2, A="x", B=None, C="z"), d2)
    again = dimensions.load_product_history(h2, snap(d2, A="x", B=None, C="z"), d2)
    fixed = dimensions.load_product_history(h2, snap(d2, A="x", B="w", C="z"), d2)
    h3 = dimensions.load_product_history(h2, snap(d3, B="y"), d3)
    base = [("A", "x", d1, end), ("C", "z", d2, end), ("B", "y", d1, d2)]
    assert history_rows(h2.fillna("null", ["brand"])) == sorted([*base, ("B", "null", d2, end)])
    assert history_rows(again.fillna("null", ["brand"])) == history_rows(h2.fillna("null", ["brand"]))
    assert history_rows(fixed) == sorted([*base, ("B", "w", d2, end)])
    assert history_rows(h3.fillna("null", ["brand"])) == sorted([*base, ("B", "null", d2, d3), ("B", "y", d3, end)])
    snaps = snap(d1, A="x", B="y").unionByName(snap(d2, A="x", B=None, C="z")).unionByName(snap(d3, B="y"))
    once = merge.history_from_snapshots(snaps, ["product_id"], dimensions.PRODUCT_ATTRIBUTES)
    assert history_rows(once.fillna("null", ["brand"])) == history_rows(h3.fillna("null", ["brand"]))


def dims(spark):
    return (dimensions.build_dim_date(spark, "2024-03-01", "2024-03-31"),
            table(spark, "warehouse.dim_product", {"product_id": "P1"}),
            table(spark, "warehouse.dim_user", {"user_id": "U1"}))


def test_fact_orders_and_rejects_partition_the_input(spark):
    dates, products, users = dims(spark)
    orders = table(spark, "staging.orders_clean", order(), order("O2", product_id="P9"), order("O3", user_id="U9"),
                   order("O4", order_ts=dt.datetime(2024, 2, 29), product_id="P9"),
                   order("O5", order_ts=dt.datetime(2024, 3, 3)),
                   order("O6", load_date=dt.date(2024, 3, 5)))
    loaded = {r.order_id: r for r in facts.load_fact_orders(orders, dates, products, users, DAY).collect()}
    assert set(loaded) == {"O1", "O5"}
    assert loaded["O5"].date_id == 20240303 and loaded["O5"].load_date == DAY
    rejects = {(r.record_id, r.failure_reason, r.failed_value)
               for r in facts.reject_fact_orders(orders, dates, products, users, DAY).collect()}
    assert rejects == {("O2", "product_id not in dimension", "P9"), ("O3", "user_id not in dimension", "U9"),
                       ("O4", "date_id not in dimension", "20240229"), ("O4", "product_id not in dimension", "P9")}


def test_fact_events_need_no_product(spark):
    dates, _, users = dims(spark)
    events = table(spark, "staging.events_clean", event(), event("E2", product_id=None), event("E3", product_id="P9"),
                   event("E4", user_id="U9"))
    assert {r.event_id for r in facts.load_fact_events(events, dates, users, DAY).collect()} == {"E1", "E2", "E3"}
    assert [r.record_id for r in facts.reject_fact_events(events, dates, users, DAY).collect()] == ["E4"]


def report(spark, orders, events, run_date=DAY, as_of=dt.datetime(2024, 3, 5)):
    rows = quality.check_report(table(spark, "staging.orders_clean", *orders),
                                table(spark, "staging.events_clean", *events), run_date,
                                F.lit(as_of).cast("timestamp_ntz"))
    return {r.check_name: r for r in rows.collect()}


@pytest.mark.parametrize("n_orders, n_events, failed", [
    (99, 499, {"orders_volume", "events_volume"}), (100, 500, set())])
def test_volume_bounds(spark, n_orders, n_events, failed):
    got = report(spark, [order(f"O{i}") for i in range(n_orders)], [event(f"E{i}") for i in range(n_events)])
    assert {n for n, r in got.items() if r.failed} == failed
    assert list(got) and set(got) == set(quality.CHECKS)


def test_checks_on_a_day_without_rows(spark):
    got = report(spark, [], [])
    assert got["orders_volume"].failure_message == "Orders count 0 outside range [100, 500000]"
    assert json.loads(got["events_volume"].details) == {"count": 0, "min": 500, "max": 2000000}
    assert not got["orders_no_duplicates"].failed


def test_range_and_uniqueness_checks(spark):
    later = dt.datetime(2024, 3, 6)
    orders = [order("A"), order("A"), order("A"), order("B", revenue=Decimal("0.00")),
              order("C", revenue=Decimal("-0.01")), order("D", order_ts=later), order("E", load_date=later.date())]
    got = report(spark, orders, [event("E"), event("E"), event("F", event_ts=later)])
    assert got["orders_no_duplicates"].failed_count == 1
    assert got["events_no_duplicates"].failure_message == "Found 1 duplicate event IDs"
    assert json.loads(got["orders_revenue_valid"].details) == {"invalid_records": 1}
    assert json.loads(got["timestamps_not_future"].details) == {"orders": 1, "events": 1}
    assert got["timestamps_not_future"].failure_message == "Found 2 records with future timestamps"


def test_constraints(spark):
    orders = table(spark, "staging.orders_clean", order(), order(), order("B", user_id=None), order("C", status="s" * 51))
    found = {r.constraint_name: r.violations for r in quality.constraint_violations(
        orders, CONTRACTS["staging.orders_clean"]).collect()}
    assert {k: v for k, v in found.items() if v} == {
        "user_id not null": 1, "status length <= 50": 1, "unique(order_id, load_date)": 1}
    empty = spark.createDataFrame([], CONTRACTS["staging.orders_clean"].ddl)
    assert all(r.violations == 0 for r in quality.constraint_violations(
        empty, CONTRACTS["staging.orders_clean"]).collect())


def test_cross_day_duplicates(spark):
    orders = table(spark, "staging.orders_clean", order(), order(load_date=dt.date(2024, 3, 9)), order("B"), order("B"))
    rows = quality.cross_day_duplicates(orders, "order_id").collect()
    assert [(r.order_id, r.first_day, r.last_day) for r in rows] == [("O1", DAY, dt.date(2024, 3, 9))]


def test_metrics_of_an_empty_day(spark):
    layers = {m: spark.createDataFrame([], f"{d} DATE") for m, d in metrics.METRIC_DAYS.items()}
    row = metrics.daily_metrics(layers, DAY, 12).collect()
    assert len(row) == 1 and row[0].raw_orders_count == 0 and row[0].runtime_seconds == 12


def test_constraint_report(spark):
    day, other = dt.date(2024, 3, 4), dt.date(2024, 3, 5)
    at = dt.datetime(2024, 3, 4, 10)
    rows = [("A", "U1", "P1", 20240304, 1, "5.004", at, "paid", day),
            ("A", "U1", "P1", 20240304, 1, "9999999999.994", at, "paid", day),
            ("B", None, "P9", 20240304, 1, "9999999999.995", at, "s" * 51, day),
            ("C", "U9", "P1", 20240301, None, "many", None, None, other)]
    orders = spark.createDataFrame(rows, "order_id STRING, user_id STRING, product_id STRING, date_id INT, quantity INT, revenue STRING, "
                                         "order_ts TIMESTAMP_NTZ, status STRING, load_date DATE")
    dims = {"warehouse.dim_date": spark.createDataFrame([(20240304,)], "date_id INT"),
            "warehouse.dim_user": spark.createDataFrame([("U1",), ("U2",)], "user_id STRING"),
            "warehouse.dim_product": spark.createDataFrame([("P1",)], "product_id STRING")}
    found = quality.constraint_report({"warehouse.fact_orders": orders}, dims).collect()
    assert {r.checked for r in found if r.run_date == day} == {3}
    breaches = {(str(r.run_date)[-1], r.constraint_name): r.violations for r in found if r.violations}
    assert breaches == {
        ("4", "user_id not null"): 1, ("4", "status length <= 50"): 1, ("4", "revenue numeric(12,2)"): 1,
        ("4", "product_id references warehouse.dim_product"): 1, ("4", "unique(order_id, load_date)"): 1,
        ("5", "quantity not null"): 1, ("5", "order_ts not null"): 1, ("5", "revenue numeric(12,2)"): 1,
        ("5", "date_id references warehouse.dim_date"): 1, ("5", "user_id references warehouse.dim_user"): 1}
    assert len(found) == 2 * len({r.constraint_name for r in found})
    users = spark.createDataFrame([("U1", "x" * 300), ("U1", "y")], "user_id STRING, city STRING")
    whole = {r.constraint_name: (r.run_date, r.violations) for r in quality.constraint_report({"warehouse.dim_user": users}, {}).collect()}
    assert whole["unique(user_id)"] == (None, 1) and whole["city length <= 256"] == (None, 1)
    assert quality.constraint_report({"warehouse.fact_orders": orders.limit(0)}, dims).collect() == []
