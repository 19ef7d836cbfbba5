"""Typing, deduplication and quarantine."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators import staging

DAY = dt.date(2024, 3, 4)
GOOD = {"order_id": "O1", "user_id": "U1", "product_id": "P1", "quantity": 3, "price": 1.005,
        "timestamp": "2024-03-04T10:00:00", "status": "Paid"}


def raw_orders(spark, *docs, day=DAY):
    rows = [("f", dt.datetime(2024, 3, 4, hour), doc if isinstance(doc, str) else json.dumps(doc), day)
            for hour, doc in docs]
    return spark.createDataFrame(rows, "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")


def good(staged):
    return {r.order_id: r for r in staged.good.collect()}


def reasons(staged):
    return {(r.record_id, r.failure_reason, r.failed_value) for r in staged.bad.collect()}


def test_order_types_and_exact_revenue(spark):
    row = good(staging.stage_orders(raw_orders(spark, (1, GOOD)), "2024-03-04"))["O1"]
    assert row.unit_price == Decimal("1.01") and row.revenue == Decimal("3.02")
    assert row.order_ts == dt.datetime(2024, 3, 4, 10) and row.load_date == DAY
    assert row.status == "Paid"


def test_zone_suffix_is_ignored_and_numbers_as_text_are_read(spark):
    doc = GOOD | {"timestamp": "2024-03-04T10:00:00+02:00", "quantity": "4", "price": "2.50", "order_id": 12}
    row = good(staging.stage_orders(raw_orders(spark, (1, doc))))["12"]
    assert row.order_ts == dt.datetime(2024, 3, 4, 10) and row.revenue == Decimal("10.00")


def test_latest_copy_wins_and_ties_are_fixed(spark):
    older, newer = GOOD | {"status": "pending"}, GOOD | {"status": "paid"}
    raw = raw_orders(spark, (5, older), (6, newer), (4, GOOD | {"status": "x"}))
    assert good(staging.stage_orders(raw))["O1"].status == "paid"
    tie = [(5, GOOD | {"status": s}) for s in ("a", "c", "b")]
    first = good(staging.stage_orders(raw_orders(spark, *tie)))["O1"].status
    again = good(staging.stage_orders(raw_orders(spark, *reversed(tie)).repartition(3)))["O1"].status
    assert first == again == "c"


def test_same_order_on_two_days_is_kept_twice(spark):
    raw = raw_orders(spark, (1, GOOD)).unionByName(raw_orders(spark, (2, GOOD), day=dt.date(2024, 3, 5)))
    assert staging.stage_orders(raw).good.count() == 2
    assert staging.stage_orders(raw, "2024-03-05").good.count() == 1


def test_bad_orders_are_quarantined_with_reasons(spark):
    docs = [
        GOOD,
        GOOD | {"order_id": "Q", "quantity": "abc"},
        GOOD | {"order_id": "P", "price": 123456789012},
        GOOD | {"order_id": "U", "user_id": None},
        GOOD | {"order_id": "T", "timestamp": "soon", "status": None},
        GOOD | {"order_id": "R", "price": 99999999, "quantity": 2000000},
        GOOD | {"order_id": "L", "status": "s" * 51},
        {k: v for k, v in GOOD.items() if k != "order_id"},
        GOOD | {"order_id": None},
        "not json",
    ]
    staged = staging.stage_orders(raw_orders(spark, *[(1, d) for d in docs]))
    assert set(good(staged)) == {"O1"}
    assert reasons(staged) == {
        ("Q", "quantity missing or not an integer", "abc"),
        ("P", "price missing or out of range", "123456789012"),
        ("U", "user_id missing", None),
        ("T", "timestamp missing or unreadable", "soon"),
        ("T", "status missing", None),
        ("R", "revenue out of range", "2000000 x 99999999"),
        ("L", "status too long", "s" * 51),
        (None, "order_id missing", None),
    }
    assert staged.bad.filter(F.col("failure_reason") == "order_id missing").count() == 3
    assert staged.bad.filter(F.col("raw_data") == "not json").count() == 1


def test_latest_copy_counts_even_when_it_is_bad(spark):
    raw = raw_orders(spark, (1, GOOD), (2, GOOD | {"quantity": "abc"}))
    staged = staging.stage_orders(raw)
    assert staged.good.count() == 0 and staged.bad.count() == 1


def test_strict_raises(spark):
    raw = raw_orders(spark, (1, GOOD), (1, GOOD | {"order_id": "Q", "quantity": "abc"}))
    with pytest.raises(Exception, match="Q: quantity missing or not an integer"):
        staging.stage_orders(raw, strict=True).good.collect()
    assert staging.stage_orders(raw_orders(spark, (1, GOOD)), strict=True).good.count() == 1


def raw_events(spark, *rows):
    data = [("f", dt.datetime(2024, 3, 4, hour), ",".join(map(str, r)), *r, DAY) for hour, r in rows]
    return spark.createDataFrame(
        data, "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_line STRING, event_id STRING, user_id STRING, "
              "product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, run_date DATE")


TS = dt.datetime(2024, 3, 3, 23)


def test_events_are_cleaned_and_deduplicated(spark):
    raw = raw_events(
        spark, (1, ("E1", "U1", "", "PAGE_VIEW", TS)), (2, ("E1", "U2", "P1", "Purchase", TS)),
        (1, ("E2", "U1", "", "PAGE_VIEW", TS)), (1, ("E3", "", "P1", "hover", TS)))
    rows = {r.event_id: r for r in staging.stage_events(raw).good.collect()}
    assert (rows["E1"].user_id, rows["E1"].event_type) == ("U2", "purchase")
    assert rows["E2"].product_id is None and rows["E2"].event_type == "page_view"
    assert rows["E3"].user_id == "" and rows["E3"].event_type == "hover"
    assert rows["E2"].load_date == DAY and rows["E2"].event_ts == TS


def test_event_type_check_is_opt_in(spark):
    raw = raw_events(spark, (1, ("E1", "U1", "P", "hover", TS)), (1, ("E2", "U1", "P", "purchase", TS)))
    assert staging.stage_events(raw).good.count() == 2
    checked = staging.stage_events(raw, check_types=True)
    assert [r.event_id for r in checked.good.collect()] == ["E2"]
    assert reasons(checked) == {("E1", "event_type unknown", "hover")}


def test_events_without_required_fields(spark):
    raw = raw_events(spark, (1, ("E1", None, "P", "purchase", TS)), (1, ("E2", "U", "P", None, TS)),
                     (1, ("E3", "U", "P", "purchase", None)), (1, (None, "U", "P", "purchase", TS)))
    staged = staging.stage_events(raw)
    assert staged.good.count() == 0
    assert {(r, x) for r, x, _ in reasons(staged)} == {
        ("E1", "user_id missing"), ("E2", "event_type missing"), ("E3", "event_ts missing or unreadable"),
        (None, "event_id missing")}


def test_products(spark):
    docs = [(1, {"product_id": "P1", "product_name": "a", "current_price": 2.345}),
            (2, {"product_id": "P1", "product_name": "b", "brand": None, "current_price": -2.345}),
            (1, {"product_id": "P2", "current_price": "free"}), (1, {"product_name": "nameless"})]
    raw = raw_orders(spark, *docs).withColumnRenamed("ingested_at", "fetched_at").drop("file_name")
    staged = staging.stage_products(raw)
    row = staged.good.collect()
    assert len(row) == 1 and row[0].product_name == "b" and row[0].current_price == Decimal("-2.35")
    assert reasons(staged) == {("P2", "price out of range", "free"), (None, "product_id missing", None)}


def test_hot_key_sends_one_row_per_task(spark):
    """A third of the rows share one key; the group limit thins them before the shuffle."""
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = staging.keep_latest(rows, ["k"], [F.col("v").desc()])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    # Plans print top down: the per-task limit comes after (below) the exchange.
    assert plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")
    assert latest.filter("k = -1").collect()[0].v == n - 3
    assert latest.count() == n - n // 3 + 1
