"""Table store, daily job, SQL access and streams."""

import datetime as dt
import json
import re
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemart.operators import dimensions, quality
from tidemart.operators.store import TableStore
from tidemart.plans import daily, funnel, products, revenue
from tidemart.plans.warehouse import StoredWarehouse
from tidemart.sources import documents
from tidemart.streaming import ingest

DAY1, DAY2 = "2024-03-04", "2024-03-05"


def events_of(spark, *rows):
    """(event_id, load_date) rows in the shape of staging.events_clean."""
    data = [(i, "U1", None, "purchase", dt.datetime(2024, 3, 4), None, None, dt.date.fromisoformat(d)) for i, d in rows]
    return spark.createDataFrame(
        data, "event_id STRING, user_id STRING, product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, "
              "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, load_date DATE")


def ids(df):
    return sorted((r.event_id, str(r.load_date)) for r in df.collect())


def test_reading_a_table_that_does_not_exist(store):
    assert not store.exists("staging.events_clean") and not store.exists("warehouse.dim_user")
    assert store.read("staging.events_clean").count() == 0
    assert store.read("warehouse.dim_user").columns[0] == "user_id"


def test_day_reload_is_idempotent_and_can_empty_a_day(spark, store):
    name = "staging.events_clean"
    both = events_of(spark, ("A", DAY1), ("B", DAY1), ("C", DAY2))
    assert store.reload_days(name, both) == 3
    assert store.reload_day(name, events_of(spark, ("A", DAY1)), DAY1) == 1
    assert store.reload_day(name, events_of(spark, ("A", DAY1)), DAY1) == 1
    assert ids(store.read(name)) == [("A", DAY1), ("C", DAY2)]
    assert store.reload_day(name, both.filter("false"), DAY1) == 0
    assert ids(store.read(name)) == [("C", DAY2)]
    store.reload_days(name, events_of(spark, ("D", DAY1)), [dt.date(2024, 3, 4), dt.date(2024, 3, 5)])
    assert ids(store.read(name)) == [("D", DAY1)]
    store.truncate(name)
    assert store.read(name).count() == 0


def test_append_only_adds(spark, store):
    rows = spark.createDataFrame(
        [("f", dt.datetime(2024, 3, 4), "{}", dt.date(2024, 3, 4))],
        "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")
    assert store.append("raw.orders_json", rows) == 1
    assert store.append("raw.orders_json", rows) == 1
    assert store.read("raw.orders_json").count() == 2


def test_keyed_tables_merge_over_themselves(spark, store):
    name = "warehouse.dim_user"
    for city in ("Rome", "Oslo", "Bern", "Wien"):
        rows = spark.createDataFrame([("U1", city), (city, city)], "user_id STRING, city STRING")
        store.upsert(name, rows)
    found = {r.user_id: r.city for r in store.read(name).collect()}
    assert found == {"U1": "Wien", "Rome": "Rome", "Oslo": "Oslo", "Bern": "Bern", "Wien": "Wien"}
    store.upsert(name, rows)
    assert store.scalar(store.read(name).agg(F.count("*"))) == 5
    store.truncate(name)
    assert store.read(name).count() == 0 and store.exists(name)
    store.upsert(name, rows)
    assert store.read(name).count() == 2


def metrics_of(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d), n) for n, d in enumerate(days)], "run_date DATE, runtime_seconds BIGINT")


def test_versions_of_an_unbucketed_table_stay_for_a_while(spark, store):
    name = "warehouse.daily_metrics"
    for n in range(4):
        store.upsert(name, metrics_of(spark, DAY1, f"2024-02-0{n + 1}"))
    assert len(store._versions(name)) == 4 and store.read(name).count() == 5
    store.kept_for = dt.timedelta(0)
    store.upsert(name, metrics_of(spark, DAY1))
    assert len(store._versions(name)) <= 2 and store.read(name).count() == 5


def test_unfinished_version_is_ignored(spark, store, tmp_path):
    store.upsert("warehouse.daily_metrics", metrics_of(spark, DAY1))
    broken = tmp_path / "tables/warehouse/daily_metrics/v=00000099"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_bytes(b"half a file")
    assert store.read("warehouse.daily_metrics").count() == 1


def bucket_files(store, name):
    root = Path(store._bucket_root(name)[0])
    return {p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")) for p in root.glob("bucket=*")}


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, store):
    name = "warehouse.dim_user"
    store.buckets = 16
    users = spark.range(2000).selectExpr("CONCAT('U', id) AS user_id", "'Rome' AS city")
    store.upsert(name, users)
    before = bucket_files(store, name)
    assert len(before) == 16
    store.buckets = 7  # a table keeps the number it was created with
    few = spark.createDataFrame([("U5", "Oslo"), ("new", "Bern")], "user_id STRING, city STRING")
    touched = {r.b for r in few.select(store._bucket(name).alias("b")).collect()}
    written = store.upsert(name, few)
    after = bucket_files(store, name)
    changed = {int(b.removeprefix("bucket=")) for b in after if after[b] != before[b]}
    assert changed == touched and written < 2000 / 3
    assert store.read(name).count() == 2001
    assert {r.user_id: r.city for r in store.read(name).filter("city <> 'Rome'").collect()} == {"U5": "Oslo", "new": "Bern"}
    plan = store.read_touched(name, {None: sorted(touched)})._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert store.upsert(name, few.limit(0)) == 0


def test_a_merge_that_died_while_replacing_is_finished(spark, store, monkeypatch):
    name = "warehouse.dim_user"
    rows = spark.createDataFrame([(f"U{i}", "Rome") for i in range(50)], "user_id STRING, city STRING")
    store.upsert(name, rows)
    # The driver dies after the new rows were written aside: nothing was replaced yet, or half of it.
    for wreck in (lambda root: None, lambda root: [f.unlink() for p in sorted(root.glob("bucket=*"))[:2] for f in p.glob("*")]):
        moved = rows.withColumn("city", F.lit("Oslo"))
        with monkeypatch.context() as m:
            m.setattr(type(store), "_recover", lambda self, name: None)
            store.upsert(name, moved)
        wreck(Path(store._bucket_root(name)[0]))
        TableStore(spark, store.root).recover()
        assert {r.city for r in store.read(name).collect()} == {"Oslo"} and store.read(name).count() == 50
        store.upsert(name, rows)
    # One that died earlier never counted.
    half = Path(store._pending(name, "part"))
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half a file")
    store.upsert(name, rows.limit(1))
    assert store.read(name).count() == 50 and not half.exists()


def test_a_hash_bucketed_history_keeps_its_versions(spark, store):
    name = "warehouse.dim_product_history"

    def snapshot(day, price, n):
        return spark.range(n).selectExpr(
            "CONCAT('P', id) AS product_id", "'n' AS product_name", "'c' AS category", "'b' AS brand",
            f"CAST({price} AS DECIMAL(10,2)) AS current_price", "1 AS stock", "CAST(0 AS DECIMAL(12,2)) AS discount_percentage",
            f"DATE '{day}' AS load_date")

    for day, price, n in ((DAY1, 1, 30), (DAY2, 2, 3)):
        rows = snapshot(day, price, n)
        store.merge(name, rows, lambda current: dimensions.load_product_history(current, rows, day))
    found = store.read(name)
    assert found.count() == 33 and found.filter("effective_to IS NULL").count() == 30
    assert {(r.product_id, str(r.effective_to)) for r in found.filter("effective_to IS NOT NULL").collect()} == \
        {(f"P{i}", DAY2) for i in range(3)}


def land(root, day, n_orders, n_events, products=None, orders=()):
    base = root / "incoming"
    docs = [{"order_id": f"{day}-{i}", "user_id": f"U{i % 40}", "product_id": f"P{i % 10}", "quantity": 2,
             "price": 1.5, "timestamp": f"{day}T10:00:00", "status": "paid"} for i in range(n_orders)]
    (base / "orders" / day).mkdir(parents=True, exist_ok=True)
    (base / "orders" / day / "orders.json").write_text("\n".join(json.dumps(d) for d in [*docs, *orders]))
    lines = ["event_id,user_id,product_id,event_type,event_ts"]
    lines += [f"{day}-e{i},U{i % 60},P{i % 10},PURCHASE,{day}T11:00:00" for i in range(n_events)]
    (base / "events" / day).mkdir(parents=True, exist_ok=True)
    (base / "events" / day / "events.csv").write_text("\n".join(lines) + "\n")
    if products is not None:
        (base / "products").mkdir(parents=True, exist_ok=True)
        (base / "products" / f"products_{day}.json").write_text(json.dumps([
            {"product_id": f"P{i}", "product_name": f"n{i}", "category": "c", "brand": "b", "current_price": 9.5}
            for i in range(products)]))


def test_daily_run_end_to_end(spark, store, tmp_path):
    land(tmp_path, DAY1, 120, 600, products=8, orders=[
        {"order_id": "bad", "user_id": "U1", "product_id": "P1", "quantity": "x", "price": 1,
         "timestamp": f"{DAY1}T10:00:00", "status": "paid"}])
    land(tmp_path, DAY2, 50, 600)
    result = daily.run_daily(store, str(tmp_path), DAY1)
    assert result.passed
    # Products 8 and 9 are not in the catalogue; events of users 40-59 have no orders.
    assert result.rows["staging.orders_clean"] == 120 and result.rows["warehouse.fact_orders"] == 96
    assert result.rows["warehouse.fact_events"] == 400
    assert result.rows["fact_orders rejected"] == 24 and result.rows["staging.orders_clean quarantined"] == 1
    assert store.read("audit.bad_records").count() == 1 + 24 + 200
    row = store.read("warehouse.daily_metrics").collect()[0]
    assert (row.raw_orders_count, row.staging_orders_count, row.fact_orders_count) == (121, 120, 96)
    assert (row.raw_events_count, row.staging_events_count, row.fact_events_count, row.dq_failed_count) == (600, 600, 400, 0)

    report = store.read("audit.constraint_report").collect()
    assert {r.table_name: r.checked for r in report} == {"staging.orders_clean": 120, "staging.events_clean": 600,
                                                         "warehouse.fact_orders": 96, "warehouse.fact_events": 400}
    assert "product_id references warehouse.dim_product" in {r.constraint_name for r in report}
    assert all(r.violations == 0 and str(r.run_date) == DAY1 for r in report)

    # Again: raw grows, everything behind it stays the same.
    again = daily.run_daily(store, str(tmp_path), DAY1)
    assert again.rows["warehouse.fact_orders"] == 96 and store.read("warehouse.fact_orders").count() == 96
    assert store.read("raw.orders_json").count() == 242 and store.read("staging.orders_clean").count() == 120
    assert store.read("audit.bad_records").count() == 225
    assert store.read("warehouse.daily_metrics").count() == 1
    assert store.read("warehouse.dim_product").count() == 8

    # Too few orders on the second day: the gate stops the loads, the evidence is kept.
    with pytest.raises(quality.QualityGateError):
        daily.run_daily(store, str(tmp_path), DAY2)
    failed = store.read("audit.dq_failures").collect()
    assert [(r.check_name, str(r.run_date)) for r in failed] == [("orders_volume", DAY2)]
    assert store.read("warehouse.fact_orders").filter(F.col("load_date") == DAY2).count() == 0
    metrics_row = store.read("warehouse.daily_metrics").filter(F.col("run_date") == DAY2).collect()[0]
    assert metrics_row.dq_failed_count == 1 and metrics_row.staging_orders_count == 50
    steps = {(r.task_id, r.status) for r in store.read("audit.pipeline_runs").filter(F.col("run_date") == DAY2).collect()}
    assert ("quality_checks", "failed") in steps and ("compute_metrics", "success") in steps
    assert not any(task.startswith("load_") for task, _ in steps)

    # Analytics and SQL over the stored tables.
    wh = StoredWarehouse(store)
    by_date = revenue.revenue_by_date(wh, DAY1).collect()
    assert len(by_date) == 1 and by_date[0].daily_revenue == Decimal("288.00") and by_date[0].order_count == 96
    store.publish()
    total = store.sql("SELECT SUM(revenue) AS r FROM warehouse.fact_orders WHERE status = :s", s="paid")
    assert store.scalar(total) == Decimal("288.00")
    assert store.sql("SELECT * FROM audit.pipeline_runs").count() > 10
    assert store.scalar(store.read("warehouse.mv_daily_orders_summary").agg(F.sum("units_sold"))) == 192


def test_alternative_sources_and_row_ids(spark, store, tmp_path):
    land(tmp_path, DAY1, 120, 600)  # no catalogue has landed on this Monday
    catalogue = spark.createDataFrame([(f"P{i}", "n") for i in range(10)], "product_id STRING, product_name STRING")
    asked = []

    def service(day):
        asked.append(day)
        return documents.to_raw_products(catalogue, day)

    run = daily.run_daily(store, str(tmp_path), DAY1, alternatives={
        "products": [lambda day: service(day).limit(0), service], "orders": [lambda day: spark.createDataFrame(
            [], "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")]})
    assert run.rows["raw.products_json"] == 10 and run.rows["warehouse.fact_orders"] == 120 and set(asked) == {DAY1}
    first = {r.order_id: (r.fact_orders_id, r.created_at) for r in store.read("warehouse.fact_orders", identified=True).collect()}
    daily.run_daily(store, str(tmp_path), DAY1)
    again = {r.order_id: (r.fact_orders_id, r.created_at) for r in store.read("warehouse.fact_orders", identified=True).collect()}
    assert {k: v[0] for k, v in first.items()} == {k: v[0] for k, v in again.items()}
    assert len({v[0] for v in first.values()}) == 120 and min(v[1] for v in again.values()) > max(v[1] for v in first.values())
    raw = store.read("raw.orders_json", identified=True)
    assert raw.count() == raw.select("raw_orders_id").distinct().count() == 240 and raw.filter("created_at IS NULL").count() == 0


def test_date_filter_reaches_the_scan(spark, store, tmp_path):
    land(tmp_path, DAY1, 100, 500, products=10)
    daily.run_daily(store, str(tmp_path), DAY1)
    wh = StoredWarehouse(store)
    for query in (revenue.revenue_by_date(wh, DAY1), products.product_performance(wh, DAY1), funnel.event_funnel(wh, DAY1)):
        plan = query._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "date_id" in line and "load_date" in line)
        assert re.search(r"PartitionFilters: \[[^\]]*date_id", scan), scan
    assert "EqualTo(status,paid)" in revenue.revenue_by_date(wh, DAY1)._jdf.queryExecution().executedPlan().toString()


def test_backfill_goes_on_after_a_stopped_day(store, tmp_path):
    land(tmp_path, DAY1, 100, 500, products=10)
    land(tmp_path, DAY2, 1, 500)
    results = daily.backfill(store, str(tmp_path), DAY1, DAY2)
    assert results[DAY1].passed and isinstance(results[DAY2], quality.QualityGateError)


def order_line(order_id, status, day=DAY1, **changes):
    return json.dumps({"order_id": order_id, "user_id": "U", "product_id": "P", "quantity": 1, "price": 2,
                       "timestamp": f"{day}T00:00:00", "status": status} | changes)


def test_stream_keeps_staging_current_over_several_calls(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()

    def poll():
        raw = ingest.order_stream(spark, str(landing))
        raw = raw.withColumn("run_date", F.get_json_object("raw_json", "$.timestamp").cast("timestamp_ntz").cast("date"))
        ingest.keep_orders_current(raw, store, checkpoint).awaitTermination()
        return {(r.order_id, r.status, str(r.load_date)) for r in store.read("staging.orders_clean").collect()}

    (landing / "1.json").write_text(order_line("A", "pending") + "\n" + order_line("B", "paid", DAY2) + "\n")
    assert poll() == {("A", "pending", DAY1), ("B", "paid", DAY2)}
    import time
    time.sleep(1.1)
    (landing / "2.json").write_text(order_line("A", "paid") + "\n[" + order_line("C", "paid") + "]\n")
    assert poll() == {("A", "paid", DAY1), ("C", "paid", DAY1), ("B", "paid", DAY2)}
    assert poll() == {("A", "paid", DAY1), ("C", "paid", DAY1), ("B", "paid", DAY2)}


def test_stream_ingest_appends_each_file_once(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = "event_id,user_id,product_id,event_type,event_ts\n"

    def poll():
        ingest.ingest_to_table(ingest.event_stream(spark, str(landing)), store, "raw.events_csv",
                               str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(r.event_id for r in store.read("raw.events_csv").collect())

    (landing / "1.csv").write_text(header + "E1,U,,page_view,2024-03-04T00:00:00\n")
    assert poll() == ["E1"]
    (landing / "2.csv").write_text(header + "E2,U,,page_view,2024-03-04T00:00:00\n")
    assert poll() == ["E1", "E2"] and poll() == ["E1", "E2"]


def test_late_rows_reach_the_facts(spark, store, tmp_path):
    land(tmp_path, DAY1, 120, 600, products=10)
    for kind, name in (("orders", "orders.json"), ("events", "events.csv")):
        path = tmp_path / "incoming" / kind / DAY1 / name
        path.write_text(path.read_text().replace(f"{DAY1}T1", "2024-03-02T1"))
    run = daily.run_daily(store, str(tmp_path), DAY1)
    assert run.rows["warehouse.fact_orders"] == 120
    assert {r.date_id for r in store.read("warehouse.fact_orders").select("date_id").distinct().collect()} == {20240302}
    # A reload with other days leaves none of the old ones behind.
    land(tmp_path, DAY1, 120, 600)
    daily.run_daily(store, str(tmp_path), DAY1)
    assert {r.date_id for r in store.read("warehouse.fact_orders").select("date_id").distinct().collect()} >= {20240304}


def test_published_views_survive_loads(spark, store, tmp_path):
    land(tmp_path, DAY1, 120, 600, products=10)
    daily.run_daily(store, str(tmp_path), DAY1)
    store.publish()
    users = store.scalar(store.sql("SELECT COUNT(*) FROM warehouse.dim_user"))
    for _ in range(3):
        daily.run_daily(store, str(tmp_path), DAY1)
    assert store.scalar(store.sql("SELECT COUNT(*) FROM warehouse.dim_user")) == users
    for layer in ("raw", "staging", "warehouse", "audit"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_volume_bounds_can_be_set(spark, store, tmp_path):
    orders = spark.range(500_001).selectExpr("CAST(id AS STRING) AS order_id", "CAST(1 AS DECIMAL(12,2)) AS revenue",
                                             "TIMESTAMP_NTZ '2024-03-04 10:00:00' AS order_ts", "DATE '2024-03-04' AS load_date")
    events = events_of(spark, *[(f"e{i}", DAY1) for i in range(500)])
    at = F.lit("2024-03-05").cast("timestamp_ntz")
    assert [r.check_name for r in quality.failures(quality.check_report(orders, events, DAY1, at)).collect()] == ["orders_volume"]
    assert quality.failures(quality.check_report(orders, events, DAY1, at, orders_range=(1, 10**9))).collect() == []
    land(tmp_path, DAY1, 3, 4, products=3)
    assert daily.run_daily(store, str(tmp_path), DAY1, orders_range=(1, 10), events_range=(1, 10)).passed


def test_errors_are_stored_whole(store, tmp_path):
    log = daily._RunLog(DAY1)
    with pytest.raises(ValueError):
        log.run("step", lambda: (_ for _ in ()).throw(ValueError("x" * 5000)))
    assert len(log.rows[0][7]) > 5000


def test_stream_and_batch_share_the_raw_table(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    header = "event_id,user_id,product_id,event_type,event_ts\n"
    (tmp_path / "in/a.csv").write_text(header + "E1,U1,P1,purchase,2024-03-04T10:00:00\n")
    stream = ingest.event_stream(spark, str(tmp_path / "in"))
    ingest.ingest_to_table(stream, store, "raw.events_csv", str(tmp_path / "check")).awaitTermination()
    one = store.read("raw.events_csv")
    assert store.append("raw.events_csv", one.withColumn("event_id", F.lit("E2"))) == 1
    assert sorted(r.event_id for r in store.read("raw.events_csv").collect()) == ["E1", "E2"]
    assert store.append("raw.events_csv", one, "again") == store.append("raw.events_csv", one, "again") == 1
    assert store.read("raw.events_csv").count() == 3
    (tmp_path / "in/b.csv").write_text("user_id,event_id,product_id,event_type,event_ts\nU1,E3,P1,purchase,2024-03-04T10:00:00\n")
    with pytest.raises(Exception, match="header"):
        ingest.ingest_to_table(stream, store, "raw.events_csv", str(tmp_path / "check")).awaitTermination()
