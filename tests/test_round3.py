"""What the third round's findings asked for: records evaluated once, no shuffle of documents, scratch data taken away."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from tidemart.plans import health, increments, registry
from tidemart.streaming import ingest

DAY = dt.date(2024, 3, 4)


def document(n):
    return json.dumps({"order_id": f"o{n}", "user_id": "U1", "product_id": "P1", "quantity": 1, "price": 2.5,
                       "timestamp": "2024-03-04T10:00:00", "status": "paid"})


def raw(spark, count=5):
    rows = [("f", dt.datetime(2024, 3, 4, 1), document(n), DAY) for n in range(count)]
    return spark.createDataFrame(rows, "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bad_records_are_evaluated_once(spark, tmp_path):
    rows = [("t", f"id{n % 7}" if n % 5 else None, "reason", None, None, DAY) for n in range(40)]
    rows += [("t", None, "no ids", None, None, DAY)]
    spark.createDataFrame(rows, "source_table STRING, record_id STRING, failure_reason STRING, failed_value STRING,"
                                "raw_data STRING, run_date DATE").write.parquet(str(tmp_path / "bad"))
    audit = health.bad_records_audit(spark.read.parquet(str(tmp_path / "bad")), DAY)
    plan = final_plan(audit)
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
    assert [(r.failure_reason, r.bad_record_count, r.sample_ids) for r in audit.collect()] == [
        ("reason", 40, ["id0", "id1", "id2", "id3", "id4"]), ("no ids", 1, [])]


def test_a_micro_batch_is_delivered_without_a_shuffle(spark, store, monkeypatch):
    seen = []
    monkeypatch.setattr(store, "append", lambda name, df, delivery=None: seen.append(
        df._jdf.queryExecution().executedPlan().toString()))
    ingest.deliver(store, "raw.orders_json", raw(spark), 0)
    assert "Exchange" not in seen[0]


def test_one_day_is_reloaded_without_a_shuffle(spark, store, monkeypatch):
    plans, write = [], store._day_writer

    def watched(contract, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(contract, df)

    monkeypatch.setattr(store, "_day_writer", watched)
    users = spark.createDataFrame([("a",), ("b",)], "order_id STRING")
    day = users.select(*[(F.col("order_id") if c == "order_id" else F.lit(None).cast(kind)).alias(c) for c, kind in
                         (d.split(" ", 1) for d in store.contract("staging.orders_clean").column_definitions) if c != "load_date"],
                       F.lit(DAY).alias("load_date")).select(*store.contract("staging.orders_clean").column_names)
    store.reload_days("staging.orders_clean", day, [DAY])
    assert "Exchange" not in plans[0] and store.read("staging.orders_clean").count() == 2
    store.reload_days("staging.orders_clean", day, [DAY, DAY + dt.timedelta(days=1)])
    assert "Exchange" in plans[1] and store.read("staging.orders_clean").count() == 2


def test_stored_documents_are_compressed_well(spark, store):
    store.append("raw.orders_json", raw(spark), "load")
    files = list(Path(store.root).rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)


def test_landed_documents_are_compressed(spark, tmp_path):
    tables = registry.DriverTables(spark, "/root/testdata/sf0.001")
    registry._land_january(tables, str(tmp_path))
    files = [f for kind in ("orders", "events") for f in (tmp_path / "incoming" / kind).rglob("part-*")]
    assert files and all(f.name.endswith(".gz") for f in files)


def test_merging_leaves_no_scratch_data(spark, store, tmp_path):
    store.append("raw.orders_json", raw(spark), "first")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    assert increments.merge_deliveries(store, [DAY], scratch=str(tmp_path / "scratch")) == 5
    assert store.read("staging.orders_clean").count() == 5
    assert not list((tmp_path / "scratch").rglob("*.parquet"))
    assert spark.conf.get(key) == before


def test_lifetime_facts_evaluate_an_order_once(spark):
    tables = registry.DriverTables(spark, "/root/testdata/sf0.001")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(56)]
    rows = registry._lifetime_facts(tables, days)
    # Order lines and headers; the second loads are not a scan of their own.
    assert final_plan(rows.select("order_id", "load_date")).count("FileScan") == 2
    number = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("int")
    per_order = rows.groupBy("order_id").agg(F.count("*").alias("n"), F.count_distinct("load_date").alias("d"))
    third = F.when(number % 3 == 0, 2).otherwise(1)
    assert per_order.filter((F.col("n") != third) | (F.col("d") != third)).isEmpty()
    halves = sum(registry._lifetime_facts(tables, half).count() for half in (days[:30], days[30:]))
    assert halves == rows.count() > tables.fact_orders.count()
