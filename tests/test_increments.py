"""Orders merged delivery by delivery against loads of whole days."""

import datetime as dt
import json
import re
import time

from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, staging
from tidemart.operators.store import TableStore
from tidemart.plans import increments
from tidemart.streaming import ingest

DAYS = [dt.date(2024, 3, 4), dt.date(2024, 3, 5)]


def document(order_id, status="paid", user="U1", product="P1", day=DAYS[0], **changes):
    return json.dumps({"order_id": order_id, "user_id": user, "product_id": product, "quantity": 1, "price": 2,
                       "timestamp": f"{day}T10:00:00", "status": status} | changes)


def catalogue(spark, store):
    rows = spark.createDataFrame([(f"P{i}", "n", "c", "b", DAYS[0]) for i in range(3)],
                                 "product_id STRING, product_name STRING, category STRING, brand STRING, load_date DATE")
    rows = rows.withColumn("current_price", F.lit(1).cast("decimal(10,2)"))
    store.merge("warehouse.dim_product", rows, lambda current: dimensions.load_dim_product(current, rows))


def raw(spark, docs, day, hour, name="f"):
    rows = [(f"{name}{hour}", dt.datetime(2024, 3, 4, hour), d, day) for d in docs]
    return spark.createDataFrame(rows, "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")


def by_whole_days(store):
    """What a load of all days from raw gives."""
    staged = staging.stage_orders(store.read("raw.orders_json"))
    dims = [store.read(f"warehouse.{d}") for d in ("dim_date", "dim_product", "dim_user")]
    return staged, facts.load_fact_orders(staged.good, *dims), facts.reject_fact_orders(staged.good, *dims)


def rows(df):
    return sorted(str(r) for r in df.drop("created_at", "updated_at", "stage", "raw_data").collect())


def check(store):
    staged, fact, rejects = by_whole_days(store)
    assert rows(store.read("staging.orders_clean")) == rows(staged.good)
    assert rows(store.read("warehouse.fact_orders")) == rows(fact)
    bad = store.read("audit.bad_records")
    assert rows(bad.filter("stage = 'orders_clean'")) == rows(staged.bad)
    assert rows(bad.filter("stage = 'fact_orders'")) == rows(rejects)
    users = {r.user_id for r in staged.good.select("user_id").distinct().collect()}
    assert {r.user_id for r in store.read("warehouse.dim_user").collect()} >= users
    assert rows(facts.daily_orders_summary(store.read("warehouse.mv_daily_orders_summary"))) == \
        rows(facts.daily_orders_summary(facts.orders_summary_parts(fact)))


def test_deliveries_give_what_a_load_of_the_days_gives(spark, store):
    catalogue(spark, store)
    steps = [
        (DAYS[0], 8, [document(f"A{i}", "pending", f"U{i % 7}", f"P{i % 4}") for i in range(40)] + [document(None), "not json"]),
        # Later copies: some move to another date, one breaks a rule, one is older than what is there.
        (DAYS[0], 9, [document(f"A{i}", "paid", day=dt.date(2024, 3, 1)) for i in range(0, 40, 9)] + [document("A1", quantity="x"), document(None)]),
        (DAYS[1], 9, [document(f"A{i}", day=DAYS[1]) for i in range(5)]),
        (DAYS[0], 7, [document("A2", "stale"), document("B1")]),
        # What was broken is mended, what was known gets an unknown product.
        (DAYS[0], 10, [document("A1", "paid"), document("A3", product="P9"), document("A9", user="U50")]),
        (DAYS[0], 10, []),
    ]
    for n, (day, hour, docs) in enumerate(steps):
        store.append("raw.orders_json", raw(spark, docs, day, hour), f"d{n}")
        increments.merge_deliveries(store, DAYS)
        check(store)
    assert increments.merge_deliveries(store, DAYS) == 0
    facts_now = store.read("warehouse.fact_orders", identified=True)
    assert facts_now.select("fact_orders_id").distinct().count() == facts_now.count()
    # Rows that were not touched keep the time they were loaded at.
    assert facts_now.select("created_at").distinct().count() > 1
    assert {r.status for r in store.read("staging.orders_clean").filter("order_id = 'A2' AND load_date = '2024-03-04'").collect()} == {"pending"}


def test_merging_again_after_a_crash_changes_nothing(spark, store, monkeypatch):
    catalogue(spark, store)
    store.append("raw.orders_json", raw(spark, [document(f"A{i}") for i in range(9)] + [document(None)], DAYS[0], 8), "one")
    increments.merge_deliveries(store, DAYS)
    store.append("raw.orders_json", raw(spark, [document("A1", "paid", day=DAYS[1]), document(None), document("Z")], DAYS[0], 9), "two")
    for broken in ("_stage", "_refresh_facts"):
        with monkeypatch.context() as m:
            m.setattr(increments, broken, lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
            try:
                increments.merge_deliveries(store, DAYS)
                raise AssertionError("should have stopped")
            except RuntimeError:
                pass
    # The driver died while it replaced fact folders: they are finished from what was written aside.
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_day_writer", lambda self, contract, df: (_ for _ in ()).throw(RuntimeError("gone"))
                  if contract.name == increments.FACT else df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy(*contract.partitions).parquet(self.path(contract.name)))
        try:
            increments.merge_deliveries(store, DAYS)
            raise AssertionError("should have stopped")
        except RuntimeError:
            pass
    increments.merge_deliveries(store, DAYS)
    check(store)


def test_only_new_documents_are_parsed(spark, store, monkeypatch):
    catalogue(spark, store)
    parsed = []
    plain = staging.order_documents

    def watched(df):
        scan = next(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
        assert re.search(r"PartitionFilters: \[[^\]]*delivery", scan)
        parsed.append({r.file for r in df.select(F.input_file_name().alias("file")).distinct().collect()})
        return plain(df)

    monkeypatch.setattr(staging, "order_documents", watched)
    for n in range(3):
        store.append("raw.orders_json", raw(spark, [document(f"{n}-{i}") for i in range(20)], DAYS[0], 8 + n), f"d{n}")
        increments.merge_deliveries(store, DAYS)
    assert [{f"d{n}" for n in range(3) if any(f"delivery=d{n}/" in f for f in files)} for files in parsed] == [{"d0"}, {"d1"}, {"d2"}]
    # Untouched buckets of the latest documents keep their files.
    before = {str(p): p.stat().st_mtime_ns for p in _files(store)}
    store.append("raw.orders_json", raw(spark, [document("0-1", "paid")], DAYS[0], 20), "last")
    increments.merge_deliveries(store, DAYS)
    after = {str(p): p.stat().st_mtime_ns for p in _files(store)}
    assert len({p.rsplit("/", 1)[0] for p in before if after.get(p) == before[p]}) == 3


def _files(store):
    from pathlib import Path
    return list(Path(store._bucket_root(increments.LATEST)[0]).rglob("*.parquet"))


def test_stream_to_facts_over_polls_and_batches(spark, store, tmp_path):
    catalogue(spark, store)
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()

    def poll():
        stream = ingest.order_stream(spark, str(landing)).withColumn(
            "run_date", F.get_json_object("raw_json", "$.timestamp").cast("timestamp_ntz").cast("date"))
        increments.keep_facts_current(stream, store, checkpoint, scratch=str(tmp_path / "scratch")).awaitTermination()

    (landing / "1.json").write_text(document("A", "pending") + "\n" + document("B", day=DAYS[1]) + "\n")
    poll()
    check(store)
    time.sleep(1.1)
    store.append("raw.orders_json", raw(spark, [document("C"), document("A", "older")], DAYS[0], 1))
    (landing / "2.json").write_text(document("A", "paid") + "\n")
    poll()
    check(store)
    assert {(r.order_id, r.status) for r in store.read("warehouse.fact_orders").collect()} == {("A", "paid"), ("B", "paid"), ("C", "paid")}
    poll()
    check(store)
