"""Large merges, many days and restaged days: what is shuffled, written and met once."""

import datetime as dt
import json
import re

from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, staging
from tidemart.plans import backfill, increments

DAY = dt.date(2024, 3, 4)


def document(n, **changes):
    return json.dumps({"order_id": f"A{n}", "user_id": f"U{n % 3}", "product_id": f"P{n % 5}", "quantity": 1, "price": 2,
                       "timestamp": f"{DAY}T10:00:00", "status": "paid", "supplier": n} | changes)


def raw(spark, docs, hour=1):
    rows = [(f"f{hour}", dt.datetime(2024, 3, 4, hour), d, DAY) for d in docs]
    return spark.createDataFrame(rows, "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE")


def rows(df):
    return sorted(str(r) for r in df.drop("created_at", "updated_at", "stage").collect())


def shuffled(df):
    """The columns that go through each exchange of a plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)


def catalogue(spark, store):
    listed = spark.createDataFrame([(f"P{i}", "n", "c", "b", DAY) for i in range(4)],
                                   "product_id STRING, product_name STRING, category STRING, brand STRING, load_date DATE") \
        .withColumn("current_price", F.lit(1).cast("decimal(10,2)"))
    store.merge("warehouse.dim_product", listed, lambda current: dimensions.load_dim_product(current, listed))


def check(store):
    staged = staging.stage_orders(store.read("raw.orders_json"))
    dims = [store.read(f"warehouse.{d}") for d in ("dim_date", "dim_product", "dim_user")]
    bad = store.read("audit.bad_records")
    assert rows(store.read("staging.orders_clean")) == rows(staged.good)
    assert rows(bad.filter("stage = 'orders_clean'")) == rows(staged.bad)
    assert rows(store.read("warehouse.fact_orders")) == rows(facts.load_fact_orders(staged.good, *dims))
    assert rows(bad.filter("stage = 'fact_orders'")) == rows(facts.reject_fact_orders(staged.good, *dims))


def test_a_large_merge_meets_stale_and_broken_documents(spark, store, monkeypatch):
    catalogue(spark, store)
    monkeypatch.setattr(increments, "_MANY", 0)  # every delivery counts as a large one
    deliveries = [
        (5, [document(n) for n in range(20)] + [document(0, order_id=None), "not json"]),
        # Stale copies, one of them twice, a new order, some that break a rule, change the date or miss a product.
        (9, [document(2, quantity="x"), document(3, timestamp="2024-03-01T10:00:00"), document(6, product_id="P4")]),
    ]
    seen = []
    write = store.reload_days
    monkeypatch.setattr(store, "reload_days", lambda name, *a: seen.append(name) or write(name, *a))
    for n, (hour, docs) in enumerate(deliveries):
        store.append("raw.orders_json", raw(spark, docs, hour), f"d{n}")
        if n:
            store.append("raw.orders_json", raw(spark, [document(1, status="stale")] * 2 + [document(40)], 3), "old")
        increments.merge_deliveries(store, [DAY])
        check(store)
    # The first facts had no old ones to be told apart from.
    assert seen.count("warehouse.fact_orders") == 1


def test_orders_meet_the_dimensions_once(spark):
    ids = [("A", "U1", "P1"), ("B", "U1", "P9"), ("C", "U9", "P9"), ("D", "U2", "P1"), ("E", "U1", "P2")]
    orders = spark.createDataFrame(
        [(*i, 1, dt.datetime(2024, 3, 4, 10), "paid", DAY) for i in ids],
        "order_id STRING, user_id STRING, product_id STRING, quantity INT, order_ts TIMESTAMP_NTZ, status STRING, load_date DATE") \
        .withColumn("revenue", F.lit(1).cast("decimal(12,2)"))
    dates = spark.createDataFrame([(20240304,)], "date_id INT")
    # P1 came twice, P2 is known from a later day on.
    products = spark.createDataFrame([("P1", None), ("P1", None), ("P2", DAY + dt.timedelta(days=1))], "product_id STRING, known_from DATE") \
        .withColumn("known_from", F.coalesce("known_from", F.lit("0001-01-01").cast("date")))
    users = spark.createDataFrame([("U1",)], "user_id STRING")
    keys = [facts.dimension_keys(d, k) for d, k in ((dates, "date_id"), (products, "product_id"), (users, "user_id"))]
    checked = facts.check_orders(orders, *keys)
    assert rows(facts.passed_orders(checked)) == rows(facts.load_fact_orders(orders, dates, products, users))
    assert rows(facts.rejected_orders(checked)) == rows(facts.reject_fact_orders(orders, dates, products, users))
    assert len(rows(facts.rejected_orders(checked))) == 6


def test_replaced_buckets_are_moved_not_written_again(spark, store, monkeypatch):
    name = "warehouse.dim_user"
    users = spark.range(50).selectExpr("CONCAT('U', id) AS user_id", "'Rome' AS city")
    store.upsert(name, users)
    moves, drop = [], type(store)._drop

    def dies(self, source, target, levels):
        # The driver dies after the first bucket.
        first = sorted(self._folders(source))[0]
        moves.append(first)
        new, fs = self._fs(f"{source}/{first}")
        drop(self, f"{target}/{first}")
        fs.rename(new, self._fs(f"{target}/{first}")[0])
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(type(store), "_move_folders", dies)
        try:
            store.upsert(name, users.withColumn("city", F.lit("Oslo")))
            raise AssertionError("should have stopped")
        except RuntimeError:
            pass
    assert moves
    store.recover()
    assert {r.city for r in store.read(name).collect()} == {"Oslo"} and store.read(name).count() == 50


def test_only_broken_documents_carry_their_text_through_the_shuffle(spark, tmp_path):
    docs = [document(n % 4, quantity="x" if n % 4 == 1 else n) for n in range(12)] + [document(1, order_id=None)]
    raw(spark, docs).write.parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    ties = [F.get_json_object("raw_json", "$.supplier").cast("bigint").desc()]
    for tiebreak in (None, ties):
        staged = staging.stage_orders(stored, tiebreak=tiebreak)
        exchanges = shuffled(staged.typed)
        assert exchanges and not any("raw_json" in columns for columns in exchanges)
        assert {(r.record_id, json.loads(r.raw_data)["order_id"]) for r in staged.bad.collect()} == {("A1", "A1"), (None, None)}
        assert staged.good.count() == 3


def test_a_load_of_many_days_takes_what_it_wrote_aside_along(spark, store, tmp_path, monkeypatch):
    landed = tmp_path / "incoming" / "orders" / str(DAY)
    landed.mkdir(parents=True)
    (landed / "a.json").write_text("\n".join(document(n) for n in range(5)))
    scratch, held = tmp_path / "scratch", {}
    write = store.reload_days

    def watched(name, *args):
        held[name] = {p.name for p in scratch.glob("*/*")}
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
        return write(name, *args)

    monkeypatch.setattr(store, "reload_days", watched)
    passed = backfill.backfill_days(store, str(tmp_path), DAY, DAY, orders_range=(0, 9), events_range=(0, 9),
                                    as_of=dt.datetime(2024, 4, 1), scratch=str(scratch))
    assert passed == {str(DAY): True} and not list(scratch.glob("*"))
    # Staged rows are not kept beside staging, nor checked ones beside the facts.
    assert "checked" in held["warehouse.fact_orders"] and not any(n.startswith("typed") for n in held["warehouse.fact_orders"])
    assert "checked" not in held["audit.constraint_report"]
