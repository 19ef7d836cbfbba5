"""All-time measures of users from parts, against a scan of the facts."""

import datetime as dt
import random
from decimal import Decimal

from tidemart.operators import lifetime
from tidemart.operators.store import TableStore
from tidemart.plans import customers
from tidemart.plans.warehouse import StoredWarehouse, Warehouse
from tidemart.schemas import CONTRACTS

FIRST = dt.date(2024, 3, 20)


def facts_of(spark, seed, days):
    """Facts with ids that recur on other days, under the same and under other users, paid and not."""
    rng = random.Random(seed)
    rows = {}
    for day in days:
        for _ in range(60):
            i, user = rng.randrange(150), rng.randrange(9)
            amount = None if rng.random() < 0.05 else Decimal(rng.randrange(10_000)) / 100
            rows[i, day] = (f"O{i}", f"U{user}", "P", int(day.strftime("%Y%m%d")), 1, amount,
                            dt.datetime.combine(day, dt.time(rng.randrange(24))), rng.choice(["paid", "paid", "pending"]), day)
    return spark.createDataFrame(list(rows.values()), CONTRACTS["warehouse.fact_orders"].ddl)


class Scan(Warehouse):
    def __init__(self, store):
        self.fact_orders = store.read("warehouse.fact_orders")
        self.dim_user = store.read("warehouse.dim_user")


def check(store):
    stored, scan = StoredWarehouse(store), Scan(store)
    assert "fact_orders" not in str(stored.user_orders().inputFiles())
    for query in (customers.top_customers, customers.repeat_customers, customers.marketing_source_performance,
                  lambda wh: customers.tenure_segments(wh, "2024-06-01")):
        assert [tuple(r) for r in query(stored).collect()] == [tuple(r) for r in query(scan).collect()]


def test_parts_follow_the_facts(spark, store):
    users = spark.createDataFrame(
        [(f"U{i}", "c", FIRST - dt.timedelta(days=40 * i), ("web", None, "shop")[i % 3]) for i in range(8)],
        "user_id STRING, city STRING, signup_date DATE, marketing_source STRING")
    store.upsert("warehouse.dim_user", users)
    days = [FIRST + dt.timedelta(days=n) for n in range(20)]

    def load(seed, some):
        store.reload_days("warehouse.fact_orders", facts_of(spark, seed, some), some)
        lifetime.refresh(store, some)
        check(store)

    load(1, days[:5])     # the first refresh takes all facts
    load(2, days[5:16])   # a month that was begun and the next, ids that recur across loads
    load(3, days[3:4])    # one day again: ids stop and start to recur
    load(4, days[18:])
    store.reload_day("warehouse.fact_orders", store.read("warehouse.fact_orders").limit(0), days[6])
    lifetime.refresh(store, [days[6]])
    check(store)
    assert store.read(lifetime.RECURRING).count() > 0


def test_a_refresh_that_died_keeps_the_other_days_of_its_month(spark, store, monkeypatch):
    days = [FIRST + dt.timedelta(days=n) for n in range(3)]
    store.reload_days("warehouse.fact_orders", facts_of(spark, 5, days), days)
    lifetime.refresh(store, days)
    with monkeypatch.context() as m:
        def die(self, contract, df):
            self._drop(f"{self.path(contract.name)}/{contract.partition}={FIRST}")
            raise RuntimeError("gone")
        m.setattr(TableStore, "_day_writer", die)
        try:
            lifetime.refresh(store, days[:1])
            raise AssertionError("should have stopped")
        except RuntimeError:
            pass
    store.recover()
    assert store.read(lifetime.PARTS).select("load_date").distinct().count() == 3
    store.upsert("warehouse.dim_user", spark.createDataFrame([("U1", "x")], "user_id STRING, city STRING"))
    check(store)
