"""Many days in one plan against the same days one after the other."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemart.operators.store import TableStore
from tidemart.plans import backfill, daily
from tidemart.schemas import CONTRACTS
from tidemart.sources import landing

OPTIONS = {"as_of": dt.datetime(2024, 4, 1, 12), "orders_range": (3, 1000), "events_range": (3, 1000)}
# What depends on the clock or on the delivery, not on the data.
VOLATILE = {"ingested_at", "fetched_at", "runtime_seconds"}


def land(root, day, orders, events, products=None, header="event_id,user_id,product_id,event_type,event_ts"):
    base = root / "incoming"
    (base / "orders" / day).mkdir(parents=True)
    (base / "orders" / day / "a.json").write_text("\n".join(json.dumps(o) for o in orders))
    (base / "events" / day / "part").mkdir(parents=True)
    names = header.split(",")
    lines = [",".join(str(e.get(n, "")) for n in names) for e in events]
    (base / "events" / day / "part" / "e 1+.csv").write_text("\n".join([header, *lines]) + "\n")
    if products is not None:
        (base / "products").mkdir(parents=True, exist_ok=True)
        (base / "products" / f"products_{day}.json").write_text(json.dumps(products))


def order(i, day, user, product, **changes):
    return {"order_id": f"O{i}", "user_id": user, "product_id": product, "quantity": 2, "price": 1.25,
            "timestamp": f"{day}T10:00:00", "status": "paid"} | changes


def event(i, day, user, product="P1", kind="purchase"):
    return {"event_id": f"E{i}", "user_id": user, "product_id": product, "event_type": kind, "event_ts": f"{day}T11:00:00", "channel": "web"}


def product(i, price, **changes):
    return {"product_id": f"P{i}", "product_name": f"n{i}", "category": "c", "brand": "b", "current_price": price} | changes


def landed(root):
    """Six days: users and products that come late, a failing day with a catalogue, a day without files."""
    days = [str(dt.date(2024, 3, 4) + dt.timedelta(days=n)) for n in range(6)]
    catalogues = {0: [product(i, 5) for i in range(5)], 2: [product(i, 99) for i in range(9)],
                  4: [product(i, 5 if i < 3 else 7) for i in range(1, 7)] + [product(1, 5)], 5: [product(i, 7) for i in range(2, 8)]}
    for n, day in enumerate(days):
        if n == 3:
            continue
        # User Un buys from day n on, P<n> is asked for long before its first catalogue.
        orders = [order(f"{n}-{i}", day, f"U{i}", f"P{i % 9}") for i in range(2 * n + 3)]
        orders += [order(f"{n}-0", day, "U0", "P0", status="pending"), order(f"x{n}", day, "U1", "P1", quantity="many")]
        if n == 2:  # a day that fails, whose users and catalogue are never loaded
            orders.append(order("neg", day, "U40", "P1", price=-3))
        if n == 4:
            orders.append(order("late", "2023-01-05", "U1", "P1"))
            orders.append(order("1-1", day, "U1", "P1"))  # an order of another day again
        events = [event(f"{n}-{i}", day, f"U{i}") for i in range(2 * n + 6)] + [event(f"{n}-0", day, "U0", kind="VIEW"), event(f"{n}-z", day, "U40")]
        header = "event_id,user_id,product_id,event_type,event_ts" if n % 2 else "user_id,channel,event_ts,event_type,event_id,product_id"
        land(root, day, orders, events, catalogues.get(n), header)
    return days


def contents(store):
    found = {}
    for name in CONTRACTS:
        if name != "audit.pipeline_runs":
            rows = store.read(name)
            found[name] = sorted(str(r) for r in rows.drop(*VOLATILE).collect())
    return found


def differences(one, other):
    return {name: (sorted(set(one[name]) - set(other[name]))[:3], sorted(set(other[name]) - set(one[name]))[:3])
            for name in one if one[name] != other[name]}


def test_days_at_once_equal_days_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "is_weekly_snapshot_day", lambda day: True)  # more catalogues in fewer days
    days = landed(tmp_path)
    attributes = spark.createDataFrame([("U1", "Rome"), ("U13", "Oslo"), ("U99", "Bern")], "user_id STRING, city STRING")
    options = OPTIONS | {"user_attributes": attributes}
    slow, fast = (TableStore(spark, str(tmp_path / t), buckets=4) for t in ("slow", "fast"))
    # Both start from a first day that was loaded before.
    for store in (slow, fast):
        daily.run_daily(store, str(tmp_path), days[0], **options)
    one_by_one = daily.backfill(slow, str(tmp_path), days[1], days[-1], **options)
    passed = backfill.backfill_days(fast, str(tmp_path), days[1], days[-1], **options)
    assert passed == {d: not isinstance(r, Exception) for d, r in one_by_one.items()}
    assert [d for d, ok in passed.items() if not ok] == [days[2], days[3]]
    assert differences(contents(slow), contents(fast)) == {}
    assert fast.read("warehouse.dim_product_history").count() > fast.read("warehouse.dim_product").count()
    failed = fast.read("audit.pipeline_runs").filter("status <> 'success'")
    assert failed.filter(F.col("run_date") == days[-1]).count() == 0

    # A day again: users and products are known from the beginning by now.  (Not one with a catalogue: one
    # from before a product's open version leaves its history alone here.)
    assert backfill.backfill_days(fast, str(tmp_path), days[1], days[1], **options) == {days[1]: True}
    daily.run_daily(slow, str(tmp_path), days[1], **options)
    assert differences(contents(slow), contents(fast)) == {}


def test_one_scan_for_all_days(spark, tmp_path):
    days = landed(tmp_path)
    for kind in ("orders", "events"):
        rows = landing.read_days(spark, str(tmp_path), kind, days[0], days[4])
        assert {str(r.run_date) for r in rows.select("run_date").distinct().collect()} == {*days[:3], days[4]}
        scans = rows._jdf.queryExecution().executedPlan().toString().count("FileScan")
        # Events: one scan for each of the two column orders.
        assert scans == {"orders": 1, "events": 2}[kind]
    products = landing.read_days(spark, str(tmp_path), "products", days[0], days[-1])
    assert {str(r.run_date) for r in products.select("run_date").distinct().collect()} == {days[0]}  # the only Monday


def test_nothing_landed_and_no_days(store, tmp_path):
    assert backfill.backfill_days(store, str(tmp_path), "2024-03-05", "2024-03-04") == {}
    assert backfill.backfill_days(store, str(tmp_path), "2024-03-04", "2024-03-05") == {"2024-03-04": False, "2024-03-05": False}
    assert store.read("warehouse.daily_metrics").count() == 2 and store.read("audit.dq_failures").count() == 4


def test_headers_are_found_in_tasks(spark, tmp_path):
    folder = tmp_path / "day"
    (folder / "a b").mkdir(parents=True)
    (folder / "a b" / "1+2.csv").write_bytes(b"\xef\xbb\xbfx,y\n1,2\n3,4\n")
    (folder / "2.csv").write_text("y,x\n")
    (folder / "3.csv").write_text("x,y\n5,6")
    (folder / "4.csv").write_text("")
    groups = landing.files_by_header(spark, [str(folder)])
    assert {h: sorted(f.rsplit("/", 1)[1] for f in files) for h, files in groups.items()} == {"x,y": ["1+2.csv", "3.csv"], "y,x": ["2.csv"]}
    # A file of many blocks: only the first block has the header.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        (folder / "5.csv").write_text("p,q\n" + "7,8\n" * 3000)
        assert len(landing.files_by_header(spark, [str(folder)])["p,q"]) == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
