"""Landed files and nested documents."""

import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from tidemart.operators import staging
from tidemart.sources import documents, landing

DAY = "2024-03-04"  # a Monday


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_missing_files_give_no_rows(spark, tmp_path):
    root = str(tmp_path)
    for kind, reader in (("orders", landing.read_orders), ("events", landing.read_events),
                         ("products", landing.read_products)):
        df = reader(spark, landing.landing_path(root, kind, DAY), DAY)
        assert df.count() == 0
        assert "run_date" in df.columns


def test_pretty_printed_array_keeps_whole_documents(spark, tmp_path):
    docs = [{"order_id": "A", "price": 1.5, "extra": {"x": [1, 2]}, "note": None}, {"order_id": "B"}]
    path = write(tmp_path / "incoming/orders" / DAY / "orders.json", json.dumps(docs, indent=2))
    rows = landing.read_orders(spark, landing.landing_path(str(tmp_path), "orders", DAY), DAY, whole_file=True).collect()
    assert [json.loads(r.raw_json) for r in rows] == docs
    assert {r.run_date for r in rows} == {dt.date(2024, 3, 4)}
    assert all(path in r.file_name for r in rows)


def test_single_object_is_one_document(spark, tmp_path):
    path = write(tmp_path / "one.json", json.dumps({"product_id": "P1"}, indent=1))
    assert [json.loads(r.raw_json) for r in
            landing.read_products(spark, path, DAY, whole_file=True).collect()] == [{"product_id": "P1"}]


def test_json_lines_mix_objects_and_arrays(spark, tmp_path):
    path = write(tmp_path / "lines.json", '{"order_id":"A"}\n[{"order_id":"B"},{"order_id":"C"}]\n')
    ids = {json.loads(r.raw_json)["order_id"] for r in landing.read_orders(spark, path, DAY).collect()}
    assert ids == {"A", "B", "C"}


def test_unreadable_lines_are_kept_for_quarantine(spark, tmp_path):
    path = write(tmp_path / "lines.json", '{"order_id":"A"}\n\n  \n{"order_id":\n[{"order_id":"B"}\nnonsense\n')
    rows = landing.read_orders(spark, path, DAY)
    assert sorted(r.raw_json for r in rows.collect()) == sorted(
        ['{"order_id":"A"}', '{"order_id":', '[{"order_id":"B"}', "nonsense"])
    staged = staging.stage_orders(rows)
    assert staged.bad.filter("failure_reason = 'order_id missing'").count() == 3


def test_event_csv_by_header_name(spark, tmp_path):
    text = ("user_id,event_id,event_type,event_ts,product_id,agent\n"
            'U1,E1,PAGE_VIEW,2024-03-04T01:02:03,,"Browser, 1"\n'
            "U2,,purchase,2024-03-04 05:06:07,P9,app\n"
            "U3,E3,purchase,yesterday,P9,app\n")
    path = write(tmp_path / "events.csv", text)
    rows = {r.user_id: r for r in landing.read_events(spark, path, DAY).collect()}
    assert rows["U1"].event_id == "E1"
    assert rows["U1"].product_id == ""
    assert rows["U1"].event_ts == dt.datetime(2024, 3, 4, 1, 2, 3)
    assert rows["U1"].raw_line == "U1,E1,PAGE_VIEW,2024-03-04T01:02:03,,Browser, 1"
    line = "U2,,purchase,2024-03-04 05:06:07,P9,app"
    assert rows["U2"].raw_line == line
    assert rows["U2"].event_id == hashlib.md5(line.encode()).hexdigest()
    assert rows["U3"].event_ts is None and "yesterday" in rows["U3"].raw_line


def test_weekly_snapshot_day():
    assert landing.is_weekly_snapshot_day("2024-03-04")
    assert not landing.is_weekly_snapshot_day(dt.date(2024, 3, 5))


def test_first_available(spark):
    empty, full, other = (spark.createDataFrame(rows, "a INT") for rows in ([], [(1,)], [(2,)]))
    assert landing.first_available(empty, full, other).collect()[0].a == 1
    assert landing.first_available(empty, empty, other).collect()[0].a == 2


def carts(spark):
    docs = [
        {"id": 7, "userId": 3, "date": "2024-03-01T10:00:00", "total": 10, "products":
            [{"productId": 5, "quantity": 2, "price": 1.25}, {"id": 6, "quantity": 1, "price": 3}]},
        {"id": 8, "products": []},
    ]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw_json STRING")
    return documents.parse_documents(raw, documents.CART_SCHEMA)


def test_carts_to_orders_defaults(spark):
    rows = {r.order_id: r for r in documents.carts_to_orders(carts(spark)).collect()}
    assert rows["CART_7"].user_id == "3" and rows["CART_7"].total == 10.0 and len(rows["CART_7"].products) == 2
    assert rows["CART_8"].user_id == "unknown" and rows["CART_8"].discounted_total == 0.0
    assert rows["CART_8"].status == "completed"


def test_cart_items_become_events_and_lines(spark):
    events = {r.event_id: r for r in documents.cart_events(carts(spark), DAY).collect()}
    assert set(events) == {f"EVT_{DAY}_addcart_5_7_1", f"EVT_{DAY}_addcart_6_7_2"}
    assert all(e.event_type == "add_to_cart" and e.user_id == "3" for e in events.values())
    lines = {r.order_id: r for r in documents.cart_order_lines(carts(spark)).collect()}
    assert lines["CART_7-1"].product_id == "5" and lines["CART_7-2"].product_id == "6"
    assert lines["CART_7-1"].price == "1.25" and lines["CART_7-1"].quantity == "2"


def test_derived_event_ids_are_unique(spark):
    catalog = spark.createDataFrame([(i, f"t{i}") for i in range(25)], "id BIGINT, title STRING")
    events = documents.derived_events(catalog, carts(spark), DAY)
    assert events.count() == 27 and events.select("event_id").distinct().count() == 27
    users = {r.product_id: r.user_id for r in documents.view_events(catalog, DAY).collect()}
    assert users["0"] == "1" and users["9"] == "10" and users["10"] == "1"


def test_catalog_defaults(spark):
    docs = [{"id": 1, "title": "a", "description": "d", "price": 2, "rating": {"rate": 4.5, "count": 9}, "stock": 3},
            {"id": 2, "title": "b", "description": "e", "price": 1.5, "category": "c", "brand": "z"}]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw_json STRING")
    rows = {r.product_id: r for r in documents.normalize_catalog(
        documents.parse_documents(raw, documents.CATALOG_SCHEMA)).collect()}
    assert (rows["1"].category, rows["1"].rating, rows["1"]["count"], rows["1"].stock) == ("uncategorized", 4.5, 9, 3)
    assert (rows["2"].category, rows["2"].brand, rows["2"].rating, rows["2"]["count"]) == ("c", "z", 0.0, 0)


def test_documents_to_raw_rows(spark):
    raw = documents.to_raw_events(documents.cart_events(carts(spark), DAY), "carts", DAY, F.lit("2024-03-04"))
    row = raw.filter(F.col("product_id") == "5").collect()[0]
    assert json.loads(row.raw_line)["event_id"] == row.event_id
    assert set(raw.columns) >= {"run_date", "file_name", "ingested_at", "raw_line", "event_id", "event_ts"}


def test_csv_columns_go_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_id,user_id,product_id,event_type,event_ts\nE1,U1,P1,view,2024-03-04T10:00:00\n")
    (tmp_path / "b.csv").write_text("user_id,extra,event_id,event_type,event_ts,product_id\nU2,x,E2,view,2024-03-04T10:00:00,P2\n")
    rows = landing.read_events(spark, str(tmp_path), "2024-03-04").collect()
    assert sorted((r.event_id, r.user_id, r.product_id, r.raw_line) for r in rows) == [
        ("E1", "U1", "P1", "E1,U1,P1,view,2024-03-04T10:00:00"), ("E2", "U2", "P2", "U2,x,E2,view,2024-03-04T10:00:00,P2")]
