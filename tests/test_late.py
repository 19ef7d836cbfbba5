"""Stream deduplication whose state expires, and the rows that come too late for it."""

import datetime as dt

from pyspark.sql import functions as F

from tidemart.operators import staging
from tidemart.streaming import ingest, late

HEADER = "event_id,user_id,product_id,event_type,event_ts\n"
DAY = "2024-04-01"


def land(folder, name, *events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{i},U,P,view,{at}\n" for i, at in events))


def poll(spark, store, tmp_path):
    events = ingest.event_stream(spark, str(tmp_path / "in")).withColumn("run_date", F.lit(DAY).cast("date"))
    return late.ingest_once(events, store, str(tmp_path / "stream"))


def held(query):
    """Ids in the state after each batch of a run."""
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_state_falls_and_late_rows_are_recovered(spark, store, tmp_path):
    days = [f"2024-03-{d:02d}T10:00:00" for d in range(1, 11)]
    land(tmp_path / "in", "1.csv", *[(f"A{i}", days[0]) for i in range(50)], *[(f"B{i}", days[1]) for i in range(5)])
    first = poll(spark, store, tmp_path)
    assert max(held(first)) == 55
    land(tmp_path / "in", "2.csv", *[(f"C{i}", days[6]) for i in range(3)], ("B1", days[1]))
    second = poll(spark, store, tmp_path)
    # The watermark has passed the first fifty and five: only the last day's ids are still held.
    assert held(second)[-1] == 3
    # Too old: one never seen and one copy; in time: a new one and a copy.
    land(tmp_path / "in", "3.csv", ("N1", days[0]), ("A1", days[0]), ("C4", days[6]), ("C1", days[6]), ("T", ""))
    third = poll(spark, store, tmp_path)
    assert held(third)[-1] == 4
    raw = [r.event_id for r in store.read("raw.events_csv").collect()]
    assert sorted(raw) == sorted([*[f"A{i}" for i in range(50)], *[f"B{i}" for i in range(5)], *[f"C{i}" for i in range(3)], "C4"])
    assert sorted(r.event_id for r in store.read("audit.late_events").collect()) == ["A1", "N1", "T"]

    assert late.recover_late(store, DAY) == late.recover_late(store, DAY) == 3
    assert late.recover_late(store, "2024-04-02") == 0
    staged = staging.stage_events(store.read("raw.events_csv"), DAY)
    assert sorted(r.event_id for r in staged.good.collect()) == sorted([*raw, "N1"])
    assert [r.failure_reason for r in staged.bad.collect()] == ["event_ts missing or unreadable"]


def test_a_replayed_batch_sees_the_same_watermark(spark, store):
    rows = [("s", 0, dt.datetime(2024, 3, 1), dt.date(2024, 4, 1)), ("s", 1, dt.datetime(2024, 3, 9), dt.date(2024, 4, 1)),
            ("s", 1, dt.datetime(2024, 3, 9), dt.date(2024, 4, 1)), ("other", 0, dt.datetime(2025, 1, 1), dt.date(2024, 4, 1))]
    assert late.reached(store, "s", 0) is None
    store.append("audit.stream_progress", spark.createDataFrame(rows, "stream STRING, batch_id BIGINT, max_event_ts TIMESTAMP_NTZ, run_date DATE"))
    assert [late.reached(store, "s", n) for n in (0, 1, 2)] == [None, dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 9)]
    edge = spark.createDataFrame([(dt.datetime(2024, 3, 8),), (dt.datetime(2024, 3, 8, 0, 0, 0, 1),), (None,)], "event_ts TIMESTAMP_NTZ")
    found = edge.select(late.in_time(late.reached(store, "s", 2), "1 day").alias("x")).collect()
    assert [r.x for r in found] == [False, True, False]
