"""Plans and results that have to hold when one key owns a third of the rows."""

import collections
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators import dimensions, facts, merge, quality, staging
from tidemart.plans import customers, funnel, health, products, registry, revenue
from tidemart.plans.warehouse import Warehouse
from tidemart.schemas import CONTRACTS

# Queries that run jobs while they are being built (files landed, streams).
BUILDS_FILES = {n for n in registry.QUERIES if n.startswith("stream_") or n.endswith("_scan")} | {"reload_day_idempotent", "backfill_days"}
N = 6_000
START = dt.datetime(2024, 3, 1)


@pytest.fixture
def no_small_sides(spark):
    """Joins as they are when no side is small, with skew splitting scaled down to the data."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # The plans must not depend on this: a session may not set it.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot(i, name):
    """Every third row belongs to one key."""
    return f"{name}0" if i % 3 == 0 else f"{name}{1 + i % 97}"


def order_rows():
    return [(f"O{i}", hot(i, "U"), hot(i, "P"), 1 + i % 4, Decimal(i % 700) / 4, START + dt.timedelta(hours=i % 700),
             ("paid", "pending")[i % 5 == 0], dt.date(2024, 3, 1)) for i in range(N)]


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    """A skewed star schema, stored so that scans have several splits."""
    base = str(tmp_path_factory.mktemp("skew"))
    columns = ("order_id STRING, user_id STRING, product_id STRING, quantity INT, revenue DECIMAL(12,2), "
               "order_ts TIMESTAMP_NTZ, status STRING, load_date DATE")
    orders = spark.createDataFrame(order_rows(), columns)
    kinds = ["page_view", "view_product", "add_to_cart", "checkout", "purchase"]
    events = spark.createDataFrame(
        [(f"E{i}", hot(i, "U"), hot(i, "P"), kinds[(i // 3) % 5], START + dt.timedelta(hours=i % 700)) for i in range(N)],
        "event_id STRING, user_id STRING, product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ")
    key = F.date_format
    out = Warehouse()
    frames = {
        "fact_orders": orders.withColumn("date_id", key("order_ts", "yyyyMMdd").cast("int")),
        "fact_events": events.withColumn("date_id", key("event_ts", "yyyyMMdd").cast("int")),
        "dim_user": spark.createDataFrame(
            [(f"U{i}", dt.date(2024, 1, 1) - dt.timedelta(days=i * 5), f"s{i % 4}" if i % 7 else None) for i in range(120)],
            "user_id STRING, signup_date DATE, marketing_source STRING"),
        "dim_product": spark.createDataFrame(
            [(f"P{i}", f"n{i}", f"c{i % 5}", f"b{i % 3}", Decimal(i)) for i in range(90)],
            "product_id STRING, product_name STRING, category STRING, brand STRING, current_price DECIMAL(10,2)"),
    }
    for name, df in frames.items():
        df.repartition(4).write.parquet(f"{base}/{name}")
        setattr(out, name, spark.read.parquet(f"{base}/{name}"))
    out.dim_date = dimensions.build_dim_date(spark, "2024-01-01", "2024-12-31")
    return out


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_has_a_cross_join_or_leaves_the_jvm(spark):
    for name in sorted(set(registry.QUERIES) - BUILDS_FILES):
        plan = registry.run(name, spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Expand"):
            assert word not in plan, f"{name}: {word}"


def test_hot_product_is_split_in_the_join(wh, no_small_sides):
    result = revenue.revenue_by_brand(wh, "2024-03-31", days=60)
    plan = final_plan(result)
    assert "skew=true" in plan
    want = collections.defaultdict(lambda: [0, Decimal(0)])
    for _, _, p, q, r, _, status, _ in order_rows():
        n = int(p[1:])
        if status == "paid" and n < 90:
            want[f"b{n % 3}"][0] += 1
            want[f"b{n % 3}"][1] += r
    assert {r.brand: [r.order_count, r.total_revenue] for r in result.collect()} == dict(want)


def test_hot_user_is_split_although_users_are_the_outer_side(wh, no_small_sides):
    result = customers.marketing_source_performance(wh)
    assert "skew=true" in final_plan(result)
    users, orders = collections.Counter(), collections.defaultdict(lambda: [0, Decimal(0)])
    source = {f"U{i}": f"s{i % 4}" if i % 7 else None for i in range(120)}
    users.update(source.values())
    for _, u, _, _, r, _, status, _ in order_rows():
        if status == "paid":
            orders[source[u]][0] += 1
            orders[source[u]][1] += r
    got = {r.marketing_source: (r.users_acquired, r.orders_from_source, r.revenue_from_source) for r in result.collect()}
    assert got == {s: (n, *orders[s]) for s, n in users.items()}


def test_hot_keys_in_fact_loads(spark, wh, no_small_sides):
    orders = wh.fact_orders.drop("date_id")
    some_products = wh.dim_product.filter("product_id < 'P5'")
    loaded = facts.load_fact_orders(orders, wh.dim_date, some_products, wh.dim_user)
    assert "skew=true" in final_plan(loaded)
    known = {f"P{i}" for i in range(90) if f"P{i}" < "P5"}
    assert loaded.count() == sum(1 for r in order_rows() if r[2] in known)
    rejected = facts.reject_fact_orders(orders, wh.dim_date, some_products, wh.dim_user)
    assert loaded.count() + rejected.select("record_id").distinct().count() == N


def test_joins_after_aggregation_see_each_product_once(wh, no_small_sides):
    for result in (products.product_performance(wh, "2024-03-31", 60), products.top_products_by_revenue(wh),
                   funnel.product_conversion(wh, "2024-03-31", 60)):
        plan = final_plan(result)
        join = plan.index("SortMergeJoin")
        assert "HashAggregate" in plan[join:], "the facts must be aggregated below the join"


def test_funnel_counts_users_of_a_hot_day_and_user(wh, no_small_sides):
    got = {r.event_type: (r.unique_users, r.total_events) for r in funnel.event_counts(wh).collect()}
    kinds = ["page_view", "view_product", "add_to_cart", "checkout", "purchase"]
    users, total = collections.defaultdict(set), collections.Counter()
    for i in range(N):
        users[kinds[(i // 3) % 5]].add(hot(i, "U"))
        total[kinds[(i // 3) % 5]] += 1
    assert got == {k: (len(users[k]), total[k]) for k in kinds}
    funnel_rows = funnel.event_funnel(wh, "2024-03-31", 60).collect()
    by_day = collections.defaultdict(lambda: collections.defaultdict(set))
    for i in range(N):
        by_day[(START + dt.timedelta(hours=i % 700)).date()][kinds[(i // 3) % 5]].add(hot(i, "U"))
    assert {r.event_date: r.page_viewers for r in funnel_rows} == {d: len(k["page_view"]) for d, k in by_day.items()}


def test_a_bad_source_with_most_of_the_rows(spark, no_small_sides):
    day = dt.date(2024, 3, 1)
    rows = [("t", f"id{i:05d}" if i % 3 else None, "bad" if i % 3 else "worse", None, None, "s", day) for i in range(3_000)]
    bad = spark.createDataFrame(rows, CONTRACTS["audit.bad_records"].ddl)
    got = {r.failure_reason: (r.bad_record_count, r.sample_ids) for r in health.bad_records_audit(bad, day).collect()}
    assert got == {"bad": (2000, [f"id{i:05d}" for i in (1, 2, 4, 5, 7)]), "worse": (1000, [])}
    plan = health.bad_records_audit(bad, day)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan


def test_one_order_id_with_a_third_of_the_copies(spark, no_small_sides):
    docs = spark.range(3_000).select(
        F.lit("f").alias("file_name"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ingested_at"),
        F.to_json(F.struct(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_id"),
            F.lit("U").alias("user_id"), F.lit("P").alias("product_id"), F.col("id").alias("quantity"),
            F.lit(1.5).alias("price"), F.lit("2024-03-01T00:00:00").alias("timestamp"), F.lit("paid").alias("status"),
        )).alias("raw_json"),
        F.lit("2024-03-01").cast("date").alias("run_date"))
    staged = staging.stage_orders(docs).good
    assert staged.count() == 2001
    assert staged.filter("order_id = 'HOT'").collect()[0].quantity == 2997
    report = quality.check_report(staged.unionByName(staged), spark.createDataFrame([], CONTRACTS["staging.events_clean"].ddl),
                                  only=["orders_no_duplicates"]).collect()
    assert [r.failed_count for r in report] == [2001]


def test_quarantine_reads_and_parses_once(spark):
    from tidemart.plans import registry

    plan = registry.run("quarantine_orders", spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1
    assert len([line for line in plan.splitlines() if "Relation" in line and "l_orderkey" in line]) == 1


def test_as_of_join_spreads_a_busy_product_of_many_versions(spark, no_small_sides):
    # A third of the sales go to one product whose price changes every three days.
    history = spark.range(1000).selectExpr(
        "'hot' AS product_id", "id AS version", "date_add(DATE '2015-01-01', CAST(id * 3 AS INT)) AS effective_from",
        "CASE WHEN id < 999 THEN date_add(DATE '2015-01-01', CAST(id * 3 + 3 AS INT)) END AS effective_to").unionByName(
        spark.range(50).selectExpr("CONCAT('P', id) AS product_id", "-id AS version", "DATE '2014-06-01' AS effective_from",
                                   "CAST(NULL AS DATE) AS effective_to"))
    sales = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CONCAT('P', id % 60) END AS product_id",
        "CASE WHEN id % 1000 <> 7 THEN TIMESTAMP_NTZ '2014-01-01 00:00:00' + make_dt_interval(CAST(id * 7919 % 3700 AS INT), CAST(id % 24 AS INT)) END AS at")
    joined = merge.as_of_version(sales, history, "product_id", "at")
    got = {r.id: r.version for r in joined.collect()}
    start, expected = dt.date(2015, 1, 1), {}
    for r in sales.collect():
        if r.at is None:
            continue
        if r.product_id == "hot" and r.at.date() >= start:
            expected[r.id] = min((r.at.date() - start).days // 3, 999)
        elif r.product_id != "hot" and int(r.product_id[1:]) < 50 and r.at.date() >= dt.date(2014, 6, 1):
            expected[r.id] = -int(r.product_id[1:])
    assert got == expected
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        share = [r.n for r in merge.as_of_version(sales, history, "product_id", "at")
                 .groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(share) == 8 and max(share) < 2 * sum(share) / 8
