"""DuckDB SQL for every registered query, over the same Parquet tables.

Written from the table definitions, not from the DataFrame code: money is summed as
integer cents and every rounded ratio is an exact integer division, so a result can be
compared bit by bit.
"""

from __future__ import annotations

# ---- building blocks -------------------------------------------------------------------


def half_up(numerator: str, denominator: str, places: int = 2) -> str:
    """numerator / denominator rounded half away from zero, in integer arithmetic."""
    scale = 10**places
    n = f"CAST(({numerator}) * {scale} AS HUGEINT)"
    d = f"CAST(NULLIF({denominator}, 0) AS HUGEINT)"
    return (f"(CAST(SIGN({n}) * ((2 * ABS({n}) + {d}) // (2 * {d})) AS DOUBLE) / {scale}.0)")


def cents_mean(cents: str, count: str, places: int = 2) -> str:
    """Average of a money column given as a sum of cents."""
    return half_up(cents, f"100 * ({count})", places)


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100.0)"


def day_key(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS BIGINT)"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def with_ctes(names: str, body: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they read."""
    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        for dep in CTES[name][0].split():
            need(dep)
        wanted.append(name)

    for name in names.split():
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in wanted) + "\n" + body


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' END"
_KIND = ("CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_product' "
         "WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'checkout' ELSE event_type END")
_NEWEST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"

_CALENDAR = f"""
SELECT {day_key('d')} AS date_id, CAST(d AS DATE) AS date, day(d) AS day, week(d) AS week, month(d) AS month,
       quarter(d) AS quarter, year(d) AS year, dayofweek(d) AS day_of_week, dayname(d) AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend"""

# name -> (CTEs it reads, SQL)
CTES: dict[str, tuple[str, str]] = {
    "lines": ("", f"""
        SELECT l.*, o_custkey, o_orderdate, o_orderpriority, {_STATUS} AS status,
               l_orderkey || '-' || l_linenumber AS order_id,
               CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS price_cents,
               CAST(o_orderdate AS DATE) AS run_date
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey"""),
    "latest": ("lines", f"""
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY {_NEWEST}) AS rn FROM lines) WHERE rn = 1"""),
    "fact": ("latest", f"""
        SELECT order_id, user_id, product_id, {day_key('o_orderdate')} AS date_id, quantity,
               quantity * price_cents AS cents, o_orderdate AS order_ts, status, run_date AS load_date
        FROM latest"""),
    "paid": ("fact", "SELECT * FROM fact WHERE status = 'paid'"),
    # a third of the orders loaded again on another day
    "twice": ("paid", """
        SELECT * FROM paid UNION ALL SELECT * FROM paid WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 3 = 0"""),
    "loaded": ("lines", """
        SELECT order_id, run_date AS load_date, o_orderdate AS order_ts,
               CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * quantity * price_cents AS cents FROM lines"""),
    "ev": ("", f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END AS product_id,
               {_KIND} AS event_type, ts AS event_ts, CAST(ts AS DATE) AS load_date,
               {day_key('ts')} AS date_id, event_type AS source_type, value, event_id AS n
        FROM events"""),
    "late": ("ev", "SELECT * REPLACE (CAST(load_date + CAST(n % 3 AS INTEGER) AS DATE) AS load_date) FROM ev"),
    "days": ("", f"""{_CALENDAR} FROM (
        SELECT range AS d FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 DAY)
        UNION ALL
        SELECT range AS d FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2025-01-01', INTERVAL 1 DAY))"""),
    "prod": ("", """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               p_brand AS brand, CAST(ROUND(CAST(p_retailprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS price_cents,
               p_size
        FROM part"""),
    "usr": ("", """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, n_name AS city, c_mktsegment AS marketing_source,
               (SELECT CAST(MIN(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "good": ("", "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_acctbal >= 0"),
    "fact_ok": ("fact prod good days", """
        SELECT f.* FROM fact f WHERE date_id IN (SELECT date_id FROM days)
          AND product_id IN (SELECT product_id FROM prod WHERE p_size <= 25)
          AND user_id IN (SELECT user_id FROM good)"""),
    "ev_ok": ("ev good days", """
        SELECT e.* FROM ev e WHERE date_id IN (SELECT date_id FROM days)
          AND user_id IN (SELECT user_id FROM good)"""),
    # quality
    "dq_counts": ("loaded ev", """
        SELECT run_date, SUM(orders) AS orders, SUM(order_dups) AS order_dups, SUM(negative) AS negative,
               SUM(orders_future) AS orders_future, SUM(events) AS events, SUM(event_dups) AS event_dups,
               SUM(events_future) AS events_future
        FROM (
          SELECT load_date AS run_date, COUNT(*) AS orders, COUNT(*) FILTER (WHERE cents < 0) AS negative,
                 COUNT(*) FILTER (WHERE order_ts > TIMESTAMP '2001-01-01') AS orders_future,
                 0 AS order_dups, 0 AS events, 0 AS event_dups, 0 AS events_future
          FROM loaded GROUP BY load_date
          UNION ALL BY NAME
          SELECT load_date AS run_date, COUNT(*) AS order_dups FROM (
            SELECT load_date, order_id FROM loaded GROUP BY ALL HAVING COUNT(*) > 1) GROUP BY 1
          UNION ALL BY NAME
          SELECT load_date AS run_date, COUNT(*) AS events,
                 COUNT(*) FILTER (WHERE event_ts > TIMESTAMP '2001-01-01') AS events_future
          FROM ev GROUP BY load_date
          UNION ALL BY NAME
          SELECT load_date AS run_date, COUNT(*) AS event_dups FROM (
            SELECT load_date, event_id FROM ev GROUP BY ALL HAVING COUNT(*) > 1) GROUP BY 1
        ) GROUP BY run_date"""),
    "dq_n": ("dq_counts", """
        SELECT run_date, CAST(COALESCE(orders, 0) AS BIGINT) AS orders, CAST(COALESCE(events, 0) AS BIGINT) AS events,
               CAST(COALESCE(order_dups, 0) AS BIGINT) AS order_dups,
               CAST(COALESCE(event_dups, 0) AS BIGINT) AS event_dups,
               CAST(COALESCE(negative, 0) AS BIGINT) AS negative,
               CAST(COALESCE(orders_future, 0) AS BIGINT) AS of, CAST(COALESCE(events_future, 0) AS BIGINT) AS ef
        FROM dq_counts"""),
    "dq_all": ("dq_n", """
        SELECT run_date, 'orders_volume' AS check_name, 'volume' AS check_type,
               orders NOT BETWEEN 100 AND 500000 AS failed, orders AS n,
               'Orders count ' || orders || ' outside range [100, 500000]' AS msg,
               '{"count":' || orders || ',"min":100,"max":500000}' AS det FROM dq_n
        UNION ALL SELECT run_date, 'events_volume', 'volume', events NOT BETWEEN 500 AND 2000000, events,
               'Events count ' || events || ' outside range [500, 2000000]',
               '{"count":' || events || ',"min":500,"max":2000000}' FROM dq_n
        UNION ALL SELECT run_date, 'orders_no_duplicates', 'uniqueness', order_dups > 0, order_dups,
               'Found ' || order_dups || ' duplicate order IDs', '{"duplicates":' || order_dups || '}' FROM dq_n
        UNION ALL SELECT run_date, 'events_no_duplicates', 'uniqueness', event_dups > 0, event_dups,
               'Found ' || event_dups || ' duplicate event IDs', '{"duplicates":' || event_dups || '}' FROM dq_n
        UNION ALL SELECT run_date, 'orders_revenue_valid', 'range', negative > 0, negative,
               'Found ' || negative || ' orders with negative revenue', '{"invalid_records":' || negative || '}'
               FROM dq_n
        UNION ALL SELECT run_date, 'timestamps_not_future', 'range', of + ef > 0, of + ef,
               'Found ' || (of + ef) || ' records with future timestamps',
               '{"orders":' || of || ',"events":' || ef || '}' FROM dq_n"""),
    "dq": ("dq_all", f"""
        SELECT {day_text('run_date')} AS run_date, check_name, check_type, CAST(failed AS BIGINT) AS failed,
               CASE WHEN failed THEN n ELSE 0 END AS failed_count,
               CASE WHEN failed THEN msg END AS failure_message, CASE WHEN failed THEN det END AS details,
               run_date AS d
        FROM dq_all"""),
    "dq_failed": ("dq", "SELECT * FROM dq WHERE failed = 1"),
    # run metrics
    "met": ("lines fact fact_ok ev ev_ok dq_failed", """
        SELECT run_date, CAST(SUM(a) AS BIGINT) AS raw_orders_count, CAST(SUM(b) AS BIGINT) AS staging_orders_count,
               CAST(SUM(c) AS BIGINT) AS fact_orders_count, CAST(SUM(e) AS BIGINT) AS raw_events_count,
               CAST(SUM(f) AS BIGINT) AS staging_events_count, CAST(SUM(g) AS BIGINT) AS fact_events_count,
               CAST(SUM(h) AS BIGINT) AS dq_failed_count,
               CAST(SUM(a) * 200 + SUM(e) AS BIGINT) AS runtime_seconds
        FROM (
          SELECT run_date, 1 AS a, 0 AS b, 0 AS c, 0 AS e, 0 AS f, 0 AS g, 0 AS h FROM lines
          UNION ALL SELECT load_date, 0, 1, 0, 0, 0, 0, 0 FROM fact
          UNION ALL SELECT load_date, 0, 0, 1, 0, 0, 0, 0 FROM fact_ok
          UNION ALL SELECT load_date, 0, 0, 0, 2, 1, 0, 0 FROM ev
          UNION ALL SELECT load_date, 0, 0, 0, 0, 0, 1, 0 FROM ev_ok
          UNION ALL SELECT d, 0, 0, 0, 0, 0, 0, 1 FROM dq_failed
        ) GROUP BY run_date"""),
    # defective documents
    "messy": ("lines", f"""
        SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE user_id END AS m_user,
               CASE WHEN l_tax = 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS m_quantity,
               CASE WHEN l_discount = 0.1 THEN price_cents * 10000 ELSE price_cents END AS m_cents,
               CASE WHEN l_returnflag = 'R' THEN 'unknown' END AS m_time
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY {_NEWEST}) AS rn
              FROM lines WHERE l_quantity <> 50) WHERE rn = 1"""),
    "bad_orders": ("messy lines", """
        SELECT order_id AS record_id, 'user_id missing' AS failure_reason, CAST(NULL AS VARCHAR) AS failed_value,
               run_date FROM messy WHERE m_user IS NULL
        UNION ALL SELECT order_id, 'quantity missing or not an integer', m_quantity, run_date
               FROM messy WHERE m_quantity = 'n/a'
        UNION ALL SELECT order_id, 'price missing or out of range',
               CAST(CAST(m_cents AS DECIMAL(18,0)) // 100 AS BIGINT) || '.' || lpad(CAST(m_cents % 100 AS VARCHAR), 2, '0'),
               run_date FROM messy WHERE m_cents >= 10000000000
        UNION ALL SELECT order_id, 'revenue out of range', m_quantity || ' x ' ||
               CAST(CAST(m_cents AS DECIMAL(18,0)) // 100 AS BIGINT) || '.' || lpad(CAST(m_cents % 100 AS VARCHAR), 2, '0'),
               run_date FROM messy
               WHERE m_quantity <> 'n/a' AND m_cents < 10000000000
                 AND CAST(m_cents AS HUGEINT) * quantity >= 1000000000000
        UNION ALL SELECT order_id, 'timestamp missing or unreadable', m_time, run_date
               FROM messy WHERE m_time IS NOT NULL
        UNION ALL SELECT NULL, 'order_id missing', NULL, run_date FROM lines WHERE l_quantity = 50"""),
    "rejects": ("fact prod good days", """
        SELECT order_id AS record_id, 'date_id not in dimension' AS failure_reason,
               CAST(date_id AS VARCHAR) AS failed_value, load_date AS run_date
        FROM fact WHERE date_id NOT IN (SELECT date_id FROM days)
        UNION ALL SELECT order_id, 'product_id not in dimension', product_id, load_date
        FROM fact WHERE product_id NOT IN (SELECT product_id FROM prod WHERE p_size <= 25)
        UNION ALL SELECT order_id, 'user_id not in dimension', user_id, load_date
        FROM fact WHERE user_id NOT IN (SELECT user_id FROM good)"""),
    # nested documents
    "cart": ("", """
        SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS user_id,
               o_orderdate, o_totalprice, o_orderstatus, size, total_quantity
        FROM orders JOIN (
            SELECT o_orderkey, COUNT(l_orderkey) AS size, CAST(COALESCE(SUM(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) AS total_quantity
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey) USING (o_orderkey)"""),
    "item": ("cart", """
        SELECT c.*, l_partkey AS product, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS price_cents,
               ROW_NUMBER() OVER (PARTITION BY id ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS i
        FROM cart c JOIN lineitem ON l_orderkey = id"""),
    "stocked": ("", """
        SELECT p_name AS product_name, p_type AS category, p_size AS stock,
               CAST(ROUND(CAST(p_retailprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS price_cents,
               (2 * d * 100 + n) // (2 * n) AS discount_hundredths
        FROM part LEFT JOIN (
          SELECT l_partkey, CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS BIGINT) AS d, COUNT(*) AS n
          FROM lineitem GROUP BY 1) ON l_partkey = p_partkey"""),
}

_BAD = f"record_id, failure_reason, failed_value, {day_text('run_date')} AS run_date"
_FACT_COLUMNS = (f"order_id, user_id, product_id, date_id, quantity, {money('cents')} AS revenue, "
                 f"{stamp('order_ts')} AS order_ts, status, {day_text('load_date')} AS load_date")
_EVENT_COLUMNS = (f"event_id, user_id, product_id, date_id, event_type, {stamp('event_ts')} AS event_ts, "
                  f"{day_text('load_date')} AS load_date")
_EV_TEXT = "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')"
_LINE = f"event_id || ',' || user_id || ',' || COALESCE(product_id, '') || ',' || event_type || ',' || {_EV_TEXT}"
_PAID_MEAN = cents_mean("SUM(cents)", "COUNT(cents)")
_CALENDAR_OUT = (f"date_id, {day_text('date')} AS date, day, week, month, quarter, year, day_of_week, day_name, "
                 "CAST(is_weekend AS BIGINT) AS is_weekend")
_MET_COLUMNS = ("raw_orders_count, staging_orders_count, fact_orders_count, raw_events_count, "
                "staging_events_count, fact_events_count, dq_failed_count, runtime_seconds")
_STAGED = (f"order_id, user_id, product_id, quantity, {money('price_cents')} AS unit_price, "
           f"{money('quantity * price_cents')} AS revenue, {stamp('o_orderdate')} AS order_ts, status, "
           f"{day_text('run_date')} AS load_date")


def _one_check(name: str) -> str:
    return with_ctes("dq", "SELECT run_date, check_name, check_type, failed, failed_count, failure_message, details "
                           f"FROM dq WHERE check_name = '{name}'")


def _funnel(stages: dict[str, str], rates: dict[str, tuple[str, str]]) -> str:
    counts = ", ".join(
        f"COUNT(DISTINCT CASE WHEN event_type = '{s}' THEN user_id END) AS {n}" for n, s in stages.items())
    shown = ", ".join(f"{half_up(f'100 * {a}', b)} AS {n}" for n, (a, b) in rates.items())
    return with_ctes("ev days", f"""
        SELECT {day_text('date')} AS event_date, {', '.join(stages)}, {shown} FROM (
          SELECT date, {counts} FROM ev JOIN days USING (date_id)
          WHERE date >= DATE '2024-01-31' - 30 GROUP BY date)""")


def _top_products(n: int) -> str:
    return f"""
        SELECT product_id, product_name, category, brand, COUNT(DISTINCT order_id) AS order_count,
               CAST(SUM(quantity) AS BIGINT) AS units_sold, {money('SUM(cents)')} AS total_revenue,
               {_PAID_MEAN} AS avg_order_value, {half_up('SUM(quantity)', 'COUNT(quantity)')} AS avg_units_per_order,
               {money('price_cents')} AS current_price,
               {half_up('SUM(cents)', '100 * SUM(quantity)')} AS actual_avg_price
        FROM paid JOIN prod USING (product_id) WHERE date_id >= 20010702
        GROUP BY product_id, product_name, category, brand, price_cents
        ORDER BY SUM(cents) DESC, product_id LIMIT {n}"""


def _growth(year: str, start: str) -> str:
    cents = "CAST(cents AS HUGEINT)"
    pct = half_up("100 * (w - p)", "p")
    return with_ctes("paid days", f"""
        SELECT week, {money('w')} AS weekly_revenue, o AS weekly_orders, {money('p')} AS prev_week_revenue,
               {pct} AS revenue_growth_pct, CAST(q AS DOUBLE) AS prev_week_orders,
               {half_up('100 * (o - q)', 'q')} AS orders_growth_pct
        FROM (SELECT *, LAG(w) OVER (ORDER BY week) AS p, LAG(o) OVER (ORDER BY week) AS q FROM (
          SELECT week, SUM({cents}) AS w, COUNT(DISTINCT order_id) AS o
          FROM paid JOIN days USING (date_id) WHERE {year} = {start} GROUP BY week))""")


ORACLES: dict[str, str] = {
    # ---- sources
    "raw_orders_scan": with_ctes("lines", f"""
        SELECT '2001-08-01' AS run_date, order_id, user_id, product_id, CAST(quantity AS VARCHAR) AS quantity,
               CAST(l_extendedprice AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS timestamp,
               status FROM lines"""),
    "raw_events_scan": with_ctes("ev", f"""
        SELECT '2024-01-31' AS run_date, {_LINE} AS raw_line, event_id, user_id,
               COALESCE(product_id, '') AS product_id, event_type, {_EV_TEXT} AS event_ts FROM ev"""),
    "raw_events_by_header": with_ctes("ev", f"""
        SELECT '2024-01-31' AS run_date, event_id, user_id,
               COALESCE(product_id, '') AS product_id, event_type, {_EV_TEXT} AS event_ts FROM ev"""),
    "raw_products_scan": """
        SELECT '2001-07-30' AS run_date, CAST(p_partkey AS VARCHAR) AS id, p_name AS title,
               CASE WHEN p_size >= 10 THEN p_type END AS category, CASE WHEN p_size <= 40 THEN p_brand END AS brand,
               p_retailprice AS price FROM part""",
    "events_raw_line": with_ctes("ev", f"SELECT event_id, {_LINE} AS raw_line FROM ev"),
    "events_fallback_id": with_ctes("ev", f"""
        SELECT raw_line, CASE WHEN event_type = 'checkout' THEN md5(raw_line) ELSE event_id END AS event_id, event_type
        FROM (SELECT * EXCLUDE (event_id), event_id AS event_id,
                     CASE WHEN event_type = 'checkout' THEN substr(line, length(event_id) + 1) ELSE line END AS raw_line
              FROM (SELECT *, {_LINE} AS line FROM ev))"""),
    "weekly_snapshot_filter": f"""
        SELECT {day_text('CAST(o_orderdate AS DATE)')} AS day, COUNT(*) AS orders FROM orders
        WHERE dayofweek(o_orderdate) = 1 GROUP BY 1""",
    "carts_to_orders": with_ctes("cart", """
        SELECT 'CART_' || id AS order_id, COALESCE(user_id, 'unknown') AS user_id, size AS products,
               o_totalprice AS total, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS discounted_total,
               size AS total_products, total_quantity,
               '2001-08-01 12:00:00.000000' AS timestamp, 'completed' AS status FROM cart"""),
    "cart_order_lines": with_ctes("item", f"""
        SELECT 'CART_' || id || '-' || (i + 1) AS order_id, COALESCE(user_id, 'unknown') AS user_id,
               CAST(product AS VARCHAR) AS product_id, quantity, {money('price_cents')} AS unit_price,
               {money('quantity * price_cents')} AS revenue, '2001-08-01 12:00:00.000000' AS order_ts,
               'completed' AS status, '2001-08-01' AS load_date FROM item"""),
    "first_available_source": """
        SELECT '2001-07-23' AS run_date, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name FROM part WHERE p_size <= 25
        UNION ALL SELECT '2001-07-30', CAST(p_partkey AS VARCHAR), p_name FROM part""",
    "catalog_normalize": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
               CASE WHEN p_size >= 10 THEN p_type ELSE 'uncategorized' END AS category,
               CASE WHEN p_size <= 40 THEN p_brand ELSE 'Fake Store' END AS brand,
               p_brand || ' ' || p_name AS description, p_retailprice AS current_price,
               CASE WHEN p_type <> 'PROMO' THEN p_size / 10.0 ELSE 0 END AS rating,
               CASE WHEN p_type <> 'PROMO' THEN CAST(p_size AS BIGINT) ELSE 0 END AS count FROM part""",
    "derive_view_events": """
        SELECT 'EVT_2001-08-01_view_' || p_partkey AS event_id, CAST(p_partkey % 10 + 1 AS VARCHAR) AS user_id,
               CAST(p_partkey AS VARCHAR) AS product_id, 'view_product' AS event_type,
               '2001-08-01 12:00:00.000000' AS event_ts FROM part""",
    "derive_cart_events": with_ctes("item", f"""
        SELECT 'EVT_2001-08-01_addcart_' || product || '_' || id || '_' || (i + 1) AS event_id, user_id,
               CAST(product AS VARCHAR) AS product_id, 'add_to_cart' AS event_type, {stamp('o_orderdate')} AS event_ts
        FROM item"""),
    "derive_events_union": with_ctes("item", f"""
        SELECT 'EVT_2001-08-01_view_' || p_partkey AS event_id, CAST(p_partkey % 10 + 1 AS VARCHAR) AS user_id,
               CAST(p_partkey AS VARCHAR) AS product_id, 'view_product' AS event_type,
               '2001-08-01 12:00:00.000000' AS event_ts FROM part
        UNION ALL
        SELECT 'EVT_2001-08-01_addcart_' || product || '_' || id || '_' || (i + 1), user_id,
               CAST(product AS VARCHAR), 'add_to_cart', {stamp('o_orderdate')} FROM item"""),
    # ---- staging
    "stg_orders": with_ctes("latest", f"SELECT {_STAGED} FROM latest"),
    "stg_events": with_ctes("ev", f"""
        SELECT event_id, user_id, product_id, event_type, {stamp('event_ts')} AS event_ts,
               {day_text('load_date')} AS load_date FROM ev"""),
    "stg_products": with_ctes("prod", f"""
        SELECT product_id, product_name, category, brand, {money('price_cents + 100')} AS current_price,
               '2001-08-01' AS load_date FROM prod"""),
    "json_extract_orders": with_ctes("lines", """
        SELECT order_id, user_id, product_id, CAST(quantity AS VARCHAR) AS quantity,
               CAST(l_extendedprice AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS timestamp,
               status FROM lines"""),
    "dedup_latest_order": with_ctes("latest", f"""
        SELECT order_id, product_id, {stamp('l_shipdate')} AS ingested_at FROM latest"""),
    "dedup_latest_event": with_ctes("ev", f"""
        SELECT event_id, upper(event_type) AS event_type, {stamp('event_ts + INTERVAL 2 HOUR')} AS ingested_at FROM ev"""),
    "quarantine_orders": with_ctes("bad_orders", f"SELECT 'raw.orders_json' AS source_table, {_BAD} FROM bad_orders"),
    "quarantine_events": with_ctes("ev", f"""
        SELECT 'raw.events_csv' AS source_table, event_id AS record_id, 'event_ts missing or unreadable' AS failure_reason,
               event_id || ',' || source_type AS failed_value, {day_text('load_date')} AS run_date
        FROM ev WHERE source_type = 'error' AND value > 20
        UNION ALL SELECT 'raw.events_csv', event_id, 'user_id missing', NULL, {day_text('load_date')}
        FROM ev WHERE value < 1
        UNION ALL SELECT 'raw.events_csv', event_id, 'event_type unknown', 'signup', {day_text('load_date')}
        FROM ev WHERE source_type = 'signup'"""),
    "event_type_domain": """
        SELECT event_type, COUNT(*) AS events FROM events WHERE event_type <> 'purchase' GROUP BY 1""",
    "date_key": f"SELECT o_orderkey, {day_key('o_orderdate')} AS date_id FROM orders",
    # ---- quality
    "dq_orders_volume": _one_check("orders_volume"),
    "dq_events_volume": _one_check("events_volume"),
    "dq_orders_duplicates": _one_check("orders_no_duplicates"),
    "dq_events_duplicates": with_ctes("loaded ev", f"""
        SELECT {day_text('d')} AS run_date, 'events_no_duplicates' AS check_name, 'uniqueness' AS check_type,
               CAST(n > 0 AS BIGINT) AS failed, n AS failed_count,
               CASE WHEN n > 0 THEN 'Found ' || n || ' duplicate event IDs' END AS failure_message,
               CASE WHEN n > 0 THEN '{{"duplicates":' || n || '}}' END AS details
        FROM (SELECT load_date AS d, COUNT(*) AS n FROM ev GROUP BY 1
              UNION ALL SELECT DISTINCT load_date, 0 FROM loaded)"""),
    "dq_negative_revenue": _one_check("orders_revenue_valid"),
    "dq_future_timestamps": _one_check("timestamps_not_future"),
    "dq_report": with_ctes("dq", """
        SELECT run_date, check_name, check_type, failed, failed_count, failure_message, details FROM dq"""),
    "dq_failures_log": with_ctes("dq_failed", """
        SELECT run_date, check_name, check_type, failed_count, failure_message, details FROM dq_failed"""),
    "duplicate_order_ids": with_ctes("lines", f"""
        SELECT {day_text('run_date')} AS load_date, order_id, COUNT(*) AS copies FROM lines
        GROUP BY ALL HAVING COUNT(*) > 1"""),
    "cross_day_duplicate_events": with_ctes("late", f"""
        SELECT event_id, {day_text('CAST(event_ts AS DATE)')} AS first_day, {day_text('load_date')} AS last_day,
               CAST(2 AS BIGINT) AS copies FROM late WHERE n % 3 > 0"""),
    "constraint_violations": with_ctes("messy", """
        SELECT 'order_id not null' AS constraint_name, CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'user_id not null', COUNT(*) FILTER (WHERE m_user IS NULL) FROM messy
        UNION ALL SELECT 'product_id not null', 0
        UNION ALL SELECT 'quantity not null', COUNT(*) FILTER (WHERE m_quantity = 'n/a') FROM messy
        UNION ALL SELECT 'unit_price not null', COUNT(*) FILTER (WHERE m_cents >= 10000000000) FROM messy
        UNION ALL SELECT 'revenue not null', COUNT(*) FILTER (WHERE m_quantity = 'n/a'
              OR CAST(m_cents AS HUGEINT) * quantity >= 1000000000000) FROM messy
        UNION ALL SELECT 'order_ts not null', COUNT(*) FILTER (WHERE m_time IS NOT NULL) FROM messy
        UNION ALL SELECT 'status not null', 0
        UNION ALL SELECT 'load_date not null', 0
        UNION ALL SELECT 'order_id length <= 256', 0
        UNION ALL SELECT 'user_id length <= 256', 0
        UNION ALL SELECT 'product_id length <= 256', 0
        UNION ALL SELECT 'status length <= 50', 0
        UNION ALL SELECT 'unique(order_id, load_date)', 0"""),
    "constraint_violations_loaded": with_ctes("lines", """
        SELECT unnest(['order_id not null', 'user_id not null', 'product_id not null', 'quantity not null',
                       'unit_price not null', 'revenue not null', 'order_ts not null', 'status not null',
                       'load_date not null', 'order_id length <= 256', 'user_id length <= 256',
                       'product_id length <= 256', 'status length <= 50']) AS constraint_name,
               CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'unique(order_id, load_date)',
               (SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id, run_date FROM lines))"""),
    "constraint_report": with_ctes("latest ev prod good days", """
        , o AS (
            SELECT order_id, CASE WHEN l_tax <> 0 THEN user_id END AS user_id, product_id, date_id, quantity,
                   CAST(quantity AS HUGEINT) * price_cents * CASE WHEN l_discount = 0.1 THEN 100000 ELSE 1 END AS cents,
                   CASE WHEN l_returnflag = 'R' THEN repeat(status, 9) ELSE status END AS status,
                   CAST(date_trunc('year', o_orderdate) AS DATE) AS load_date, n
            FROM (SELECT *, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_id,
                         CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END AS n FROM latest)),
        x AS (
            SELECT load_date, SUM(n) AS checked, unnest([
                {'c': 'order_id not null', 'v': 0}, {'c': 'user_id not null', 'v': SUM(n) FILTER (user_id IS NULL)},
                {'c': 'product_id not null', 'v': 0}, {'c': 'date_id not null', 'v': 0}, {'c': 'quantity not null', 'v': 0},
                {'c': 'revenue not null', 'v': 0}, {'c': 'order_ts not null', 'v': 0}, {'c': 'load_date not null', 'v': 0},
                {'c': 'order_id length <= 256', 'v': 0}, {'c': 'user_id length <= 256', 'v': 0}, {'c': 'product_id length <= 256', 'v': 0},
                {'c': 'status length <= 50', 'v': SUM(n) FILTER (length(status) > 50)},
                {'c': 'revenue numeric(12,2)', 'v': SUM(n) FILTER (abs(cents) >= 1000000000000)},
                {'c': 'date_id references warehouse.dim_date', 'v': SUM(n) FILTER (date_id NOT IN (SELECT date_id FROM days WHERE year >= 1997))},
                {'c': 'user_id references warehouse.dim_user', 'v': SUM(n) FILTER (user_id NOT IN (SELECT user_id FROM good))},
                {'c': 'product_id references warehouse.dim_product', 'v': SUM(n) FILTER (product_id NOT IN (SELECT product_id FROM prod WHERE p_size <= 25))},
                {'c': 'unique(order_id, load_date)', 'v': SUM(n - 1)}]) AS r, 'warehouse.fact_orders' AS t
            FROM o GROUP BY load_date
            UNION ALL
            SELECT CAST(date_trunc('month', load_date) AS DATE), COUNT(*), unnest([
                {'c': 'event_id not null', 'v': 0}, {'c': 'user_id not null', 'v': COUNT(*) FILTER (user_id IS NULL)}, {'c': 'date_id not null', 'v': 0},
                {'c': 'event_type not null', 'v': 0}, {'c': 'event_ts not null', 'v': 0}, {'c': 'load_date not null', 'v': 0},
                {'c': 'event_id length <= 256', 'v': 0}, {'c': 'user_id length <= 256', 'v': 0}, {'c': 'product_id length <= 256', 'v': 0},
                {'c': 'event_type length <= 100', 'v': 0},
                {'c': 'date_id references warehouse.dim_date', 'v': 0},
                {'c': 'user_id references warehouse.dim_user', 'v': COUNT(*) FILTER (user_id NOT IN (SELECT user_id FROM good))},
                {'c': 'unique(event_id, load_date)', 'v': COUNT(*) - COUNT(DISTINCT event_id)}]), 'warehouse.fact_events'
            FROM ev GROUP BY 1)
        SELECT t AS table_name, r.c AS constraint_name, CAST(checked AS BIGINT) AS checked, CAST(COALESCE(r.v, 0) AS BIGINT) AS violations,
               strftime(load_date, '%Y-%m-%d') AS run_date FROM x"""),
    # ---- dimensions
    "dim_date": f"""
        SELECT {_CALENDAR_OUT} FROM ({_CALENDAR} FROM (
          SELECT unnest(range(CAST(MIN(o_orderdate) AS TIMESTAMP), MAX(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
          FROM orders))""",
    "date_attributes": f"""
        SELECT {_CALENDAR_OUT} FROM ({_CALENDAR} FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(ts AS DATE) FROM events))""",
    "insert_absent_dim_date": f"""
        SELECT {_CALENDAR_OUT.replace('day_name,', "CASE WHEN year = 2001 THEN 'kept' ELSE day_name END AS day_name,")}
        FROM ({_CALENDAR} FROM (
          SELECT CAST(o_orderdate AS DATE) AS d FROM orders
          UNION SELECT CAST(range AS DATE) FROM range(TIMESTAMP '2001-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 DAY)))""",
    "dim_user_load": with_ctes("latest", "SELECT DISTINCT user_id FROM latest"),
    "upsert_dim_user": with_ctes("latest usr good", f"""
        SELECT k.user_id,
               CASE WHEN u.user_id IS NOT NULL THEN u.city WHEN g.user_id IS NOT NULL THEN 'old' END AS city,
               {day_text('u.signup_date')} AS signup_date, u.marketing_source,
               CASE WHEN g.user_id IS NOT NULL THEN '2001-01-01 00:00:00.000000'
                    ELSE '2001-08-01 12:00:00.000000' END AS created_at,
               CASE WHEN b.user_id IS NOT NULL THEN '2001-08-01 12:00:00.000000'
                    ELSE '2001-01-01 00:00:00.000000' END AS updated_at
        FROM (SELECT user_id FROM good UNION SELECT user_id FROM latest) k
        LEFT JOIN good g ON g.user_id = k.user_id
        LEFT JOIN (SELECT DISTINCT user_id FROM latest) b ON b.user_id = k.user_id
        LEFT JOIN (SELECT * FROM usr WHERE marketing_source <> 'FURNITURE') u ON u.user_id = k.user_id"""),
    "upsert_dim_product": with_ctes("prod", f"""
        SELECT product_id, product_name, category,
               CASE WHEN p_size <= 40 THEN brand END AS brand,
               {money('price_cents + CASE WHEN p_size >= 20 THEN 100 ELSE 0 END')} AS current_price,
               CASE WHEN p_size <= 30 THEN '2001-01-01' ELSE '2001-08-01' END AS effective_from,
               CAST(NULL AS VARCHAR) AS effective_to,
               CASE WHEN p_size <= 30 THEN '2001-01-01 00:00:00.000000' ELSE '2001-08-01 12:00:00.000000' END AS created_at,
               CASE WHEN p_size >= 20 THEN '2001-08-01 12:00:00.000000' ELSE '2001-01-01 00:00:00.000000' END AS updated_at
        FROM prod"""),
    "scd2_dim_product": with_ctes("prod", f"""
        SELECT product_id, product_name, category, b AS brand, {money('c')} AS current_price,
               {day_text('d')} AS effective_from, {day_text('LEAD(d) OVER (PARTITION BY product_id ORDER BY d)')} AS effective_to
        FROM (SELECT *, LAG(c) OVER w AS pc, LAG(b) OVER w AS pb, ROW_NUMBER() OVER w AS rn FROM (
            SELECT *, brand AS b, price_cents AS c, DATE '1995-01-01' AS d FROM prod WHERE p_size <= 40
            UNION ALL SELECT *, brand, price_cents + CASE WHEN p_size <= 25 THEN 500 ELSE 0 END, DATE '1998-01-01'
              FROM prod WHERE p_size >= 10
            UNION ALL SELECT *, CASE WHEN p_size > 5 THEN brand END,
              price_cents + CASE WHEN p_size <= 25 THEN 500 ELSE 0 END, DATE '2000-01-01' FROM prod WHERE p_size <= 20)
          WINDOW w AS (PARTITION BY product_id ORDER BY d))
        WHERE rn = 1 OR c <> pc OR b IS DISTINCT FROM pb"""),
    "product_price_asof": with_ctes("fact prod", f"""
        SELECT order_id, product_id, {stamp('order_ts')} AS order_ts, quantity, {money('cents')} AS revenue,
               {money("CASE WHEN p_size <= 25 AND order_ts >= DATE '1998-01-01' THEN (price_cents * 11 + 5) // 10 ELSE price_cents END")}
                 AS price_at_order,
               CASE WHEN p_size <= 25 AND order_ts >= DATE '1998-01-01' THEN '1998-01-01' ELSE '1995-01-01' END AS effective_from,
               CASE WHEN p_size <= 25 AND order_ts < DATE '1998-01-01' THEN '1998-01-01' END AS effective_to
        FROM fact JOIN prod USING (product_id)"""),
    # ---- facts and metrics
    "fact_orders_load": with_ctes("fact_ok", f"SELECT {_FACT_COLUMNS} FROM fact_ok"),
    "fact_events_load": with_ctes("ev_ok", f"SELECT {_EVENT_COLUMNS} FROM ev_ok"),
    "fact_events_late_days": with_ctes("late good", f"""
        SELECT {_EVENT_COLUMNS} FROM late WHERE user_id IN (SELECT user_id FROM good)"""),
    "fact_orders_rejects": with_ctes("rejects", f"SELECT 'staging.orders_clean' AS source_table, {_BAD} FROM rejects"),
    "fact_events_rejects": with_ctes("ev good", f"""
        SELECT 'staging.events_clean' AS source_table, event_id AS record_id, 'user_id not in dimension' AS failure_reason,
               user_id AS failed_value, {day_text('load_date')} AS run_date
        FROM ev WHERE user_id NOT IN (SELECT user_id FROM good)"""),
    "backfill_days": with_ctes("latest ev", f"""
        , o AS (
            SELECT *, DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS day FROM latest),
        good_o AS (SELECT * FROM o WHERE day <> DATE '2024-01-15'),
        w(week, day) AS (VALUES (1, DATE '2024-01-01'), (2, DATE '2024-01-08'), (4, DATE '2024-01-22'), (5, DATE '2024-01-29')),
        cat AS (
            SELECT CAST(p_partkey AS VARCHAR) AS product_id, day, p_size,
                   CAST(ROUND(CAST(p_retailprice AS DECIMAL(14,2)) * 100) AS BIGINT) + CASE WHEN p_size <= 5 THEN 100 * week ELSE 0 END AS cents
            FROM part JOIN w ON p_size <= 10 * week),
        p AS (SELECT product_id, MIN(day) AS since, arg_max(cents, day) AS cents FROM cat GROUP BY 1),
        u AS (SELECT user_id, MIN(day) AS since FROM good_o GROUP BY 1),
        v AS (
            SELECT product_id, day, cents, LEAD(day) OVER (PARTITION BY product_id ORDER BY day) AS until
            FROM (SELECT *, LAG(cents) OVER (PARTITION BY product_id ORDER BY day) AS was FROM cat) WHERE was IS DISTINCT FROM cents),
        r AS (
            SELECT 'order' AS kind, order_id AS id, user_id, product_id, day, CAST(NULL AS DATE) AS until, quantity * price_cents AS cents
            FROM good_o JOIN p USING (product_id) WHERE day >= since
            UNION ALL SELECT 'event', event_id, user_id, NULLIF(product_id, ''), load_date, NULL, NULL
            FROM ev JOIN u USING (user_id) WHERE load_date >= since AND load_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
              AND load_date <> DATE '2024-01-15'
            UNION ALL SELECT 'product', product_id, NULL, NULL, since, NULL, cents FROM p
            UNION ALL SELECT 'version', product_id, NULL, NULL, day, until, cents FROM v
            UNION ALL SELECT 'user', user_id, NULL, NULL, NULL, NULL, NULL FROM u)
        SELECT kind, id, user_id, product_id, {day_text('day')} AS day, {day_text('until')} AS until, {money('cents')} AS amount FROM r"""),
    "stream_to_facts": with_ctes("latest prod", f"""
        , o AS (SELECT *, DATE '2024-01-01' + CAST(l_orderkey % 5 AS INTEGER) AS day FROM latest)
        SELECT order_id, user_id, product_id, {day_key('day + 1')} AS date_id, quantity,
               {money('quantity * price_cents')} AS revenue, {stamp("day + INTERVAL 1 DAY + INTERVAL 12 HOUR")} AS order_ts, status,
               {day_text('day')} AS load_date
        FROM o WHERE product_id IN (SELECT product_id FROM prod WHERE p_size <= 25)"""),
    "stream_late_recovery": with_ctes("ev", f"""
        SELECT event_id, user_id, NULLIF(product_id, '') AS product_id, event_type, {stamp('event_ts')} AS event_ts,
               '2024-01-31' AS load_date FROM ev"""),
    "fact_row_ids": with_ctes("fact", """
        SELECT md5(order_id || chr(31) || day) AS fact_orders_id, order_id, day AS load_date, CAST(1 AS BIGINT) AS stamped
        FROM (SELECT order_id, strftime(DATE '2024-01-01' + CAST(split_part(order_id, '-', 1) AS INTEGER) % 30, '%Y-%m-%d') AS day FROM fact)"""),
    "mv_daily_orders_summary": with_ctes("fact", f"""
        SELECT date_id, COUNT(*) AS order_count, {money('SUM(cents)')} AS daily_revenue,
               CAST(SUM(quantity) AS BIGINT) AS units_sold FROM fact GROUP BY date_id"""),
    "mv_daily_revenue": with_ctes("fact", f"""
        SELECT {day_text('CAST(order_ts AS DATE)')} AS order_date, {money('SUM(cents)')} AS daily_revenue
        FROM fact GROUP BY 1"""),
    "daily_metrics": with_ctes("met", f"SELECT {day_text('run_date')} AS run_date, {_MET_COLUMNS} FROM met"),
    "layer_counts": with_ctes("lines latest fact_ok ev ev_ok", """
        SELECT (SELECT COUNT(*) FROM lines) AS raw_orders, (SELECT COUNT(*) FROM latest) AS staging_orders,
               (SELECT COUNT(*) FROM fact_ok) AS fact_orders, (SELECT 2 * COUNT(*) FROM ev) AS raw_events,
               (SELECT COUNT(*) FROM ev_ok) AS fact_events"""),
    "reload_day_idempotent": with_ctes("late", f"""
        SELECT event_id, user_id, product_id, event_type, {stamp('event_ts')} AS event_ts,
               {day_text('load_date')} AS load_date FROM late
        WHERE load_date <> DATE '2024-01-20' AND (load_date <> DATE '2024-01-10' OR event_type = 'purchase')"""),
    # ---- analytics
    "revenue_by_date": with_ctes("paid days", f"""
        SELECT {day_text('date')} AS order_date, COUNT(DISTINCT order_id) AS order_count,
               {money('SUM(cents)')} AS daily_revenue, {_PAID_MEAN} AS avg_order_value,
               {money('MAX(cents)')} AS max_order_value, {money('MIN(cents)')} AS min_order_value
        FROM paid JOIN days USING (date_id) WHERE date >= DATE '2001-08-01' - 90 GROUP BY date"""),
    "revenue_by_category": with_ctes("paid days prod", f"""
        SELECT category, year, month, order_count, {money('c')} AS category_revenue, avg_order_value,
               {half_up('100 * c', 'SUM(c) OVER (PARTITION BY year, month)')} AS revenue_pct
        FROM (SELECT category, year, month, COUNT(DISTINCT order_id) AS order_count,
                     SUM(CAST(cents AS HUGEINT)) AS c, {_PAID_MEAN} AS avg_order_value
              FROM paid JOIN prod USING (product_id) JOIN days USING (date_id)
              WHERE year = 2000 GROUP BY category, year, month)"""),
    "revenue_by_brand": with_ctes("paid prod", f"""
        SELECT brand, COUNT(DISTINCT order_id) AS order_count, CAST(SUM(quantity) AS BIGINT) AS units_sold,
               {money('SUM(cents)')} AS total_revenue, {_PAID_MEAN} AS avg_order_value,
               {half_up('SUM(quantity)', 'COUNT(quantity)')} AS avg_units_per_order
        FROM paid JOIN prod USING (product_id) WHERE date_id >= 20010702 GROUP BY brand"""),
    "category_revenue_simple": with_ctes("fact prod", f"""
        SELECT category, COUNT(*) AS orders, {money('SUM(cents)')} AS total_revenue, {_PAID_MEAN} AS avg_order_value
        FROM fact JOIN prod USING (product_id) GROUP BY category"""),
    "category_revenue_recent": with_ctes("fact prod", f"""
        SELECT category, COUNT(*) AS orders, {money('SUM(cents)')} AS total_revenue, {_PAID_MEAN} AS avg_order_value
        FROM fact JOIN prod USING (product_id) WHERE date_id >= 20010702 GROUP BY category"""),
    "daily_sales_summary": with_ctes("fact days", f"""
        SELECT {day_text('date')} AS date, COUNT(order_id) AS orders, {money('SUM(cents)')} AS daily_revenue,
               {cents_mean('SUM(cents)', 'COUNT(cents)', 6)} AS avg_order_value
        FROM fact JOIN days USING (date_id) GROUP BY days.date ORDER BY days.date DESC LIMIT 30"""),
    "daily_revenue_trend": with_ctes("fact days", f"""
        SELECT {day_text('date')} AS order_date, COUNT(*) AS order_count, {money('SUM(cents)')} AS daily_revenue,
               {cents_mean('SUM(cents)', 'COUNT(cents)', 6)} AS avg_order_value, {money('MAX(cents)')} AS max_order_value
        FROM fact JOIN days USING (date_id) WHERE date >= DATE '2001-08-01' - 90 GROUP BY date"""),
    "orders_by_weekday": with_ctes("fact days", f"""
        SELECT day_name, day_of_week, COUNT(*) AS order_count, {money('SUM(cents)')} AS revenue
        FROM fact JOIN days USING (date_id) GROUP BY day_name, day_of_week"""),
    "revenue_by_grain": with_ctes("paid days", "\nUNION ALL\n".join(f"""
        SELECT '{grain}' AS grain, {period} AS period, COUNT(DISTINCT order_id) AS order_count,
               {money('SUM(cents)')} AS revenue FROM paid JOIN days USING (date_id) GROUP BY ALL"""
        for grain, period in (("day", day_text("date")), ("week", "year || '-' || week"), ("month", "year || '-' || month")))),
    "orders_between_date_ids": with_ctes("fact", f"""
        SELECT {_FACT_COLUMNS} FROM fact WHERE date_id BETWEEN 19970101 AND 19991231"""),
    "wow_growth": _growth("year", "2000"),
    "wow_growth_iso": _growth("isoyear(date)", "1998"),
    "day_of_week_seasonality": with_ctes("paid days", f"""
        SELECT day_name, day_of_week, COUNT(DISTINCT date) AS num_days, {cents_mean('SUM(r)', 'COUNT(*)')} AS avg_daily_revenue,
               {half_up('SUM(o)', 'COUNT(*)')} AS avg_daily_orders
        FROM (SELECT date_id, COUNT(*) AS o, SUM(CAST(cents AS HUGEINT)) AS r FROM paid GROUP BY date_id)
        JOIN days USING (date_id) WHERE date >= DATE '2001-08-01' - 90 GROUP BY day_name, day_of_week"""),
    "top_customers": with_ctes("paid", f"""
        SELECT user_id, COUNT(DISTINCT order_id) AS order_count, {money('SUM(cents)')} AS total_spent,
               {_PAID_MEAN} AS avg_order_value, {stamp('MIN(order_ts)')} AS first_order_date,
               {stamp('MAX(order_ts)')} AS last_order_date,
               date_diff('day', MIN(order_ts), MAX(order_ts)) AS customer_lifespan_days,
               {cents_mean('SUM(cents)', "date_diff('day', MIN(order_ts), MAX(order_ts))")} AS revenue_per_day
        FROM paid GROUP BY user_id ORDER BY SUM(cents) DESC, user_id LIMIT 50"""),
    "lifetime_top_customers": with_ctes("twice", f"""
        SELECT user_id, COUNT(DISTINCT order_id) AS order_count, {money('SUM(cents)')} AS total_spent,
               {_PAID_MEAN} AS avg_order_value, {stamp('MIN(order_ts)')} AS first_order_date,
               {stamp('MAX(order_ts)')} AS last_order_date,
               date_diff('day', MIN(order_ts), MAX(order_ts)) AS customer_lifespan_days,
               {cents_mean('SUM(cents)', "date_diff('day', MIN(order_ts), MAX(order_ts))")} AS revenue_per_day
        FROM twice GROUP BY user_id ORDER BY SUM(cents) DESC, user_id LIMIT 50"""),
    "lifetime_marketing_source": with_ctes("usr twice", f"""
        SELECT marketing_source, COUNT(DISTINCT usr.user_id) AS users_acquired,
               COUNT(DISTINCT order_id) AS orders_from_source, {money('SUM(cents)')} AS revenue_from_source,
               {half_up('100 * COUNT(DISTINCT order_id)', 'COUNT(DISTINCT usr.user_id)')} AS conversion_rate,
               {cents_mean('SUM(cents)', 'COUNT(DISTINCT usr.user_id)')} AS revenue_per_user
        FROM usr LEFT JOIN twice ON twice.user_id = usr.user_id GROUP BY marketing_source"""),
    "repeat_customers": with_ctes("paid", f"""
        SELECT COUNT(*) AS repeat_customers, {money('SUM(c)')} AS repeat_customer_revenue,
               {half_up('SUM(n)', 'COUNT(*)')} AS avg_orders_per_customer,
               {cents_mean('SUM(c)', 'COUNT(*)')} AS avg_lifetime_value
        FROM (SELECT user_id, COUNT(DISTINCT order_id) AS n, SUM(CAST(cents AS HUGEINT)) AS c FROM paid
              GROUP BY user_id HAVING COUNT(DISTINCT order_id) >= 2)"""),
    "tenure_segments": with_ctes("usr paid", f"""
        SELECT tenure_bucket, COUNT(DISTINCT u.user_id) AS user_count, COUNT(DISTINCT order_id) AS total_orders,
               {_PAID_MEAN} AS avg_order_value, {money('SUM(cents)')} AS segment_revenue
        FROM (SELECT *, CASE WHEN age < 30 THEN '0-30 days' WHEN age < 60 THEN '31-60 days'
                WHEN age < 90 THEN '61-90 days' WHEN age < 180 THEN '91-180 days' WHEN age < 365 THEN '181-365 days'
                ELSE '1+ years' END AS tenure_bucket
              FROM (SELECT *, DATE '1995-12-31' - signup_date AS age FROM usr)) u
        LEFT JOIN paid USING (user_id) GROUP BY tenure_bucket"""),
    "tenure_segments_simple": with_ctes("usr", """
        SELECT CASE WHEN age < 30 THEN 'New' WHEN age < 90 THEN 'Growing' ELSE 'Established' END AS tenure_group,
               COUNT(*) AS user_count
        FROM (SELECT DATE '1995-12-31' - signup_date AS age FROM usr) GROUP BY 1"""),
    "marketing_source_performance": with_ctes("usr paid", f"""
        SELECT marketing_source, COUNT(DISTINCT usr.user_id) AS users_acquired,
               COUNT(DISTINCT order_id) AS orders_from_source, {money('SUM(cents)')} AS revenue_from_source,
               {half_up('100 * COUNT(DISTINCT order_id)', 'COUNT(DISTINCT usr.user_id)')} AS conversion_rate,
               {cents_mean('SUM(cents)', 'COUNT(DISTINCT usr.user_id)')} AS revenue_per_user
        FROM usr LEFT JOIN paid ON paid.user_id = usr.user_id GROUP BY marketing_source"""),
    "users_by_marketing_source": with_ctes("usr fact", """
        SELECT marketing_source, COUNT(*) AS user_count, COUNT(DISTINCT n) AS users_with_orders
        FROM usr LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM fact GROUP BY user_id) USING (user_id)
        GROUP BY marketing_source"""),
    "product_performance": with_ctes("paid prod", _top_products(50)),
    "top_products_by_category": with_ctes("paid prod", f"""
        SELECT category, product_id, product_name, {money('c')} AS product_revenue, order_count, rank FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY c DESC, product_id) AS rank FROM (
            SELECT category, product_id, product_name, SUM(cents) AS c, COUNT(DISTINCT order_id) AS order_count
            FROM paid JOIN prod USING (product_id) WHERE date_id >= 20010702 GROUP BY ALL)) WHERE rank <= 5"""),
    "top_products_by_revenue": with_ctes("fact prod", f"""
        SELECT product_id, product_name, COUNT(order_id) AS orders, {money('SUM(cents)')} AS revenue
        FROM fact JOIN prod USING (product_id) GROUP BY product_id, product_name
        ORDER BY SUM(cents) DESC, product_id LIMIT 10"""),
    "top_products_recent": with_ctes("fact prod", f"""
        SELECT product_id, product_name, category, brand, COUNT(DISTINCT order_id) AS order_count,
               {money('SUM(cents)')} AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS units_sold
        FROM fact JOIN prod USING (product_id) WHERE date_id >= 20010702
        GROUP BY product_id, product_name, category, brand ORDER BY SUM(cents) DESC, product_id LIMIT 20"""),
    "low_stock": with_ctes("stocked", f"""
        SELECT product_name, stock, {money('price_cents')} AS price FROM stocked WHERE stock < 20"""),
    "avg_discount_by_category": with_ctes("stocked", f"""
        SELECT category, {half_up('SUM(discount_hundredths)', '100 * COUNT(*)', 6)} AS avg_discount,
               COUNT(*) AS products_on_sale FROM stocked WHERE discount_hundredths > 0 GROUP BY category"""),
    "discount_revenue_loss": with_ctes("stocked", """
        SELECT CAST(SUM(CAST(price_cents * discount_hundredths AS HUGEINT)) AS DOUBLE) / 1000000.0
               AS potential_revenue_loss FROM stocked"""),
    "event_funnel": _funnel(
        {"page_viewers": "page_view", "product_viewers": "view_product", "cart_adds": "add_to_cart",
         "checkouts": "checkout", "purchases": "purchase"},
        {"view_to_product_rate": ("product_viewers", "page_viewers"),
         "product_to_cart_rate": ("cart_adds", "product_viewers"),
         "cart_to_checkout_rate": ("checkouts", "cart_adds"),
         "checkout_to_purchase_rate": ("purchases", "checkouts"),
         "overall_conversion_rate": ("purchases", "page_viewers")}),
    "event_funnel_3stage": _funnel(
        {"viewers": "page_view", "cart_adds": "add_to_cart", "purchasers": "purchase"},
        {"cart_rate": ("cart_adds", "viewers"), "purchase_rate": ("purchasers", "cart_adds")}),
    "product_conversion": with_ctes("ev prod", f"""
        SELECT category, product_id, product_name, product_views, add_to_carts, purchases,
               {half_up('100 * add_to_carts', 'product_views')} AS atc_rate,
               {half_up('100 * purchases', 'add_to_carts')} AS purchase_rate
        FROM (SELECT category, product_id, product_name,
                COUNT(DISTINCT CASE WHEN event_type = 'view_product' THEN user_id END) AS product_views,
                COUNT(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN user_id END) AS add_to_carts,
                COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchases
              FROM ev JOIN prod USING (product_id) WHERE date_id >= 20240101 GROUP BY ALL)"""),
    "event_counts": with_ctes("ev", """
        SELECT event_type, COUNT(DISTINCT user_id) AS unique_users, COUNT(*) AS total_events FROM ev GROUP BY 1"""),
    "late_events_by_lag": with_ctes("late", f"""
        SELECT n % 3 AS lag_days, COUNT(*) AS events, {day_text('CAST(MIN(event_ts) AS DATE)')} AS first_event_day,
               {day_text('CAST(MAX(event_ts) AS DATE)')} AS last_event_day FROM late GROUP BY 1"""),
    # ---- health
    "metrics_dashboard": with_ctes("met", f"""
        SELECT {day_text('run_date')} AS run_date, {_MET_COLUMNS},
               {half_up('100 * fact_orders_count', 'raw_orders_count')} AS orders_completion_pct,
               {half_up('100 * fact_events_count', 'raw_events_count')} AS events_completion_pct,
               CASE WHEN dq_failed_count = 0 THEN '✓ PASS' ELSE '✗ FAIL' END AS dq_status
        FROM met WHERE run_date >= DATE '2001-08-01' - 30"""),
    "pipeline_health": with_ctes("met", f"""
        SELECT {day_text('run_date')} AS run_date, raw_orders_count, staging_orders_count, fact_orders_count,
               dq_failed_count, runtime_seconds FROM met ORDER BY met.run_date DESC LIMIT 10"""),
    "ops_latest_metrics": with_ctes("met", f"""
        SELECT {day_text('run_date')} AS run_date, {_MET_COLUMNS} FROM met ORDER BY met.run_date DESC LIMIT 1"""),
    "ops_recent_failures": with_ctes("dq_failed", """
        SELECT run_date, check_name, check_type, failed_count, failure_message, details FROM dq_failed
        WHERE d >= DATE '2001-08-01' - 1"""),
    "ops_alerts": with_ctes("met", f"""
        SELECT 'slow_run' AS alert, {day_text('run_date')} AS run_date, runtime_seconds AS value FROM met
        WHERE run_date >= DATE '2001-08-01' - 30 AND runtime_seconds > 6000
        UNION ALL SELECT * FROM (SELECT 'many_failures', {day_text('run_date')}, dq_failed_count FROM met
          WHERE dq_failed_count > 2 ORDER BY met.run_date DESC LIMIT 7)
        UNION ALL SELECT 'few_orders', {day_text('run_date')}, raw_orders_count FROM met
        WHERE run_date >= DATE '2001-08-01' - 30 AND raw_orders_count < 100"""),
    "dq_failure_trend": with_ctes("dq_failed", f"""
        SELECT {day_text("CAST(date_trunc('week', d) AS DATE)")} AS week_start, check_name, check_type,
               COUNT(*) AS failure_count, array_to_string(list_sort(list(DISTINCT failure_message)), ',') AS messages
        FROM dq_failed WHERE d >= DATE '2001-08-01' - 90 GROUP BY ALL"""),
    "bad_records_audit": with_ctes("bad_orders rejects", """
        SELECT source_table, failure_reason, COUNT(*) AS bad_record_count,
               COALESCE(array_to_string(list_sort(list(DISTINCT record_id) FILTER (WHERE record_id IS NOT NULL))[1:5], ','), '') AS sample_ids
        FROM (SELECT 'raw.orders_json' AS source_table, * FROM bad_orders
              UNION ALL SELECT 'staging.orders_clean', * FROM rejects)
        WHERE run_date >= DATE '2001-08-01' - 3000 GROUP BY ALL"""),
    "lineage_orders": with_ctes("lines fact_ok", f"""
        SELECT {day_text('run_date')} AS run_date, {stamp('l_shipdate')} AS ingested_at, l.order_id,
               l.order_id AS staging_order_id, f.order_id AS fact_order_id, {day_text('f.load_date')} AS fact_load_date
        FROM lines l LEFT JOIN fact_ok f ON f.order_id = l.order_id AND f.load_date = l.run_date"""),
    "change_tracking": with_ctes("lines latest", f"""
        SELECT order_id, {stamp('o_orderdate')} AS created_at, {stamp('l_shipdate')} AS updated_at,
               COALESCE(n, 0) AS raw_records_that_day
        FROM latest LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS n FROM lines GROUP BY 1)
          ON d = CAST(l_shipdate AS DATE)"""),
    "distinct_product_names": "SELECT DISTINCT p_name AS product_name FROM part",
    # ---- streaming
    "stream_ingest_events": with_ctes("ev", f"""
        SELECT {_LINE} AS raw_line, event_id, user_id, COALESCE(product_id, '') AS product_id, event_type,
               {_EV_TEXT} AS event_ts FROM ev"""),
    "stream_dedup_events": with_ctes("ev", f"""
        SELECT event_id, user_id, COALESCE(product_id, '') AS product_id, event_type, {_EV_TEXT} AS event_ts FROM ev"""),
    "stream_then_batch_orders": with_ctes("latest", f"""
        SELECT * REPLACE ('2001-08-01' AS load_date) FROM (SELECT {_STAGED} FROM latest)"""),
    "stream_then_batch_events": with_ctes("ev", f"""
        SELECT {_LINE} AS raw_line, event_id, user_id, COALESCE(product_id, '') AS product_id, event_type,
               {_EV_TEXT} AS event_ts FROM ev"""),
    "stream_upsert_orders": with_ctes("latest", f"""
        SELECT * REPLACE ('2001-08-01' AS load_date) FROM (SELECT {_STAGED} FROM latest)"""),
}
