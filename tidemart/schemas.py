"""Table contracts: columns, keys, partitioning and value limits of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

# The known event types, in the order of the purchase funnel.
EVENT_TYPES = ("page_view", "view_product", "add_to_cart", "checkout", "purchase")


@dataclass(frozen=True)
class TableContract:
    """One warehouse table.

    ``kind`` says how it is written: ``append`` only grows, ``daily`` is replaced one
    partition value at a time, ``keyed`` is a snapshot merged by key, bucket by bucket
    where ``bucket_by`` names columns.
    """

    name: str
    kind: str
    columns: str
    key: tuple[str, ...] = ()
    partition: str | None = None
    within: str | None = None  # second partition level: one value per writer of a day
    split: str | None = None  # second partition level that queries filter on, taken from the rows
    bucket_by: tuple[str, ...] = ()  # keyed tables that are merged by hash bucket of these columns
    spread_by: str | None = None  # what buckets the rows without a key, so that they do not share one
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)  # key column -> the dimension that must have it
    # Name of a row id that the store adds to what it writes, with the time of the load
    # (``created_at``); ``TableStore.read(name, identified=True)`` and the SQL views show both.
    identity: str | None = None

    @property
    def identified_ddl(self) -> str:
        return self.columns + (f", {self.identity} STRING, created_at TIMESTAMP_NTZ" if self.identity else "")

    @property
    def decimals(self) -> dict[str, tuple[int, int]]:
        """Precision and scale of the NUMERIC columns."""
        found = {}
        for definition in self.column_definitions:
            name, kind = definition.split(" ", 1)
            if kind.upper().startswith("DECIMAL("):
                precision, scale = kind[len("DECIMAL("):-1].split(",")
                found[name] = int(precision), int(scale)
        return found

    @property
    def ddl(self) -> str:
        return self.columns

    @property
    def partitions(self) -> list[str]:
        return [p for p in (self.partition, self.within, self.split) if p]

    @property
    def column_definitions(self) -> list[str]:
        return _split_columns(self.columns)

    @property
    def column_names(self) -> list[str]:
        return [definition.split()[0] for definition in self.column_definitions]


def _split_columns(ddl: str) -> list[str]:
    """Split a DDL column list on the commas outside parentheses."""
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += {"(": 1, ")": -1}.get(ch, 0)
        if ch == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]


_ALL = [
    # ---- raw: what the sources delivered, append only; every delivery (a daily load or a
    # micro-batch) has a folder of its own within the day ------------------------------
    TableContract(
        "raw.orders_json", "append",
        "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE",
        identity="raw_orders_id", partition="run_date", within="delivery", required=("run_date", "ingested_at", "raw_json"),
    ),
    TableContract(
        "raw.events_csv", "append",
        "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_line STRING, event_id STRING, user_id STRING, "
        "product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, run_date DATE",
        identity="raw_events_id", partition="run_date", within="delivery", required=("run_date", "ingested_at"),
        max_length={"event_id": 256, "user_id": 256, "product_id": 256, "event_type": 100},
    ),
    TableContract(
        "raw.products_json", "append",
        "fetched_at TIMESTAMP_NTZ, raw_json STRING, run_date DATE",
        identity="raw_products_id", partition="run_date", within="delivery", required=("run_date", "fetched_at", "raw_json"),
    ),
    # ---- staging: typed, cleaned, one row per key and day ---------------------------
    TableContract(
        "staging.orders_clean", "daily",
        "order_id STRING, user_id STRING, product_id STRING, quantity INT, unit_price DECIMAL(10,2), "
        "revenue DECIMAL(12,2), order_ts TIMESTAMP_NTZ, status STRING, created_at TIMESTAMP_NTZ, "
        "updated_at TIMESTAMP_NTZ, load_date DATE",
        key=("order_id", "load_date"), partition="load_date",
        required=("order_id", "user_id", "product_id", "quantity", "unit_price", "revenue",
                  "order_ts", "status", "load_date"),
        max_length={"order_id": 256, "user_id": 256, "product_id": 256, "status": 50},
    ),
    TableContract(
        "staging.events_clean", "daily",
        "event_id STRING, user_id STRING, product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, load_date DATE",
        key=("event_id", "load_date"), partition="load_date",
        required=("event_id", "user_id", "event_type", "event_ts", "load_date"),
        max_length={"event_id": 256, "user_id": 256, "product_id": 256, "event_type": 100},
    ),
    TableContract(
        "staging.products_clean", "daily",
        "product_id STRING, product_name STRING, category STRING, brand STRING, "
        "current_price DECIMAL(10,2), stock INT, discount_percentage DECIMAL(12,2), created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, load_date DATE",
        key=("product_id", "load_date"), partition="load_date",
        required=("product_id", "load_date"),
        max_length={"product_id": 256, "product_name": 512, "category": 256, "brand": 256},
    ),
    # The latest document of each order and load day as text, merged delivery by delivery.
    # The document itself stays only where it breaks a rule.
    TableContract(
        "staging.orders_latest", "keyed",
        "doc_order_id STRING, doc_user_id STRING, doc_product_id STRING, doc_quantity STRING, doc_price STRING, "
        "doc_timestamp STRING, doc_status STRING, file_name STRING, ingested_at TIMESTAMP_NTZ, raw_json STRING, "
        "delivery STRING, merged_in STRING, run_date DATE",
        key=("doc_order_id", "run_date"), partition="run_date", bucket_by=("doc_order_id",), spread_by="raw_json",
        required=("run_date",),
    ),
    # ---- warehouse: star schema ------------------------------------------------------
    TableContract(
        "warehouse.dim_date", "keyed",
        "date_id INT, date DATE, day INT, week INT, month INT, quarter INT, year INT, day_of_week INT, "
        "day_name STRING, is_weekend BOOLEAN",
        key=("date_id",), required=("date_id", "date"), max_length={"day_name": 10},
    ),
    TableContract(
        "warehouse.dim_user", "keyed",
        "user_id STRING, city STRING, signup_date DATE, marketing_source STRING, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        key=("user_id",), bucket_by=("user_id",), required=("user_id",),
        max_length={"user_id": 256, "city": 256, "marketing_source": 256},
    ),
    TableContract(
        "warehouse.dim_product", "keyed",
        "product_id STRING, product_name STRING, category STRING, brand STRING, "
        "current_price DECIMAL(10,2), stock INT, discount_percentage DECIMAL(12,2), effective_from DATE, effective_to DATE, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        key=("product_id",), bucket_by=("product_id",), required=("product_id",),
        max_length={"product_id": 256, "product_name": 512, "category": 256, "brand": 256},
    ),
    TableContract(
        "warehouse.dim_product_history", "keyed",
        "product_id STRING, product_name STRING, category STRING, brand STRING, "
        "current_price DECIMAL(10,2), stock INT, discount_percentage DECIMAL(12,2), effective_from DATE, effective_to DATE",
        key=("product_id", "effective_from"), bucket_by=("product_id",), required=("product_id", "effective_from"),
    ),
    TableContract(
        "warehouse.fact_orders", "daily",
        "order_id STRING, user_id STRING, product_id STRING, date_id INT, quantity INT, "
        "revenue DECIMAL(12,2), order_ts TIMESTAMP_NTZ, status STRING, load_date DATE",
        key=("order_id", "load_date"), identity="fact_orders_id", partition="load_date", split="date_id",
        required=("order_id", "user_id", "product_id", "date_id", "quantity", "revenue", "order_ts",
                  "load_date"),
        max_length={"order_id": 256, "user_id": 256, "product_id": 256, "status": 50},
        references={"date_id": "warehouse.dim_date", "user_id": "warehouse.dim_user", "product_id": "warehouse.dim_product"},
    ),
    TableContract(
        "warehouse.fact_events", "daily",
        "event_id STRING, user_id STRING, product_id STRING, date_id INT, event_type STRING, "
        "event_ts TIMESTAMP_NTZ, load_date DATE",
        key=("event_id", "load_date"), identity="fact_events_id", partition="load_date", split="date_id",
        required=("event_id", "user_id", "date_id", "event_type", "event_ts", "load_date"),
        max_length={"event_id": 256, "user_id": 256, "product_id": 256, "event_type": 100},
        references={"date_id": "warehouse.dim_date", "user_id": "warehouse.dim_user"},
    ),
    TableContract(
        "warehouse.daily_metrics", "keyed",
        "run_date DATE, raw_orders_count BIGINT, staging_orders_count BIGINT, fact_orders_count BIGINT, "
        "raw_events_count BIGINT, staging_events_count BIGINT, fact_events_count BIGINT, "
        "dq_failed_count BIGINT, runtime_seconds BIGINT",
        key=("run_date",), required=("run_date",),
    ),
    TableContract(
        "warehouse.mv_daily_orders_summary", "daily",
        "date_id INT, order_count BIGINT, daily_revenue DECIMAL(22,2), units_sold BIGINT, load_date DATE",
        key=("date_id", "load_date"), partition="load_date", required=("date_id",),
    ),
    TableContract(
        "warehouse.mv_daily_revenue", "daily",
        "order_date DATE, daily_revenue DECIMAL(22,2), load_date DATE",
        key=("order_date", "load_date"), partition="load_date", required=("order_date",),
    ),
    # Paid orders by user and load day; a folder holds a month of load days.
    TableContract(
        "warehouse.mv_user_orders", "daily",
        "user_id STRING, order_rows BIGINT, revenue DECIMAL(22,2), revenue_rows BIGINT, first_order_ts TIMESTAMP_NTZ, "
        "last_order_ts TIMESTAMP_NTZ, load_date DATE, load_month DATE",
        key=("user_id", "load_date"), partition="load_month", required=("user_id", "load_date"),
    ),
    # Fact rows of order ids that were loaded on more than one day.
    TableContract(
        "warehouse.recurring_orders", "keyed",
        "order_id STRING, load_date DATE, user_id STRING, status STRING",
        key=("order_id", "load_date"), bucket_by=("order_id",), required=("order_id", "load_date"),
    ),
    # ---- audit ------------------------------------------------------------------------
    TableContract(
        "audit.dq_failures", "daily",
        "check_name STRING, check_type STRING, failed_count BIGINT, failure_message STRING, "
        "details STRING, run_date DATE",
        key=("run_date", "check_name"), partition="run_date", required=("run_date", "check_name"),
    ),
    TableContract(
        "audit.constraint_report", "daily",
        "table_name STRING, constraint_name STRING, checked BIGINT, violations BIGINT, run_date DATE",
        key=("run_date", "table_name", "constraint_name"), partition="run_date",
        required=("run_date", "table_name", "constraint_name"),
    ),
    TableContract(
        "audit.bad_records", "daily",
        "source_table STRING, record_id STRING, failure_reason STRING, failed_value STRING, "
        "raw_data STRING, stage STRING, run_date DATE",
        partition="run_date", within="stage", required=("run_date", "source_table", "failure_reason"),
    ),
    # Events that came after a stream had forgotten their ids, until the daily load takes them.
    TableContract(
        "audit.late_events", "append",
        "file_name STRING, ingested_at TIMESTAMP_NTZ, raw_line STRING, event_id STRING, user_id STRING, "
        "product_id STRING, event_type STRING, event_ts TIMESTAMP_NTZ, run_date DATE",
        partition="run_date", within="delivery", required=("run_date", "ingested_at"),
        max_length={"event_id": 256, "user_id": 256, "product_id": 256, "event_type": 100},
    ),
    TableContract(
        "audit.stream_progress", "append", "stream STRING, batch_id BIGINT, max_event_ts TIMESTAMP_NTZ, run_date DATE",
        partition="run_date", required=("run_date", "stream", "batch_id"),
    ),
    TableContract(
        "audit.merged_deliveries", "append", "delivery STRING, run_date DATE",
        partition="run_date", required=("run_date", "delivery"),
    ),
    TableContract(
        "audit.pipeline_runs", "append",
        "dag_id STRING, task_id STRING, execution_date TIMESTAMP_NTZ, status STRING, "
        "started_at TIMESTAMP_NTZ, ended_at TIMESTAMP_NTZ, duration_seconds BIGINT, "
        "error_message STRING, run_date DATE",
        partition="run_date", required=("run_date", "execution_date", "status"),
    ),
]

CONTRACTS: dict[str, TableContract] = {c.name: c for c in _ALL}
