"""Raw -> staging: keep the latest copy per key, type it, split off what breaks the contract."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemart.functions import blank_to_null, day_column
from tidemart.functions.exprs import DateLike
from tidemart.schemas import CONTRACTS, EVENT_TYPES

ORDER_FIELDS = ("order_id", "user_id", "product_id", "quantity", "price", "timestamp", "status")
PRODUCT_FIELDS = ("product_id", "product_name", "category", "brand", "current_price", "stock", "discount_percentage")
BAD_RECORD_COLUMNS = ["source_table", "record_id", "failure_reason", "failed_value", "raw_data", "run_date"]


class ContractViolation(ValueError):
    """A strict load met a record that breaks its table contract."""


@dataclass
class Staged:
    """The two halves of a staging load: rows that pass, and one row per violation.

    Both are filters over ``typed``, which holds every row with its problems; write it once
    (``divide``) when both halves are wanted.
    """

    good: DataFrame
    bad: DataFrame
    typed: DataFrame


def keep_latest(df: DataFrame, keys: list[str], newest_first: list[Column], follower: str | None = None) -> DataFrame:
    """One row per key: the first under ``newest_first``.

    ``row_number() = 1`` lets Spark drop all but one row per key in each map task
    (WindowGroupLimit) before the shuffle, so even a key that holds a third of the input
    sends one row per task.  ``newest_first`` must end in a tiebreak.

    Sorting compares a short prefix of the first key only, and text keys tend to begin
    alike, so a hash of the keys goes in front of them.

    ``follower`` names a column whose value in the second row of each key comes along as
    ``_follower``; two rows of a key pass the limit then.
    """
    by = keys
    if isinstance(df.schema[keys[0]].dataType, StringType):
        df, by = df.withColumn("_hash", F.xxhash64(*keys)), ["_hash", *keys]
    order = W.partitionBy(*by).orderBy(*newest_first)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    if follower:
        ranked = ranked.filter("_rank <= 2").withColumn("_follower", F.lead(follower).over(order))
    return ranked.filter("_rank = 1").drop("_rank", "_hash")


def keep_latest_or_lone(df: DataFrame, key: str, others: list[str], newest_first: list[Column],
                        follower: str | None = None) -> DataFrame:
    """``keep_latest`` that lets every row without a ``key`` through, in the same pass.

    Such a row gets a number of its own, which serves no other purpose than to make it a
    group of one; the numbers also spread these rows, however many there are.
    """
    lone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return keep_latest(df.withColumn("_lone", lone), [key, "_lone", *others], newest_first, follower).drop("_lone")


def slice_of(df: DataFrame, run_date: DateLike, column: str = "run_date") -> DataFrame:
    """One day's slice, or every slice when no date is given."""
    return df if run_date is None else df.filter(F.col(column) == day_column(run_date))


def _problem(condition: Column, reason: str, value: Column) -> Column:
    return F.when(
        condition, F.struct(F.lit(reason).alias("reason"), value.cast("string").alias("value"))
    )


def divide(typed: DataFrame, table: str, source: str, record_id: str, raw: str, strict: bool = False) -> Staged:
    """Split typed rows by their ``_problems``."""
    columns = CONTRACTS[table].column_names
    if strict:
        message = F.concat(
            F.lit(f"{source}: "), F.coalesce(record_id, F.lit("")), F.lit(": "),
            F.array_join(F.transform("_problems", lambda p: p["reason"]), "; "),
        )
        # A row without a key cannot be loaded in any mode: it is set aside.
        passed = F.when(F.size("_problems") == 0, F.lit(True)).when(F.col(record_id).isNull(), F.lit(False)).otherwise(
            F.raise_error(message).cast("boolean"))
        good = typed.filter(passed)
    else:
        good = typed.filter(F.size("_problems") == 0)
    return Staged(good.select(*columns), _bad_rows(typed, source, record_id, raw, "load_date"), typed)


# Where the halves of each staging table go: (source table, record id, raw column).
SOURCES = {
    "staging.orders_clean": ("raw.orders_json", "order_id", "raw_json"),
    "staging.events_clean": ("raw.events_csv", "event_id", "raw_line"),
    "staging.products_clean": ("raw.products_json", "product_id", "raw_json"),
}


def _bad_rows(df: DataFrame, source: str, record_id: str, raw: str, day: str) -> DataFrame:
    rows = df.select(
        F.lit(source).alias("source_table"), F.col(record_id).alias("record_id"),
        F.explode("_problems").alias("_p"), F.col(raw).alias("raw_data"), F.col(day).alias("run_date"),
    )
    return rows.select(
        "source_table", "record_id", F.col("_p.reason").alias("failure_reason"),
        F.col("_p.value").alias("failed_value"), "raw_data", "run_date",
    )


def _split(df: DataFrame, table: str, strict: bool) -> Staged:
    return divide(df, table, *SOURCES[table], strict)


def _key_missing(record_id: str) -> list[Column]:
    """The one problem of a row without a key; its other fields are not judged."""
    return [_problem(F.lit(True), f"{record_id} missing", F.lit(None))]


def _with_key_problems(df: DataFrame, record_id: str, raw: str, problems: list[Column]) -> DataFrame:
    """Rows with their problems.  Raw text stays only where there are any."""
    keyed, alone = (F.array_compact(F.array(*p)) for p in (problems, _key_missing(record_id)))
    checked = df.withColumn("_problems", F.when(F.col(record_id).isNull(), alone).otherwise(keyed))
    return checked.withColumn(raw, F.when(F.size("_problems") > 0, F.col(raw))) \
        .drop(*[c for c in df.columns if c.startswith("doc_")])


def _too_long(table: str, columns: dict[str, Column]) -> list[Column]:
    return [
        _problem(F.char_length(col) > CONTRACTS[table].max_length[name], f"{name} too long", col)
        for name, col in columns.items()
        if name in CONTRACTS[table].max_length
    ]


def _stamps(at: Column | None) -> list[Column]:
    stamp = (F.current_timestamp() if at is None else at).cast("timestamp_ntz")
    return [stamp.alias("created_at"), stamp.alias("updated_at")]


def document_fields(raw: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Top-level fields of a JSON document as text columns ``doc_<field>``.

    ``json_tuple`` reads each document once.  Being a generator it also keeps filters on
    its output from being pushed below it, which would parse every document twice.
    """
    return raw.select("*", F.json_tuple("raw_json", *fields).alias(*[f"doc_{f}" for f in fields]))


def order_documents(raw: DataFrame) -> DataFrame:
    """Order documents with their fields as text."""
    return document_fields(raw, ORDER_FIELDS)


def latest_orders(docs: DataFrame, tiebreak: list[Column] | None = None, follower: str | None = None) -> DataFrame:
    """The newest document per order id and day, still untyped; documents without an id all stay.

    Copies that arrive at the same moment are told apart by their fields, so the document
    text itself need not be shuffled unless it is asked for.
    """
    ties = tiebreak or [F.col("file_name").desc(), *[F.col(f"doc_{f}").desc() for f in ORDER_FIELDS[1:]]]
    return keep_latest_or_lone(docs, "doc_order_id", ["run_date"], [F.col("ingested_at").desc(), *ties], follower)


def stage_orders(
    raw: DataFrame, run_date: DateLike = None, *, strict: bool = False,
    loaded_at: Column | None = None, tiebreak: list[Column] | None = None,
) -> Staged:
    """Typed, deduplicated orders of one day (or of every day, each in its own slice).

    Revenue is quantity times the price as delivered; only the stored result is rounded.
    """
    docs = order_documents(slice_of(raw, run_date))
    # Tiebreaks may look into the text of any document; only that of a broken one goes through the shuffle.
    latest = latest_orders(docs.withColumn("_text", order_text()), tiebreak)
    return type_orders(latest.withColumn("raw_json", F.col("_text")).drop("_text"), strict=strict, loaded_at=loaded_at)


def _order_values() -> dict[str, Column]:
    """The typed columns of an order from the text columns ``doc_<field>``."""
    d = {f: F.col(f"doc_{f}") for f in ORDER_FIELDS}
    quantity = d["quantity"].try_cast("int")
    exact_price = d["price"].try_cast("decimal(26,12)")
    return {
        "order_id": d["order_id"], "user_id": d["user_id"], "product_id": d["product_id"],
        "quantity": quantity,
        "unit_price": exact_price.try_cast("decimal(10,2)"),
        "revenue": (quantity * exact_price).try_cast("decimal(12,2)"),
        "order_ts": d["timestamp"].try_cast("timestamp_ntz"),
        "status": d["status"],
    }


def _order_problems(v: dict[str, Column]) -> list[Column]:
    """What breaks the contract of an order, from its typed columns and the text they came from."""
    d = {f: F.col(f"doc_{f}") for f in ORDER_FIELDS}
    return [
        _problem(v["user_id"].isNull(), "user_id missing", F.lit(None)),
        _problem(v["product_id"].isNull(), "product_id missing", F.lit(None)),
        _problem(v["quantity"].isNull(), "quantity missing or not an integer", d["quantity"]),
        _problem(v["unit_price"].isNull(), "price missing or out of range", d["price"]),
        _problem(
            v["revenue"].isNull() & v["quantity"].isNotNull() & v["unit_price"].isNotNull(),
            "revenue out of range", F.concat_ws(" x ", d["quantity"], d["price"])),
        _problem(v["order_ts"].isNull(), "timestamp missing or unreadable", d["timestamp"]),
        _problem(v["status"].isNull(), "status missing", F.lit(None)),
        *_too_long("staging.orders_clean", {c: v[c] for c in ("order_id", "user_id", "product_id", "status")}),
    ]


def order_text() -> Column:
    """The text of an untyped order document if something is wrong with it, else NULL.

    Staging keeps no other text, so what is shuffled before it need not carry more.
    """
    problems = [p.isNotNull() for p in _order_problems(_order_values())]
    return F.when(F.col("doc_order_id").isNull() | reduce(Column.__or__, problems), F.col("raw_json"))


def type_orders(latest: DataFrame, *, strict: bool = False, loaded_at: Column | None = None,
                carry: list[str] | None = None) -> Staged:
    """Typed orders from the latest document of each, whose fields are text columns ``doc_<field>``.

    Columns named in ``carry`` come along in ``typed`` as a struct ``_carried``.
    """
    table = "staging.orders_clean"
    values = _order_values()
    typed = latest.select(
        "raw_json", "doc_quantity", "doc_price", "doc_timestamp",
        *[value.alias(name) for name, value in values.items()],
        *_stamps(loaded_at),
        F.col("run_date").alias("load_date"),
        *([F.struct(*carry).alias("_carried")] if carry else []),
    )
    problems = _order_problems({name: F.col(name) for name in values})
    return _split(_with_key_problems(typed, "order_id", "raw_json", problems), table, strict)


def stage_events(
    raw: DataFrame, run_date: DateLike = None, *, strict: bool = False, check_types: bool = False,
    loaded_at: Column | None = None, tiebreak: list[Column] | None = None,
) -> Staged:
    """Cleaned events: lower-case type, empty product as NULL, one row per event id and day."""
    table = "staging.events_clean"
    day = slice_of(raw, run_date)
    ties = tiebreak or [F.col("file_name").desc(), F.col("raw_line").desc()]
    latest = keep_latest_or_lone(day, "event_id", ["run_date"], [F.col("ingested_at").desc(), *ties])
    typed = latest.select(
        "raw_line", "event_id", "user_id",
        blank_to_null(F.col("product_id")).alias("product_id"),
        F.lower("event_type").alias("event_type"),
        "event_ts",
        *_stamps(loaded_at),
        F.col("run_date").alias("load_date"),
    )
    problems = [
        _problem(F.col("user_id").isNull(), "user_id missing", F.lit(None)),
        _problem(F.col("event_ts").isNull(), "event_ts missing or unreadable", F.col("raw_line")),
        _problem(F.col("event_type").isNull(), "event_type missing", F.lit(None)),
        *_too_long(table, {c: F.col(c) for c in ("event_id", "user_id", "product_id", "event_type")}),
    ]
    if check_types:
        unknown = ~F.col("event_type").isin(*EVENT_TYPES)
        problems.append(_problem(unknown, "event_type unknown", F.col("event_type")))
    return _split(_with_key_problems(typed, "event_id", "raw_line", problems), table, strict)


def stage_products(
    raw: DataFrame, run_date: DateLike = None, *, strict: bool = False,
    loaded_at: Column | None = None, tiebreak: list[Column] | None = None,
) -> Staged:
    """Typed catalogue rows, one per product id and day."""
    table = "staging.products_clean"
    docs = document_fields(slice_of(raw, run_date), PRODUCT_FIELDS)
    ties = tiebreak or [F.col(f"doc_{f}").desc() for f in PRODUCT_FIELDS[1:]]
    latest = keep_latest_or_lone(docs, "doc_product_id", ["run_date"], [F.col("fetched_at").desc(), *ties])
    price, stock, discount = (F.col(f"doc_{c}") for c in ("current_price", "stock", "discount_percentage"))
    typed = latest.select(
        "raw_json", "doc_current_price", "doc_stock", "doc_discount_percentage",
        *[F.col(f"doc_{c}").alias(c) for c in PRODUCT_FIELDS[:4]],
        price.try_cast("decimal(26,12)").try_cast("decimal(10,2)").alias("current_price"),
        stock.try_cast("int").alias("stock"),
        discount.try_cast("decimal(26,12)").try_cast("decimal(12,2)").alias("discount_percentage"),
        *_stamps(loaded_at),
        F.col("run_date").alias("load_date"),
    )
    problems = [
        _problem(price.isNotNull() & F.col("current_price").isNull(), "price out of range", price),
        _problem(stock.isNotNull() & F.col("stock").isNull(), "stock not an integer", stock),
        _problem(discount.isNotNull() & F.col("discount_percentage").isNull(), "discount out of range", discount),
        *_too_long(table, {c: F.col(c) for c in ("product_id", "product_name", "category", "brand")}),
    ]
    return _split(_with_key_problems(typed, "product_id", "raw_json", problems), table, strict)
