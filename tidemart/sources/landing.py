"""Landed files -> raw-layer DataFrames.

Folder layout, one folder or file per day::

    <root>/incoming/orders/<date>/      JSON: root objects or arrays
    <root>/incoming/events/<date>/      CSV with a header
    <root>/incoming/products/products_<date>.json

Feeds land one document (or one array) per line, which Spark splits freely.  A file that
is one pretty-printed JSON array can only be read as a whole (``whole_file=True``), so one
such file must fit in a task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_column, event_identity, raw_line
from tidemart.functions.exprs import DateLike
from tidemart.schemas import CONTRACTS

EVENT_FIELDS = ("event_id", "user_id", "product_id", "event_type", "event_ts")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    matches = fs.globStatus(target)
    return matches is not None and len(matches) > 0


def landing_path(root: str, kind: str, run_date: DateLike) -> str:
    """Where the files of one kind and day land."""
    base = f"{root.rstrip('/')}/incoming/{kind}"
    if kind == "products":
        return f"{base}/products_{run_date}.json"
    return f"{base}/{run_date}"


def landed_days(spark: SparkSession, root: str, kind: str, first: DateLike, last: DateLike) -> dict[str, str]:
    """The days from ``first`` to ``last`` that have landed, with their paths; one folder listing.

    A folder may also be named ``<column>=<day>``, as Spark writes partitions.  A catalogue
    snapshot counts on its day of the week only.
    """
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/incoming/{kind}")
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(parent)] if fs.exists(parent) else []
    paths = {name.rpartition("=")[2]: f"{root.rstrip('/')}/incoming/{kind}/{name}" for name in names}
    day, stop, found = dt.date.fromisoformat(str(first)), dt.date.fromisoformat(str(last)), {}
    while day <= stop:
        name = landing_path(root, kind, day).rsplit("/", 1)[1]
        if name in paths and (kind != "products" or is_weekly_snapshot_day(day)):
            found[str(day)] = paths[name]
        day += dt.timedelta(days=1)
    return found


def day_of_path(path: Column, kind: str) -> Column:
    """The day in the path of a landed file."""
    return F.to_date(F.regexp_extract(path, rf"/incoming/{kind}/(?:[^/=]+(?:=|%3D))?(?:products_)?(\d{{4}}-\d{{2}}-\d{{2}})(?:\.json)?(?:/|$)", 1))


def is_weekly_snapshot_day(run_date: dt.date | str) -> bool:
    """Catalogue snapshots land on Mondays."""
    return dt.date.fromisoformat(str(run_date)).weekday() == 0


def weekly_snapshot_filter(df: DataFrame, day: str) -> DataFrame:
    """The rows whose day is a Monday."""
    return df.filter(F.weekday(F.col(day)) == 0)


def documents(text: Column) -> Column:
    """Split JSON text into one string per document; a root object is one document as it is.

    ``array<string>`` keeps each element's own text, with unknown keys and nulls.  Text
    that is neither stays one (unreadable) document, so that staging can quarantine it
    instead of losing it here; blank lines hold no document.
    """
    body = F.trim(text)
    elements = F.coalesce(F.from_json(body, "array<string>"), F.array(body))
    return F.explode(
        F.when(body == "", F.array().cast("array<string>"))
        .when(body.startswith("{"), F.array(body))
        .otherwise(elements)
    )


def read_json_documents(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    """JSON files -> (file_name, raw_json), one row per document."""
    lines = spark.read.text(path, wholetext=whole_file)
    return lines.select(
        F.col("_metadata.file_path").alias("file_name"), documents(F.col("value")).alias("raw_json")
    )


def _empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], CONTRACTS[table].ddl)


def _stamp(ingested_at: Column | None) -> Column:
    return (F.current_timestamp() if ingested_at is None else ingested_at).cast("timestamp_ntz")


def read_orders(
    spark: SparkSession, path: str, run_date: DateLike, *, whole_file: bool = False,
    ingested_at: Column | None = None,
) -> DataFrame:
    """One day's order documents as ``raw.orders_json`` rows; a missing path gives no rows."""
    if not path_exists(spark, path):
        return _empty(spark, "raw.orders_json")
    return read_json_documents(spark, path, whole_file).select(
        "file_name", _stamp(ingested_at).alias("ingested_at"), "raw_json",
        day_column(run_date).alias("run_date"),
    )


def read_products(
    spark: SparkSession, path: str, run_date: DateLike, *, whole_file: bool = False,
    ingested_at: Column | None = None,
) -> DataFrame:
    """One catalogue snapshot as ``raw.products_json`` rows; a missing path gives no rows."""
    if not path_exists(spark, path):
        return _empty(spark, "raw.products_json")
    return read_json_documents(spark, path, whole_file).select(
        _stamp(ingested_at).alias("fetched_at"), "raw_json", day_column(run_date).alias("run_date")
    )


def shape_events(rows: DataFrame, file_name: Column, run_date: DateLike,
                 ingested_at: Column | None = None, line_columns: list[str] | None = None) -> DataFrame:
    """String event records -> ``raw.events_csv`` rows (works on batch and stream alike).

    ``line_columns`` are the columns of the source line in file order.  An event time
    that cannot be read becomes NULL; the line keeps what was delivered.
    """
    columns = line_columns or [c for c in rows.columns if not c.startswith("_")]
    present = {f: F.coalesce(F.col(f), F.lit("")) if f in columns else F.lit(None).cast("string")
               for f in EVENT_FIELDS}
    line = raw_line(columns)
    return rows.select(
        file_name.alias("file_name"),
        _stamp(ingested_at).alias("ingested_at"),
        line.alias("raw_line"),
        event_identity(present["event_id"], line).alias("event_id"),
        present["user_id"].alias("user_id"),
        present["product_id"].alias("product_id"),
        present["event_type"].alias("event_type"),
        present["event_ts"].try_cast("timestamp_ntz").alias("event_ts"),
        day_column(run_date).alias("run_date"),
    )


def read_events(
    spark: SparkSession, path: str, run_date: DateLike, *, ingested_at: Column | None = None
) -> DataFrame:
    """One day's event CSV as ``raw.events_csv`` rows; columns are found by header name."""
    if not path_exists(spark, path):
        return _empty(spark, "raw.events_csv")
    return _events_of(spark, [path], lambda file: day_column(run_date), ingested_at)


def _events_of(spark: SparkSession, paths: list[str], day: Callable[[Column], Column],
               ingested_at: Column | None) -> DataFrame:
    """Event CSV files under some paths; ``day`` gives the run date of a file path."""
    parts = []
    for header, files in sorted(files_by_header(spark, paths).items()):
        # All columns are read as text: no inference pass over the data.
        rows = spark.read.csv(files, header=True, escape='"', enforceSchema=False)
        tagged = rows.select("*", F.col("_metadata.file_path").alias("_file"))
        parts.append(shape_events(tagged, F.col("_file"), day(F.col("_file")), ingested_at, rows.columns))
    return reduce(DataFrame.unionByName, parts) if parts else _empty(spark, "raw.events_csv")


def files_by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The CSV files under some paths by their first line, so that each group has one column order.

    The first lines are read in tasks: rows of a file's first block come in their order, so
    the first is the one with the least running number, kept by a partial aggregation.
    Only names and distinct first lines reach the driver; a day has one file per delivery.
    The pass reads lines without parsing them.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("nth")).filter("start = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    # Metadata paths are URL-encoded; a byte order mark is not part of the first column's name.
    first = first.select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"), F.ltrim("header", F.lit("\ufeff")).alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.collect():
        groups.setdefault(row.header, []).append(row.file)
    return groups


def read_days(spark: SparkSession, root: str, kind: str, first: DateLike, last: DateLike, *,
              whole_file: bool = False, ingested_at: Column | None = None) -> DataFrame:
    """All landed days from ``first`` to ``last`` in one scan, as rows of the kind's raw table.

    The day of a row comes from its file's path.  Kinds: orders, events, products.
    """
    table = {"orders": "raw.orders_json", "events": "raw.events_csv", "products": "raw.products_json"}[kind]
    paths = list(landed_days(spark, root, kind, first, last).values())
    if not paths:
        return _empty(spark, table)
    if kind == "events":
        return _events_of(spark, paths, lambda file: day_of_path(file, kind), ingested_at)
    rows = read_json_documents(spark, paths, whole_file).withColumn("run_date", day_of_path(F.col("file_name"), kind))
    stamp = _stamp(ingested_at).alias("ingested_at" if kind == "orders" else "fetched_at")
    return rows.select("*", stamp).select(*CONTRACTS[table].column_names)


def first_available(*candidates: DataFrame) -> DataFrame:
    """The first source that has rows (file first, then the alternatives)."""
    for candidate in candidates[:-1]:
        if not candidate.isEmpty():
            return candidate
    return candidates[-1]
