"""Keyed merges as DataFrame expressions: upsert, insert-if-absent, versioned history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import day_column
from tidemart.functions.exprs import DateLike


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str],
           keep: list[str] | None = None) -> DataFrame:
    """``current`` with ``incoming`` merged in; both are unique by ``keys``.

    A matched row takes every incoming value, NULLs too, except the columns in ``keep``
    (set on first insert only) and columns the incoming side does not have.
    """
    keep = keep or []
    mark = incoming.withColumn("_new", F.lit(True)).alias("n")
    joined = current.withColumn("_old", F.lit(True)).alias("o").join(mark, keys, "full_outer")
    out: list[Column] = []
    for name in current.columns:
        if name in keys:
            out.append(F.col(name))
        elif name not in incoming.columns:
            out.append(F.col(f"o.{name}"))
        elif name in keep:
            out.append(F.when(F.col("_old"), F.col(f"o.{name}")).otherwise(F.col(f"n.{name}")).alias(name))
        else:
            out.append(F.when(F.col("_new"), F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name))
    return joined.select(*out)


def insert_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` plus the incoming rows whose key it does not have yet."""
    fresh = incoming.join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh.select(*current.columns))


def merge_history(history: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
                  as_of: DateLike) -> DataFrame:
    """Close and open versions (half-open ``[effective_from, effective_to)``).

    A key in ``snapshot`` whose tracked columns differ from its open version closes that
    version at ``as_of`` and opens a new one; a new key opens its first version; keys not
    in the snapshot stay as they are.  Running the same day again changes nothing.
    """
    day = day_column(as_of)
    is_open = F.col("effective_to").isNull()
    closed = history.filter(~is_open)
    current = history.filter(is_open).withColumn("_old", F.lit(True)).alias("o")
    fresh = snapshot.select(*keys, *tracked).withColumn("_new", F.lit(True)).alias("n")
    both = current.join(fresh, keys, "full_outer")

    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    changed = matched & ~same
    # A second correction on the day a version began replaces it instead of leaving an
    # empty interval behind.
    same_day = changed & (F.col("o.effective_from") == day)

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in tracked],
            start.alias("effective_from"), end.cast("date").alias("effective_to"),
        )

    old_open = F.when(
        F.col("_old").isNotNull() & ~same_day,
        version("o", F.col("o.effective_from"), F.when(changed, day)),
    )
    new_open = F.when(F.col("_old").isNull() | changed, version("n", day, F.lit(None)))
    rows = both.select(*keys, F.explode(F.array_compact(F.array(old_open, new_open))).alias("v"))
    return closed.unionByName(rows.select(*keys, "v.*").select(*history.columns))


def history_from_snapshots(snapshots: DataFrame, keys: list[str], tracked: list[str],
                           day: str = "load_date") -> DataFrame:
    """The same history, built in one pass from all snapshots (one row per key and day).

    The window holds one key's snapshots: at most one row per calendar day.
    """
    from pyspark.sql import Window as W

    by_key = W.partitionBy(*keys).orderBy(day)
    state = F.struct(*tracked)
    previous = F.lag(state).over(by_key)
    starts = snapshots.withColumn("_prev", previous).withColumn("_first", F.row_number().over(by_key) == 1)
    starts = starts.filter(F.col("_first") | ~state.eqNullSafe(F.col("_prev")))
    return starts.select(
        *keys, *tracked, F.col(day).alias("effective_from"),
        F.lead(day).over(by_key).alias("effective_to"),
    )


def merge_snapshots(history: DataFrame, snapshots: DataFrame, keys: list[str], tracked: list[str],
                    day: str = "load_date") -> DataFrame:
    """``merge_history`` of many days' snapshots in one pass: the same versions as day by day.

    An open version takes part as the snapshot of the day it began; a snapshot of that very
    day replaces it.  Snapshots from before an open version are left out: its past is closed.
    """
    is_open = F.col("effective_to").isNull()
    start = history.filter(is_open).select(*keys, *tracked, F.col("effective_from").alias(day), F.lit(0).alias("_rank"))
    fresh = snapshots.select(*keys, *tracked, day, F.lit(1).alias("_rank"))
    began = start.select(*keys, F.col(day).alias("_began"))
    fresh = fresh.join(began, keys, "left").filter(F.col("_began").isNull() | (F.col(day) >= F.col("_began"))).drop("_began")
    states = start.unionByName(fresh).groupBy(*keys, day).agg(F.max_by(F.struct(*tracked), "_rank").alias("_state"))
    versions = history_from_snapshots(states.select(*keys, day, "_state.*"), keys, tracked, day)
    return history.filter(~is_open).unionByName(versions.select(*history.columns))


def as_of_version(facts: DataFrame, history: DataFrame, key: str, at: str, bucket_days: int = 32) -> DataFrame:
    """Each fact row with the version of ``key`` valid at its ``at`` time (inner join).

    Time is cut into buckets of days.  The buckets in which a key occurs (a distinct over
    two columns) meet its versions first: what comes out are the few versions that overlap
    a bucket.  The fact rows then join by key and bucket, and the range is checked among
    those.  So the rows of one busy product spread over its buckets instead of one task, and
    none of them is compared with a thousand versions.  Facts without a time match nothing.
    """
    rows = facts.withColumn("_bucket", F.floor(F.unix_date(F.col(at).cast("date")) / bucket_days).cast("int"))
    met = rows.select(F.col(key).alias("_key"), F.col("_bucket").alias("_met")).distinct()
    first_day = F.date_from_unix_date(F.col("_met") * bucket_days)
    overlaps = (F.col("effective_from") < F.date_add(first_day, bucket_days)) \
        & (F.col("effective_to").isNull() | (F.col("effective_to") > first_day))
    versions = met.join(history.withColumnRenamed(key, "_key"), "_key").filter(overlaps)
    at_time = F.col(at).cast("timestamp_ntz")
    starts, ends = (F.col(c).cast("timestamp_ntz") for c in ("effective_from", "effective_to"))
    valid = (at_time >= starts) & (ends.isNull() | (at_time < ends))
    same = (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_met"))
    return rows.join(versions, same & valid, "inner").drop("_key", "_met", "_bucket")
