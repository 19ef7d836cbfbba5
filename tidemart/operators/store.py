"""The table store: Parquet tables per layer with idempotent day reloads and keyed merges.

Plain Parquet has no MERGE or DELETE, so each kind of table is written in the way that
survives a lost executor or a killed driver:

* ``append`` tables only ever gain files, raw ones a folder for each delivery, which a
  replay of the same delivery replaces;
* ``daily`` tables replace whole day partitions (dynamic overwrite).  The commit deletes
  and renames folders, which is not atomic on object stores: a rerun of the day repairs
  what a driver left when it died in the middle of it;
* ``keyed`` tables write each state as a new version folder; the newest version that
  finished is the current one, and no folder is overwritten while it is being read;
* large ``keyed`` tables (``bucket_by``) are partitioned by a hash bucket of their key, some
  by day and bucket, and a merge rewrites the buckets that its keys fall into.  The new rows are first written
  aside: what a driver left when it died while replacing buckets is finished by the next
  write or by ``recover``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import day_column
from tidemart.functions.exprs import surrogate_id
from tidemart.operators import merge
from tidemart.schemas import CONTRACTS, TableContract
from tidemart.sources.landing import path_exists

# How long a replaced version of a keyed table stays, for readers and views that hold it.
KEPT_FOR = dt.timedelta(days=1)
# Hash buckets of a new bucketed table; a table keeps the number it was created with.
BUCKETS = 64
# Documents and keys shrink to about half of what the default codec leaves.
CODEC = "zstd"


class TableStore:
    """Tables under one root folder, laid out as ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str, kept_for: dt.timedelta = KEPT_FOR, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.kept_for = kept_for
        self.buckets = buckets

    # ---- locations ---------------------------------------------------------------
    def contract(self, name: str) -> TableContract:
        return CONTRACTS[name]

    def path(self, name: str) -> str:
        layer, table = self.contract(name).name.split(".")
        return f"{self.root}/{layer}/{table}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _drop(self, path: str) -> None:
        target, fs = self._fs(path)
        fs.delete(target, True)

    def _move_folders(self, source: str, target: str, levels: int) -> None:
        """Let the partition folders of ``source`` take the place of those of the same name.

        A folder that was moved is gone from ``source``, so doing so again goes on where it
        ended.  Folders are renamed, as a dynamic overwrite commits its own.
        """
        for name in self._folders(source):
            if "=" not in name:
                continue
            if levels > 1:
                self._move_folders(f"{source}/{name}", f"{target}/{name}", levels - 1)
                continue
            new, fs = self._fs(f"{source}/{name}")
            old, _ = self._fs(f"{target}/{name}")
            fs.delete(old, True)
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise RuntimeError(f"{new} could not be moved to {old}")

    def drop_scratch(self, path: str) -> None:
        """Take away a folder that a step wrote aside for itself, if it is there."""
        self._drop(path)

    def _finished(self, name: str) -> dict[int, int]:
        """Finished versions of a keyed table and when they finished (epoch milliseconds)."""
        pattern, fs = self._fs(f"{self.path(name)}/v=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return {int(s.getPath().getParent().getName().removeprefix("v=")): s.getModificationTime() for s in found}

    def _versions(self, name: str) -> list[int]:
        """Finished versions of a keyed table, oldest first."""
        return sorted(self._finished(name))

    def _folders(self, path: str) -> list[str]:
        target, fs = self._fs(path)
        if not fs.exists(target):
            return []
        return [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]

    def _version_path(self, name: str, version: int) -> str:
        return f"{self.path(name)}/v={version:08d}"

    def exists(self, name: str) -> bool:
        """Whether the table has been written."""
        if self.contract(name).bucket_by:
            # A whole write leaves _SUCCESS, also one without rows; replaced buckets leave none.
            return path_exists(self.spark, f"{self._bucket_root(name)[0]}/{{_SUCCESS,*=*}}")
        if self.contract(name).kind == "keyed":
            return bool(self._versions(name))
        return path_exists(self.spark, f"{self.path(name)}/*=*")

    def location(self, name: str) -> str | None:
        """The folder that holds the current rows, if any."""
        if self.contract(name).bucket_by:
            return self._bucket_root(name)[0] if self.exists(name) else None
        if self.contract(name).kind == "keyed":
            versions = self._versions(name)
            return self._version_path(name, versions[-1]) if versions else None
        return self.path(name) if self.exists(name) else None

    # ---- reading -----------------------------------------------------------------
    def read(self, name: str, identified: bool = False) -> DataFrame:
        """The table with its contract's columns; empty when nothing was written yet.

        ``identified`` adds the row id and load time that the store keeps with the rows of
        raw tables and facts.
        """
        contract = self.contract(name)
        ddl = contract.identified_ddl if identified else contract.ddl
        location = self.location(name)
        if location is None:
            return self.spark.createDataFrame([], ddl)
        extra = [contract.identity, "created_at"] if identified and contract.identity else []
        return self.spark.read.schema(ddl).parquet(location).select(*contract.column_names, *extra)

    @staticmethod
    def _identified(contract: TableContract, df: DataFrame, delivery: str | None = None) -> DataFrame:
        """Rows with the id and load time of a table that keeps them.

        The id of a row with a key is a digest of the key, the same after every rerun.  Raw
        rows have no key and may repeat: theirs counts the rows of the delivery.  Rows that
        come with a load time keep it.
        """
        if not contract.identity:
            return df
        if contract.key:
            row = surrogate_id(*contract.key)
        else:
            row = F.md5(F.concat_ws("\x1f", F.lit(delivery), F.monotonically_increasing_id().cast("string")).cast("binary"))
        now = F.current_timestamp().cast("timestamp_ntz")
        stamp = F.coalesce("created_at", now) if "created_at" in df.columns else now
        return df.withColumns({contract.identity: row, "created_at": stamp})

    @staticmethod
    def _kept_columns(contract: TableContract, df: DataFrame) -> list[str]:
        """The contract's columns, and the load time if the rows carry one."""
        return [*contract.column_names, *(["created_at"] if contract.identity and "created_at" in df.columns else [])]

    def scalar(self, df: DataFrame):
        """The first value of the first row, or None."""
        row = df.first()
        return None if row is None else row[0]

    def sql(self, query: str, **args):
        """Parameterized SQL over the published tables (``:name`` markers)."""
        return self.spark.sql(query, args=args)

    # ---- writing -----------------------------------------------------------------
    def append(self, name: str, df: DataFrame, delivery: str | None = None) -> int:
        """Add rows.  A named ``delivery`` can be repeated: it replaces its own rows and no others.

        Batch loads and streams write raw tables this way side by side, and every reader
        sees the rows of both.
        """
        contract, observed = self.contract(name), Observation()
        # The rows written are counted in the same job, not by a second pass.
        name_of_delivery = delivery or f"load-{uuid.uuid4().hex}"
        rows = self._identified(contract, df.select(*contract.column_names), name_of_delivery) \
            .observe(observed, F.count(F.lit(1)).alias("rows"))
        if contract.within:
            rows = rows.withColumn(contract.within, F.lit(name_of_delivery))
        writer = rows.write.option("compression", CODEC).partitionBy(*contract.partitions)
        if delivery and contract.within:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.parquet(self.path(name))
        return observed.get["rows"]

    def with_deliveries(self, name: str) -> DataFrame:
        """All rows of a raw table with the name of their delivery."""
        contract = self.contract(name)
        return self.spark.read.schema(f"{contract.ddl}, {contract.within} STRING").parquet(self.path(name))

    def deliveries(self, name: str, days: list[dt.date]) -> set[tuple[dt.date, str]]:
        """(day, delivery) of a raw table, from the folder names of some days."""
        contract = self.contract(name)
        return {(day, folder.removeprefix(f"{contract.within}=")) for day in days
                for folder in self._folders(f"{self.path(name)}/{contract.partition}={day}")}

    def splits(self, name: str, days: list[dt.date]) -> set[tuple[dt.date, int]]:
        """(day, second level) of a daily table, from the folder names of some days."""
        contract = self.contract(name)
        return {(day, int(folder.removeprefix(f"{contract.split}="))) for day in days
                for folder in self._folders(f"{self.path(name)}/{contract.partition}={day}")}

    def delivered(self, name: str, delivery: str) -> DataFrame:
        """The rows of one delivery, with the contract's columns."""
        contract = self.contract(name)
        return self.with_deliveries(name).filter(F.col(contract.within) == delivery).select(*contract.column_names)

    def reload_day(self, name: str, df: DataFrame, day: dt.date | str, within: str | None = None) -> int:
        """Replace one day of a daily table by ``df``, also when ``df`` is empty."""
        contract = self.contract(name)
        fixed = df.withColumn(contract.partition, day_column(day))
        if contract.within:
            fixed = fixed.withColumn(contract.within, F.lit(within))
        fixed = fixed.select(*contract.column_names)
        rows = self._overwrite_days(contract, fixed)
        if rows == 0:
            # A dynamic overwrite by no rows touches no partition, so the old rows have
            # to be taken away here.
            folder = f"{self.path(name)}/{contract.partition}={day}"
            self._drop(f"{folder}/{contract.within}={within}" if contract.within else folder)
        return rows

    def reload_days(self, name: str, df: DataFrame, days: list[dt.date] | None = None,
                    within: str | None = None) -> int:
        """Replace every day that occurs in ``df``, and empty those of ``days`` that do not.

        ``within`` names the writer where a table has one folder for each writer of a day:
        only that writer's rows are replaced.  The rebalance hint gathers each day into few
        files without letting a day that holds most of the rows become one task: AQE splits
        large partitions again.  A single day in one folder needs no gathering: it has a
        file for each task as it is.
        """
        contract = self.contract(name)
        if contract.within:
            df = df.withColumn(contract.within, F.lit(within))
        rows = df.select(*dict.fromkeys([*contract.column_names, *contract.partitions]))
        if days is None or len(days) > 1 or contract.split:
            rows = rows.hint("rebalance", *contract.partitions)
        if days is None:
            return self._overwrite_days(contract, rows)
        # The days written are observed in the same job; a calendar bounds their number.
        observed, fresh = Observation(), not self.exists(contract.name)
        self._day_writer(contract, rows.observe(
            observed, F.count(F.lit(1)).alias("rows"), F.collect_set(contract.partition).alias("days"),
            self._splits(contract).alias("splits")))
        for day in set(days) - set(observed.get["days"]):
            folder = f"{self.path(name)}/{contract.partition}={day}"
            self._drop(f"{folder}/{contract.within}={within}" if contract.within else folder)
        if not fresh:
            self._drop_stale(contract, observed.get["splits"])
        return observed.get["rows"]

    def replace_folders(self, name: str, df: DataFrame, touched: list[tuple]) -> int:
        """Replace some innermost folders of a daily table by ``df``, which may read them.

        ``touched`` holds the partition values of each folder.  The rows are written aside
        first, so that a driver that dies here leaves either the old folders or, after
        ``recover``, the new ones.
        """
        contract, observed = self.contract(name), Observation()
        self._recover_folders(name)
        values = F.collect_set(F.array(*[F.col(p).cast("string") for p in contract.partitions]))
        stamped = [F.col("created_at")] if "created_at" in self._kept_columns(contract, df) else []
        self._typed(contract, df, *stamped).hint("rebalance", *contract.partitions) \
            .observe(observed, F.count(F.lit(1)).alias("rows"), values.alias("folders")) \
            .write.mode("overwrite").option("compression", CODEC).partitionBy(*contract.partitions) \
            .parquet(self._pending(name, "folders"))
        self._recover_folders(name)
        written = {tuple(f) for f in observed.get["folders"] or ()}
        for folder in touched:
            if tuple(map(str, folder)) not in written:
                self._drop("/".join([self.path(name), *(f"{p}={v}" for p, v in zip(contract.partitions, folder, strict=True))]))
        return observed.get["rows"]

    def _recover_folders(self, name: str) -> None:
        contract, aside = self.contract(name), self._pending(name, "folders")
        if path_exists(self.spark, f"{aside}/_SUCCESS"):
            stamped = ["created_at"] if contract.identity else []
            ddl = contract.ddl + (", created_at TIMESTAMP_NTZ" if stamped else "")
            self._day_writer(contract, self.spark.read.schema(ddl).parquet(aside).select(*contract.column_names, *stamped))
        if path_exists(self.spark, aside):
            self._drop(aside)

    @staticmethod
    def _splits(contract: TableContract):
        """The (day, second level) pairs written; one to a few for each day."""
        if not contract.split:
            return F.lit(None)
        return F.collect_set(F.struct(F.col(contract.partition).cast("string").alias("day"),
                                      F.col(contract.split).cast("string").alias("part")))

    def _drop_stale(self, contract: TableContract, splits) -> None:
        """A dynamic overwrite replaces only the second-level folders it writes; those that an
        earlier load of the same day left beside them go here."""
        kept: dict[str, set[str]] = {}
        for pair in splits or ():
            kept.setdefault(pair["day"], set()).add(f"{contract.split}={pair['part']}")
        for day, parts in kept.items():
            folder = f"{self.path(contract.name)}/{contract.partition}={day}"
            for stale in set(self._folders(folder)) - parts:
                self._drop(f"{folder}/{stale}")

    def _day_writer(self, contract: TableContract, df: DataFrame) -> None:
        self._identified(contract, df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .option("compression", CODEC).partitionBy(*contract.partitions).parquet(self.path(contract.name))

    def _overwrite_days(self, contract: TableContract, df: DataFrame) -> int:
        observed, fresh = Observation(), not self.exists(contract.name)
        self._day_writer(contract, df.observe(
            observed, F.count(F.lit(1)).alias("rows"), self._splits(contract).alias("splits")))
        if not fresh:  # a new table has nothing left over
            self._drop_stale(contract, observed.get["splits"])
        return observed.get["rows"]

    def write_snapshot(self, name: str, df: DataFrame) -> int:
        """Make ``df`` the current state of a keyed table (``df`` may read the table)."""
        contract = self.contract(name)
        if contract.bucket_by:
            return self._replace_buckets(name, df, "whole")
        versions = self._versions(name)
        target = self._version_path(name, versions[-1] + 1 if versions else 1)
        observed = Observation()
        df.select(*contract.column_names).observe(observed, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").option("compression", CODEC).parquet(target)
        # A version may go once its successor has been there for ``kept_for``.
        finished = sorted(self._finished(name).items())
        now = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
        for (old, _), (_, replaced) in zip(finished, finished[1:], strict=False):
            if now - replaced > self.kept_for.total_seconds() * 1000:
                self._drop(self._version_path(name, old))
        return observed.get["rows"]

    # ---- merging by key --------------------------------------------------------------
    def merge(self, name: str, touching: DataFrame | dict[dt.date | None, list[int]] | None,
              change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace what the keys in ``touching`` may alter by ``change`` of it; returns the rows written.

        A bucketed table is read and written only where those keys fall: ``change`` gets
        the rows of their buckets and gives back all rows of these.  Buckets that are known
        can be given by their numbers (``all_buckets``).  Other keyed tables are changed as a whole.
        """
        if not self.contract(name).bucket_by:
            return self.write_snapshot(name, change(self.read(name)))
        self._recover(name)
        if not self.exists(name):  # there are no buckets to look for
            return self._replace_buckets(name, change(self.read(name)), "part")
        touched = touching if isinstance(touching, dict) else self.touched(name, touching)
        if not touched:
            return 0
        return self._replace_buckets(name, change(self.read_touched(name, touched)), "part")

    def recover(self) -> None:
        """Finish what a killed driver left between writing rows aside and replacing folders by them."""
        for name, contract in CONTRACTS.items():
            if contract.bucket_by:
                self._recover(name)
            elif contract.kind == "daily":
                self._recover_folders(name)

    def _bucket_root(self, name: str) -> tuple[str, int]:
        """The folder of the buckets and their number, which the folder's name keeps."""
        numbers = [int(f.removeprefix("of=")) for f in self._folders(self.path(name)) if f.startswith("of=")]
        number = numbers[0] if numbers else self.buckets
        return f"{self.path(name)}/of={number}", number

    @staticmethod
    def _typed(contract: TableContract, df: DataFrame, *more: Column) -> DataFrame:
        """The contract's columns in its types, so that what is written aside reads back as it was."""
        typed = [F.col(c).cast(kind).alias(c) for c, kind in (d.split(" ", 1) for d in contract.column_definitions)]
        return df.select(*typed, *more)

    def _bucket(self, name: str) -> Column:
        contract = self.contract(name)
        keys = [F.col(c).cast("string") for c in contract.bucket_by]
        if contract.spread_by:
            keys.append(F.when(F.coalesce(*keys).isNull(), F.col(contract.spread_by)))
        return F.pmod(F.xxhash64(*keys), F.lit(self._bucket_root(name)[1])).cast("int")

    def touched(self, name: str, keys: DataFrame) -> dict[dt.date | None, list[int]]:
        """The buckets that keys of a bucketed table fall into, by day (None where it has no days).

        A few numbers: at most one for each bucket of each day.
        """
        day = self.contract(name).partition
        found = keys.select((F.col(day) if day else F.lit(None).cast("date")).alias("day"), self._bucket(name).alias("bucket"))
        buckets: dict[dt.date | None, list[int]] = {}
        for row in sorted(found.distinct().collect(), key=lambda r: (str(r.day), r.bucket)):
            buckets.setdefault(row.day, []).append(row.bucket)
        return buckets

    def all_buckets(self, name: str, days: list[dt.date]) -> dict[dt.date | None, list[int]]:
        """Every bucket of some days of a bucketed table, as ``touched`` gives them."""
        return {day: list(range(self._bucket_root(name)[1])) for day in days}

    def read_touched(self, name: str, touched: dict[dt.date | None, list[int]]) -> DataFrame:
        """The rows of some buckets; days and buckets are partition filters."""
        contract = self.contract(name)
        if not self.exists(name):
            return self.spark.createDataFrame([], contract.ddl)
        rows = self.spark.read.schema(f"{contract.ddl}, bucket INT").parquet(self._bucket_root(name)[0])
        wanted = F.lit(False)
        for day, buckets in touched.items():
            own = F.col("bucket").isin(buckets)
            wanted = wanted | (own if day is None else own & (F.col(contract.partition) == F.lit(day)))
        return rows.filter(wanted).select(*contract.column_names)

    def _pending(self, name: str, extent: str) -> str:
        return f"{self.root}/_pending/{self.contract(name).name}/{extent}"

    def _replace_buckets(self, name: str, df: DataFrame, extent: str) -> int:
        """Write rows aside, then let them replace their buckets (or the whole table)."""
        self._recover(name)
        contract, observed = self.contract(name), Observation()
        levels = [*contract.partitions, "bucket"]
        self._typed(contract, df).select("*", self._bucket(name).alias("bucket")).hint("rebalance", *levels) \
            .observe(observed, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").option("compression", CODEC).partitionBy(*levels).parquet(self._pending(name, extent))
        self._recover(name)
        return observed.get["rows"]

    def _recover(self, name: str) -> None:
        """Let rows that were written aside replace their buckets; doing so again changes nothing."""
        contract, aside = self.contract(name), self._pending(name, "whole")
        if path_exists(self.spark, f"{aside}/_SUCCESS"):
            rows = self.spark.read.schema(f"{contract.ddl}, bucket INT").parquet(aside)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC) \
                .partitionBy(*contract.partitions, "bucket").parquet(self._bucket_root(name)[0])
        if path_exists(self.spark, aside):
            self._drop(aside)
        aside = self._pending(name, "part")
        if path_exists(self.spark, f"{aside}/_SUCCESS"):
            self._move_folders(aside, self._bucket_root(name)[0], len(contract.partitions) + 1)
        if path_exists(self.spark, aside):
            self._drop(aside)

    def upsert(self, name: str, incoming: DataFrame, keep: list[str] | None = None) -> int:
        keys = list(self.contract(name).key)
        return self.merge(name, incoming, lambda current: merge.upsert(current, incoming, keys, keep))

    def insert_absent(self, name: str, incoming: DataFrame) -> int:
        keys = list(self.contract(name).key)
        return self.merge(name, incoming, lambda current: merge.insert_absent(current, incoming, keys))

    def truncate(self, name: str) -> None:
        """Empty a table."""
        contract = self.contract(name)
        if contract.kind == "keyed":
            self.write_snapshot(name, self.spark.createDataFrame([], contract.ddl))
        elif self.exists(name):
            self._drop(self.path(name))

    # ---- SQL access ----------------------------------------------------------------
    def publish(self) -> None:
        """Expose every table as ``<layer>.<table>`` to ``spark.sql``.

        Views name the current folder.  The daily job publishes again what it finds
        published; a view that was not is good for ``kept_for`` after the next load.
        """
        for layer in dict.fromkeys(n.split(".")[0] for n in CONTRACTS):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/_catalog/{layer}'")
        for name, contract in CONTRACTS.items():
            extra = [f"{contract.identity} STRING", "created_at TIMESTAMP_NTZ"] if contract.identity else []
            typed = [definition.split(" ", 1) for definition in [*contract.column_definitions, *extra]]
            location = self.location(name)
            # A bucketed table without rows has no file that a view could take its columns from.
            if location is None or (contract.bucket_by and not path_exists(self.spark, f"{location}/*=*")):
                columns = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in typed)
                query = f"SELECT {columns} WHERE false"
            else:
                columns = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in typed)
                query = f"SELECT {columns} FROM parquet.`{location}`"
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")

    def published(self) -> bool:
        """Whether this store's tables are in the catalog."""
        return self.spark.catalog.tableExists("warehouse.dim_date")
