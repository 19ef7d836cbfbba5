"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import lower_ascii, own_names, stored

# Runs of one level that are merged into one run of the next.
FAN_IN = 3
# Batches in which a table is taken, largest doc_ids first.
BATCHES = 4
# A null doc_id ranks below all others.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without white space (space, tab to carriage return) at both ends, A-Z lower-cased."""
    return lower_ascii(F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", ""))


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k1, k2, owner, twin, pos): 128-bit key of every line of at least ``min_chars`` code points, its document and place.

    ``owner`` is the doc_id (``NO_ID`` for null); ``twin`` tells rows apart that share a doc_id.
    """
    text = F.coalesce("text", F.lit(""))
    lines = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("owner"), F.xxhash64(text).alias("twin"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    # A line is never shorter than its key: the filter on the line spares most work on short ones.
    keyed = lines.where(F.length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return (keyed.where(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("2"), "key").alias("k2"), "owner", "twin", "pos"))


class LineRuns:
    """Runs of (k1, k2, n_docs, keeper), sorted by key, in levels: ``FAN_IN`` runs of a level are compacted into one of the next.

    ``add`` takes the lines of one batch.  A batch must hold all rows of its documents, and batches come with falling doc_ids
    when the keeper is to be the largest.  Keys that a run already has (found by a merge join) keep their keeper and gain
    documents; the others, the anti-join, enter with the batch's own largest doc_id.
    """

    def __init__(self) -> None:
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> DataFrame | None:
        held = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, held) if held else None

    @staticmethod
    def merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, lines: DataFrame) -> None:
        """Counts each document once for each key, whatever the number of lines or rows it has."""
        batch = (lines.groupBy("k1", "k2", "owner").agg(F.lit(1).alias("one"))
                 .groupBy("k1", "k2").agg(F.count("one").alias("n_docs"), F.max("owner").alias("keeper")))
        held = self.runs()
        if held is not None:
            seen = held.groupBy("k1", "k2").agg(F.max("keeper").alias("older"))
            batch = (batch.join(seen, ["k1", "k2"], "left")
                     .select("k1", "k2", "n_docs", F.coalesce("older", "keeper").alias("keeper")))
        self._place(batch, 0)

    def _place(self, rows: DataFrame, level: int) -> None:
        run = stored(rows.sortWithinPartitions("k1", "k2"), f"lines{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == FAN_IN:
            full, self.levels[level] = self.levels[level], []
            self._place(self.merged(reduce(DataFrame.unionByName, full)), level + 1)

    def frequent(self, min_docs: int) -> DataFrame:
        """(k1, k2, keeper) of the keys that at least ``min_docs`` documents have."""
        return self.merged(self.runs()).where(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper")


@own_names
def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, plus ``n_lines`` (before) and ``n_dropped``.

    Lines whose key has at least ``min_chars`` code points and is in at least ``min_docs`` documents go, except from the largest
    doc_id that has it, which keeps all of them.  Null and empty texts are one empty line; a text that loses nothing is left as it
    is, null included.  Rows that share a doc_id are one document: a key counts once for them and all of them may keep it.  Null
    doc_ids count as one document below all others.  Other columns stay; columns named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    lines = stored(keyed_lines(docs, min_chars), "keyed_lines")
    cuts = lines.select(F.percentile_approx("owner", [1 - n / batches for n in range(1, batches)])).first()[0] or []
    bounds = [None, *sorted(set(cuts), reverse=True), None]
    store = LineRuns()
    for upper, lower in zip(bounds, bounds[1:], strict=False):
        part = lines if upper is None else lines.where(F.col("owner") < upper)
        store.add(part if lower is None else part.where(F.col("owner") >= lower))
    dropped = (lines.join(store.frequent(min_docs), ["k1", "k2"]).where("owner <> keeper")
               .groupBy("owner", "twin").agg(F.array_sort(F.collect_set("pos")).alias("_drop")))
    owner, twin = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce("text", F.lit("")))
    marked = docs.join(dropped.withColumnsRenamed({"owner": "_owner", "twin": "_twin"}),
                       (owner == F.col("_owner")) & (twin == F.col("_twin")), "left").drop("_owner", "_twin")
    split = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    return (marked.withColumns({"n_lines": F.size(split).cast("long"), "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long")})
            .withColumn("text", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(
                let_kept(split, F.col("_drop"))))
            .drop("_drop"))


def let_kept(lines: Column, drop: Column) -> Column:
    """The lines outside the sorted places ``drop``, joined: stretches between places are sliced, so long texts stay linear."""
    edges = F.concat(F.array(F.lit(-1)), drop)
    body = F.transform(F.array(F.struct(lines.alias("l"), edges.alias("e"))), lambda x: F.array_join(F.flatten(F.transform(
        x["e"], lambda at, i: F.slice(x["l"], at + 2, F.coalesce(F.get(x["e"], i + 1), F.size(x["l"])) - at - 1))), "\n"))
    return body[0]
