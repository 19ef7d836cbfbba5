"""Benchmark decontamination as a prefix-filtered join of shingles with item-sized windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ITEM_GAP, lower_ascii, own_names, small, split_words, stored

WINDOW = 13
SHINGLE = 5
NO_ID = -(1 << 63)


def item_words(text: Column) -> Column:
    return split_words(lower_ascii(text), ITEM_GAP)


def shingles_of(rows: DataFrame, size: int) -> DataFrame:
    """(…, pos, size, shingle, h) for each run of ``size`` words of the array ``_w``; other columns stay."""
    n = F.size("_w") - size + 1
    runs = F.arrays_zip(*[F.slice("_w", i + 1, n).alias(f"w{i}") for i in range(size)])
    others = [c for c in rows.columns if c != "_w"]
    out = rows.where(F.size("_w") >= size).select(*others, F.posexplode(runs).alias("pos", "_s"))
    words = [F.col(f"_s.w{i}") for i in range(size)]
    return out.select(*others, "pos", F.lit(size).alias("size"), F.array(*words).alias("shingle"), F.xxhash64(*words).alias("h"))


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, id, len, _w): each distinct window of each item; ``id`` names its words."""
    n = F.size("_words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), item_words(F.col("text")).alias("_words")).where(n > 0)
    wins = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("_words", i + 1, window))).alias("_w")).distinct()
    return wins.withColumns({"id": F.sha2(F.array_join("_w", " "), 256), "len": F.size("_w")})


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (owner, twin, n_words), and (owner, twin, n_hit, n_items, items_sha256) for those with a window.

    Windows and documents are sets of placed shingles (windows shorter than a shingle are one shingle).  Containment of the whole
    window needs every shingle, so the necessary prefix is its rarest one, by the count of its occurrences in the documents; a
    window with a shingle that occurs nowhere is out.  Occurrences of the prefix shingle fix where the window would have to
    start; starts before the text and ends beyond it are out (position and length bound).  A start holds if all shingles of the
    window occur at their places, compared word by word.

    Texts are not shuffled: the only rows that move are occurrences of benchmark shingles.  The benchmark's shingles are
    broadcast when a count shows that they are few, and joined by shuffle otherwise.
    """
    wins = stored(benchmark_windows(benchmark, window), "windows")
    grams = wins.select("id", "len", "_w").distinct()
    sizes = sorted(r[0] for r in grams.select(F.least("len", F.lit(shingle))).distinct().collect())  # at most ``shingle`` values
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("owner"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("twin"),
                       item_words(F.col("text")).alias("_w"))
    counted = rows.select("owner", "twin", F.size("_w").cast("long").alias("n_words"))
    parts, needed = [], []
    for size in sizes or [shingle]:
        of_size = grams.where((F.col("len") == size) if size < shingle else (F.col("len") >= shingle))
        wanted = shingles_of(of_size, size)
        needed.append(wanted)
        wanted = small(wanted.select(F.col("h").alias("_h"), F.col("shingle").alias("_shingle")).distinct())
        found = shingles_of(rows.withColumn("n_words", F.size("_w")), size)
        parts.append(found.join(wanted, F.col("h") == F.col("_h")).where("shingle = _shingle").drop("_h", "_shingle"))
    # Repeated rows are one row here: they have the same windows.
    occurrences = stored(reduce(DataFrame.unionByName, parts).select("owner", "twin", "pos", "size", "h", "n_words", "shingle"), "occurrences")
    places = stored(reduce(DataFrame.unionByName, needed), "places")
    often = occurrences.groupBy("size", "h", "shingle").agg(F.count(F.lit(1)).alias("_n"))
    prefix = (places.join(often, ["size", "h", "shingle"], "left")
              .groupBy("id", "len").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "pos", "size", "h", "shingle")).alias("_p"))
              .where("_p.n > 0").select("id", "len", F.col("_p.pos").alias("_at"), "_p.size", "_p.h", "_p.shingle"))
    starts = (occurrences.join(small(prefix), ["size", "h", "shingle"]).withColumn("start", F.col("pos") - F.col("_at"))
              .where("start >= 0 AND start + len <= n_words").select("owner", "twin", "start", "id", "len").distinct())
    there = F.struct("owner", "twin", "pos", "size", "h", "shingle")
    expected = starts.join(small(places.withColumnRenamed("pos", "_at").drop("len")), "id").withColumn("pos", F.col("start") + F.col("_at"))
    holds = (expected.join(occurrences.select("owner", "twin", "pos", "size", "h", "shingle").distinct(), ["owner", "twin", "pos", "size", "h", "shingle"])
             .groupBy("owner", "twin", "start", "id", "len").agg(F.count(there).alias("_met"))
             .where(F.col("_met") == F.col("len") - F.least("len", F.lit(shingle)) + 1))
    holds = stored(holds.select("owner", "twin", "start", "id", "len"), "held")
    hits = (holds.groupBy("owner", "twin").agg(F.collect_set(F.struct("start", "len")).alias("_at"))
            .select("owner", "twin", F.size(F.array_distinct(F.flatten(F.transform(
                "_at", lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1))))).cast("long").alias("n_hit")))
    items = (holds.select("owner", "twin", "id").distinct().join(small(wins.select("id", "item")), "id")
             .groupBy("owner", "twin").agg(F.array_sort(F.collect_set("item")).alias("_items"))
             .select("owner", "twin", F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256")))
    return counted, stored(hits.join(items, ["owner", "twin"]), "hits")


def contaminated(hit: Column, words: Column) -> Column:
    return (hit > 0) & (20 * hit >= words)


def contamination_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and blank texts have no words, and such items no windows; a null item_id counts as an empty string; repeated documents
    repeat and repeated items count once; other columns are ignored.  Empty tables: no rows, or no hits.
    """
    counted, hits = contamination(docs, benchmark)
    none = F.sha2(F.lit(""), 256)
    return counted.join(hits, ["owner", "twin"], "left").select(
        F.when(F.col("owner") != NO_ID, F.col("owner")).alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"),
        contaminated(F.coalesce("n_hit", F.lit(0)), F.col("n_words")).alias("contaminated"))


@own_names
def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    counted, hits = contamination(docs, benchmark)
    bad = (hits.join(counted.distinct(), ["owner", "twin"]).where(contaminated(F.col("n_hit"), F.col("n_words")))
           .select(F.col("owner").alias("_owner"), F.col("twin").alias("_twin")))
    owner, twin = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(small(stored(bad, "bad")), (owner == F.col("_owner")) & (twin == F.col("_twin")), "left_anti")
