"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD, small, stored

# Rows of one source that are ordered in one task; the range of keys in which a budget ends is sliced until it has no more.
SLICE_ROWS, SLICES = 20_000, 256
SYMBOLS = r"[#*$%&|<>]"


def quality_weight(text: Column, size: Column) -> Column:
    """Share of words left after charging 20 words for every symbol character; in (0, 1]."""
    return (size + 1) / (size + 1 + 20 * F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) fixed by the document: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, cycle: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of (source, source_size): ``share`` of all words dealt by weight, none above ``most`` times its source's size.

    What a source cannot take goes to the others by weight until none is above: all sources below their bound then get the same
    number of words for each unit of weight.  That level follows from the sources in the order in which they reach their bound.
    Sources rank by code point, null last.  One row per source, so its windows hold as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy(F.col("source_size") / F.col("w"), "nth")
    everything = Window.partitionBy()
    weights = F.element_at(F.array(*[F.lit(w) for w in cycle]), ((F.col("nth") - 1) % len(cycle) + 1).cast("int"))
    ranked = (sizes.withColumn("nth", F.row_number().over(by_name)).withColumn("w", weights)
              .withColumn("_all", F.sum("source_size").over(everything)).withColumn("_ws", F.sum("w").over(everything))
              .withColumn("_before", F.coalesce(F.sum("source_size").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_wbefore", F.coalesce(F.sum("w").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_level", (share * F.col("_all") - most * F.col("_before")) / (F.col("_ws") - F.col("_wbefore"))))
    # The first source that stays below its bound sets the level.
    ranked = ranked.withColumn("_free", F.min(F.when(F.col("_level") * F.col("w") <= most * F.col("source_size"),
                                                     F.struct("_before", "_wbefore", "nth", "_level"))).over(everything))
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("_free._level") * F.col("w"), most * F.col("source_size")))
    return ranked.select("source", "source_size", "w", target.cast("double").alias("target"))


def budget_ends(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: the closed range of keys (``_lo``, ``_hi``) in which its budget ``_rest`` ends, the words of smaller keys
    (``_done``) and the rows of the range (``_rows``).

    A range with more than ``SLICE_ROWS`` rows is cut into slices of equal width, and the slice in which the budget ends is the
    next range, by the least and greatest key that it holds.  Only sums of slices are accumulated.  Every round leaves out rows
    until a range has few, or rows of one key only, whatever the spread of keys: a noisy source needs a round more.
    """
    wide = (F.col("_rows") > SLICE_ROWS) & (F.col("_lo") < F.col("_hi"))
    while not plan.where(wide).isEmpty():
        held = sized.join(small(plan.where(wide)), F.col("source").eqNullSafe(F.col("_s"))).where("_key BETWEEN _lo AND _hi")
        nth = F.least(F.floor(SLICES * (F.col("_key") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))), F.lit(SLICES - 1))
        slices = held.groupBy("_s", "_rest", nth.alias("_slice"), F.col("_done").alias("_start")).agg(
            F.min("_key").alias("_lo"), F.max("_key").alias("_hi"), F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        earlier = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = (slices.withColumn("_done", F.col("_start") + F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
                .where("_done < _rest AND _rest <= _done + _words"))
        plan = stored(ends.select(*plan.columns).unionByName(plan.where(~wide)), "mixends")
    return plan


def mix_sources(docs: DataFrame, cycle: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words the mix takes of it, repeats counted).

    Complete epochs of a source come first.  What is left of its target is a sample without replacement whose odds follow
    ``quality_weight`` (Efraimidis-Spirakis: the smallest ``-ln(u) / weight``): documents are taken whole in key order until the
    budget ends, and the last one in part.  Only documents of the narrow range of keys in which the budget ends are put in order
    (``budget_ends``), so a source with most rows needs no single task.  ``u`` is a hash of the document: reruns agree.

    Null texts and texts without words have size 0 and are taken 0 times; null sources form a source of their own; rows that
    repeat each other count separately.  An empty table gives an empty result.
    """
    text = F.col("text")
    size = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
    key = -F.log(uniform(F.col("doc_id"), text)) / quality_weight(text, F.col("size"))
    sized = stored(docs.select("doc_id", "source", "text", size.alias("size")).select("doc_id", "source", "size", key.alias("_key")), "mix")
    sources = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi"),
                                                 F.count(F.lit(1)).alias("_rows")), "sources")
    targets = stored(source_targets(sources, cycle, share, most)
                     .withColumn("_budget", F.floor(F.col("target") + 0.5))
                     .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(F.lit(0)))
                     .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("source_size")), "targets")
    named = targets.where("_rest > 0").select(F.col("source").alias("_s"), "_rest")
    whole = named.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select("_s", "_rest", "_lo", "_hi", F.lit(0).cast("long").alias("_done"), "_rows")
    ends = budget_ends(sized, stored(whole, "mixends")).drop("_rest", "_rows")
    plan = stored(targets.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left")
                  .select(F.col("source").alias("_source"), "source_size", "target", "_epochs", "_rest", "_lo", "_hi", F.coalesce("_done", F.lit(0)).alias("_done")), "mixplan")
    placed = sized.join(small(plan), F.col("source").eqNullSafe(F.col("_source")))
    at_end = F.coalesce(F.col("_key").between(F.col("_lo"), F.col("_hi")), F.lit(False))
    order = Window.partitionBy("source").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    last = (placed.where(at_end).withColumn("_before", F.col("_done") + F.coalesce(F.sum("size").over(order), F.lit(0)))
            .withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))).drop("_before"))
    others = placed.where(~at_end).withColumn("_part", F.when(F.col("_key") < F.col("_lo"), F.col("size")).otherwise(F.lit(0)))
    return last.unionByName(others).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("_epochs") * F.col("size") + F.col("_part")).cast("long").alias("taken"))
