"""Connected components by contraction to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of ``links`` (a, b): the least vertex that can be reached.

    Each round sends every vertex to its least neighbour, follows these steps to their ends by doubling, and goes on with the links
    that still join different ends: there are fewer of them each time, and a star is one link after a round or two.  Each round is
    written; nothing about the graph reaches the driver but whether something is left.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("label", F.col("v")), "labels")
    while not edges.isEmpty():
        steps = stored(edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("a").alias("to")), F.struct(F.col("b").alias("v"), F.col("a").alias("to")))).alias("s"))
                       .groupBy("s.v").agg(F.min("s.to").alias("to")), "steps")
        while True:
            ends = steps.select(F.col("v").alias("_v"), F.col("to").alias("_to"))
            further = stored(steps.join(ends, F.col("to") == F.col("_v")).select(
                "v", F.col("_to").alias("to"), (F.col("_to") != F.col("to")).alias("moved")), "steps")
            steps = further.select("v", "to")
            if further.where("moved").isEmpty():
                break
        last = steps.select(F.col("v").alias("_v"), "to")
        labels = stored(labels.join(last, F.col("label") == F.col("_v"), "left").select("v", F.coalesce("to", "label").alias("label")), "labels")
        of_a, of_b = (steps.select(F.col("v").alias(f"_{c}"), F.col("to").alias(f"to_{c}")) for c in "ab")
        edges = stored(edges.join(of_a, F.col("a") == F.col("_a")).join(of_b, F.col("b") == F.col("_b")).where("to_a <> to_b")
                       .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of the graph with ``links`` added: only the new links, between components, are looked at."""
    known = labels.select(F.col("v").alias("_v"), F.col("label").alias("_label"))
    mapped = links.select("a", "b")
    for end in ("a", "b"):
        mapped = mapped.join(known, F.col(end) == F.col("_v"), "left").withColumn(end, F.coalesce("_label", end)).drop("_v", "_label")
    mapped = stored(mapped, "mapped")
    merged = components(mapped)
    fresh = links.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(labels, "v", "left_anti").withColumn("label", F.col("v"))
    every = labels.select("v", "label").unionByName(fresh)
    return stored(every.join(merged.withColumnsRenamed({"v": "_v", "label": "_to"}), F.col("label") == F.col("_v"), "left")
                  .select("v", F.coalesce("_to", "label").alias("label")), "labels")
