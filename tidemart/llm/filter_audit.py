"""How filters interact: every order of them at once, by counting paths through the lattice of filter subsets."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import UPPER, WORD

# The bit of a duplicate; the other filters read nothing but the row.
DUPLICATE = "E"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of filters A to D over a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals.cast("long") > 5 * chars,
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by source and by the set of filters that they fail (a bit each, A the lowest).

    The first of equal texts has the smallest doc_id; rows that share it are all first, and a row without doc_id is neither a copy nor
    the original of one.  Instead of joining a minimum back to every copy, all rows count as copies, and the first ones are taken from
    there to where they belong: they are kept by a ranking that prunes in the map tasks, so a text with a third of all rows sends one
    row a task.  Texts travel as digests.
    """
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    failed = text_failures(F.col("text"))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed.values())), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       mask.alias("mask"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"))
    marked = (rows.join(marks, "doc_id", "left")
              .select("part", "mask", "text", "doc_id", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
              .groupBy("text", "doc_id", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n")))
    # Null ids rank apart from the rest, so that they hide no first row.
    numbered = marked.withColumn("nth", F.expr("rank() OVER (PARTITION BY text, doc_id IS NULL ORDER BY doc_id)"))
    copy = 1 << len(failed)
    sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    every = marked.groupBy("part", "mask").agg(*sums)
    first = numbered.where("nth = 1").groupBy("part", "mask").agg(*sums)
    signed = every.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), "n", "good", "toxic").unionByName(
        first.selectExpr("part", f"mask | {copy} AS mask", "-n AS n", "-good AS good", "-toxic AS toxic")).unionByName(first)
    return signed.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).where("n > 0")


def edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders through the edge) of the subset lattice.

    A state is the set of filters applied so far.  Forward, the orders that reach a state are the sum over the edges into it;
    backward, the orders that leave it the sum over the edges out of it; an edge carries the product of both its ends.
    """
    reach, leave, whole = {0: 1}, {}, (1 << n) - 1
    for state in range(1, whole + 1):
        reach[state] = sum(reach[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    leave[whole] = 1
    for state in range(whole - 1, -1, -1):
        leave[state] = sum(leave[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return [(state, f, reach[state] * leave[state | 1 << f]) for state in range(whole) for f in range(n) if not state >> f & 1]


def audit_filters(docs: DataFrame, labels: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``docs`` holds doc_id, text, source; ``labels`` holds doc_id, quality, toxic.  A null text is empty, a null source is the part
    ``''``; several labels of a document count as one that has each mark that any of them has.  Repeated rows count each time; an
    empty table has no parts; other columns do not matter.  Documents are read once and become at most 2^filters counts a part;
    what follows has as many rows as parts, states and orders, and stays spread over the parts.
    """
    n = len(filters)
    lattice = edges(n)
    state_edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("f"), F.lit(w).alias("orders")) for s, f, w in lattice])
    counts = mask_counts(docs, labels)
    # Every mask meets every edge of its own part: 32 x 80 rows a part.  An edge removes what fails its filter and passed its state.
    met = counts.select("part", "mask", "n", "good", "toxic", F.explode(state_edges).alias("e")).select("*", "e.state", "e.f", "e.orders").drop("e")
    fails = F.col("mask").bitwiseAND(F.expr("shiftleft(1, f)")) != 0
    passed = F.col("mask").bitwiseAND(F.col("state")) == 0
    alone = F.col("mask") == F.expr("shiftleft(1, f)")

    def count(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0)).cast("long")

    per_edge = met.groupBy("part", "state", "f", "orders").agg(
        count(passed & ~fails).alias("kept"), count(passed & fails).alias("removed"), count(~passed & fails).alias("redundant"),
        count(alone).alias("unique_fails"), count(passed & fails, "good").alias("good_lost"), count(passed & fails, "toxic").alias("toxic_lost"))
    shapley = F.expr("sum(removed * orders) OVER (PARTITION BY part, f)").cast("long")
    weighted = per_edge.withColumn("shapley", shapley)
    # Each order is a path of n edges; a step of it is the edge from the filters before it.
    by_edge: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in itertools.permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            by_edge.setdefault((state, f), []).append(("".join(filters[i] for i in order), step))
            state |= 1 << f
    assert all(len(by_edge[s, f]) == w for s, f, w in lattice) and sum(w for *_, w in lattice) == n * math.factorial(n)
    steps = docs.sparkSession.createDataFrame(
        [(s, f, order, step) for (s, f), found in by_edge.items() for order, step in found], "state int, f int, filter_order string, step int")
    # The steps of all orders are a fixed table of n * n! rows.
    return weighted.join(F.broadcast(steps), ["state", "f"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
