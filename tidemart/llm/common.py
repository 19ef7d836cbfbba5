"""Helpers the training-text operators share: tables, words, scratch tables, checked broadcasts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_dir

# The separators of the two word definitions, as regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
ITEM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A side of a join is broadcast by hint only when a count has shown it to be at most this long.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters keep their case."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, gap: str) -> Column:
    """Words between runs of ``gap``; no words for null or blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: cuts lineage, survives lost executors.

    The codec halves texts, which lie there until the job ends.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_names(step):
    """Lets ``step(rows, ...)`` use column names with a leading underscore for itself.

    Columns of the caller that begin so are renamed on the way in and back on the way out; without any, nothing is changed.
    """
    @functools.wraps(step)
    def run(rows: DataFrame, *args, **kwargs) -> DataFrame:
        named = {a for a in (*args, *kwargs.values()) if isinstance(a, str)}
        aside = {c: f"column {n} of the caller" for n, c in enumerate(rows.columns) if c.startswith("_") and c not in named}
        if not aside:
            return step(rows, *args, **kwargs)
        return step(rows.withColumnsRenamed(aside), *args, **kwargs).withColumnsRenamed({v: k for k, v in aside.items()})

    return run


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if a count shows at most ``rows`` rows; the frame as it is (shuffled join) beyond."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
