"""Small tables with awkward rows, for every operator."""

from __future__ import annotations

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])

ODD_TEXTS = [None, "", " ", "\n", "\n\n", "one", "Ä ö\tü\n", "a\u00a0b c\u3000d", "x" * 3000, "\x00 nul", "<s>x</s> ▁▁ \t", "日本語 テキスト 😀 z",
             "a b " * 700, "line of words that is long enough to count as one\n" * 30, "  lead and trail  "]


def words(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, sources=("s0", "s1", None)):
    rows = [(i, t, ("en", "de")[i % 2], sources[i % len(sources)], None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def collected(df, key="doc_id"):
    """Rows by key; fails when a key repeats."""
    rows = [r.asDict() for r in df.collect()]
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found
