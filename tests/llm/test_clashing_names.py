"""Columns of the caller that are named like the operators' own."""

from __future__ import annotations

import random

import pytest
from helpers import documents, words
from pyspark.sql import functions as F

from tidemart.llm import decontaminate, jaccard_join, line_runs, mixing, quality_rules, url_rules

NAMES = ("_n", "_w", "_owner", "_twin", "_drop", "_o", "_t", "_rows", "_m", "_stats", "_kept", "_me", "_x0", "_pair", "_host", "_from",
         "_won", "_start", "_h", "_p", "_v", "_OWNER2", "_a.b", "owner", "twin", "n", "label", "keeper", "item", "rule_", "k1")


@pytest.fixture(scope="module")
def plain(spark):
    rng = random.Random(8)
    line = "a line of words that is long enough to count as repeated"
    texts = [words(rng, 80, 3000) for _ in range(12)]
    texts += [texts[0], texts[0], None, "", *[f"{line}\n{words(rng, 70, 3000)}" for _ in range(6)], " ".join(words(rng, 60, 3000) for _ in range(2))]
    return documents(spark, texts)


def clashing(df):
    return df.withColumns({f"`{n}`".strip("`"): F.concat(F.lit(f"{n}:"), F.col(df.columns[0]).cast("string")) for n in NAMES})


def check(step, frame):
    wide = clashing(frame)
    usual, odd = step(frame), step(wide)
    own = usual.columns
    assert sorted(odd.columns) == sorted({*own, *NAMES})
    assert sorted(map(str, odd.select(*own).collect())) == sorted(map(str, usual.collect()))
    for n in NAMES:
        values = odd.select(F.col(f"`{n}`").alias("v"), F.col(frame.columns[0]).cast("string").alias("i")).collect()
        assert all(r.v == (None if r.i is None else f"{n}:{r.i}") for r in values)


@pytest.mark.parametrize("name", ["good", "lines", "clean", "first"])
def test_documents(spark, plain, name):
    items = spark.createDataFrame([("b", plain.first().text)], "item_id string, text string")
    steps = {"good": quality_rules.keep_good, "lines": line_runs.drop_repeated_lines, "first": jaccard_join.keep_first,
             "clean": lambda docs: decontaminate.drop_contaminated(docs, items)}
    check(steps[name], plain)


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None), (3, "http://b.com/de/"), (4, "http://b.com/de/")], "page_id long, url string")
    rules = url_rules.rules_frame(spark, [("org", "/", "allow"), ("com", "/de/", "block")])
    check(lambda rows: url_rules.judge_urls(rows, rules), pages)
    renamed = pages.withColumnRenamed("url", "_url")
    assert {r.page_id: r.verdict for r in url_rules.judge_urls(renamed, rules, url="_url").collect()}[3] == "block"


def test_mix(spark, plain):
    wide = plain.withColumns({n: F.lit("x") for n in ("_n", "_w", "size", "target", "taken", "source_size", "key", "_key", "slice")})
    usual = {r.doc_id: r.taken for r in mixing.mix_sources(plain).collect()}
    assert {r.doc_id: r.taken for r in mixing.mix_sources(wide).collect()} == usual
