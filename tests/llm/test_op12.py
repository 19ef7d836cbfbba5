from __future__ import annotations

import itertools
import random
import re

import pytest
from helpers import ODD_TEXTS, documents, words

from tidemart.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int, text string"


def plain(docs, labels):
    """Every order applied to every document, one after the other."""
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        ws = WORD.findall(text)
        failed = {"A"} if len(ws) < 50 else set()
        failed |= {"B"} if 100 * len(set(ws)) < 65 * len(ws) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs):
            failed.add("E")
        rows.append((source or "", failed, doc_id in good, doc_id in toxic))
    found, shapley = {}, {}
    for order in itertools.permutations("ABCDE"):
        left = rows
        for step, f in enumerate(order, 1):
            before = set(order[:step - 1])
            gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
            for part in {r[0] for r in rows}:
                mine = [r for r in gone if r[0] == part]
                found[part, "".join(order), step] = (
                    sum(r[0] == part for r in left), len(mine), sum(r[0] == part and f in r[1] and bool(r[1] & before) for r in rows),
                    sum(r[0] == part and r[1] == {f} for r in rows), sum(r[2] for r in mine), sum(r[3] for r in mine))
                shapley[part, f] = shapley.get((part, f), 0) + len(mine)
    return sorted((*key, *values, shapley[key[0], key[1][key[2] - 1]]) for key, values in found.items())


def check(spark, frame, labels):
    docs = [(r.doc_id, r.text, r.source) for r in frame.collect()]
    result = filter_audit.audit_filters(frame, spark.createDataFrame(labels, LABELS))
    assert result.columns == COLUMNS
    rows = sorted(tuple(r) for r in result.collect())
    assert rows == plain(docs, labels)
    assert len(rows) == 600 * len({s or "" for *_, s in docs})


def test_odd_and_repeated_rows(spark):
    rng = random.Random(4)
    texts = [*ODD_TEXTS, *ODD_TEXTS[:6], *[words(rng, rng.randrange(30, 90), rng.choice([30, 3000])) for _ in range(20)]]
    texts += ["SHOUT " * 60, "a | b " * 40, words(rng, 60, 10**6) + " %", texts[-1], texts[-1], texts[-2], "A" * 200_000, "w " * 200_000]
    frame = documents(spark, texts).selectExpr("*", "1 AS mask", "2 AS n", "3 AS good", "4 AS part", "5 AS nth", "6 AS quality", "7 AS toxic")
    frame = frame.union(frame.where("doc_id in (0, 5, 20)")).repartition(3)
    labels = [(i, i % 3 % 2, int(i % 4 == 1), "x") for i in range(0, len(texts), 2)] + [(2, 1, 1, "y"), (None, 1, 1, ""), (4, None, None, ""), (999, 1, 1, "")]
    check(spark, frame, labels)


def test_ids_missing_or_shared(spark):
    schema = "doc_id long, text string, source string"
    rows = [(None, "same", "a"), (None, "same", "a"), (3, "same", "a"), (3, "same", "b"), (3, "same", None), (9, "same", ""), (1, None, "a"), (2, "", "a"), (None, "", "b")]
    check(spark, spark.createDataFrame(rows, schema), [(3, 1, 0, ""), (9, 1, 1, ""), (2, 0, 1, "")])


def test_nothing_fails_and_no_labels(spark):
    frame = documents(spark, [" ".join(f"w{i}x{n}" for i in range(60)) for n in range(4)])
    check(spark, frame, [])


def test_empty(spark):
    assert filter_audit.audit_filters(documents(spark, ["x"]).limit(0), spark.createDataFrame([], LABELS)).collect() == []


@pytest.mark.parametrize("n", [1, 3, 6])
def test_paths_of_the_lattice(n):
    found = {}
    for order in itertools.permutations(range(n)):
        state = 0
        for f in order:
            found[state, f] = found.get((state, f), 0) + 1
            state |= 1 << f
    assert {(s, f): w for s, f, w in filter_audit.edges(n)} == found


def test_copies_are_pruned_before_the_shuffle(spark):
    frame = documents(spark, ["x"] * 10)
    counts = filter_audit.mask_counts(frame, spark.createDataFrame([], LABELS))
    assert "WindowGroupLimit" in counts._jdf.queryExecution().toString()
