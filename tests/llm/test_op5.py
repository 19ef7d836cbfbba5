from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from helpers import DOCS, ODD_TEXTS, documents, words
from pyspark.sql import functions as F

from tidemart.llm import longest_factor, repeats


def brute(rows, length, keep_first=False):
    texts = [(r[1] or "").encode() for r in rows]
    places = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        for s in range(len(texts[i]) - length + 1):
            places.setdefault(texts[i][s:s + length], []).append((i, s))
    gone = [bytearray(len(t)) for t in texts]
    for found in places.values():
        for i, s in found[1:] if keep_first else found if len(found) > 1 else ():
            gone[i][s:s + length] = b"\1" * length
    out = []
    for r, t, g in zip(rows, texts, gone, strict=True):
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        out.append((r[0], len(t), sum(g), len([x for x in bytes(g).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def given(rng):
    passages = [words(rng, 70) for _ in range(4)] + ["é" * 150, "xyz" * 200]
    texts = list(ODD_TEXTS) + [ODD_TEXTS[-2]]
    for _ in range(60):
        texts.append(" ".join(rng.choice([words(rng, rng.randrange(1, 60)), rng.choice(passages), rng.choice(passages)[7:]]) for _ in range(rng.randrange(1, 5))))
    texts += [texts[-1], texts[-2][:-3], "q" + texts[-3]]
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    return rows + [rows[-1], (None, texts[20], None, None, 1)]


@pytest.mark.parametrize("places", [20_000, 3])
@pytest.mark.parametrize("keep_first", [False, True])
def test_bytes_match_brute_force(spark, monkeypatch, places, keep_first):
    monkeypatch.setattr(repeats, "GROUP_PLACES", places)
    rows = given(random.Random(places))
    got = longest_factor.without_repeats(spark.createDataFrame(rows, DOCS), 400, keep_first)
    found = Counter(tuple(r) for r in got.withColumn("data", F.sha2("data", 256)).collect())
    want = brute(rows, 400, keep_first)
    if keep_first:  # rows that repeat each other tie: either may be the first
        found, want = (Counter({k: n for k, n in x.items() if k[0] != rows[-2][0]}) for x in (found, want))
    assert found == want


def test_nothing(spark):
    assert longest_factor.without_repeats(documents(spark, [])).collect() == []
    assert [tuple(r)[1:4] for r in longest_factor.without_repeats(documents(spark, [None, ""])).collect()] == [(0, 0, 0)] * 2


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    from tidemart.llm import queries

    assert Counter(tuple(r) for r in queries.suffix_dedup(spark, "/root/testdata/sf0.001").collect()) == brute(rows, 400)
