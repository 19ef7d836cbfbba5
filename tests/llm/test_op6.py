from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import DOCS, ODD_TEXTS, documents, words
from pyspark.sql import functions as F

from tidemart.llm import repeats, subtree_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    texts = [WORD.findall(r[1] or "") for r in rows]
    ids = [-(1 << 63) if r[0] is None else r[0] for r in rows]
    first = {}
    for ws, d in zip(texts, ids, strict=True):
        for s in range(len(ws) - window + 1):
            key = tuple(ws[s:s + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for r, ws, d in zip(rows, texts, ids, strict=True):
        gone = {i for s in range(len(ws) - window + 1) if first[tuple(ws[s:s + window])] < d for i in range(s, s + window)}
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((r[0], len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("places", [20_000, 3])
def test_words_match_brute_force(spark, monkeypatch, places):
    monkeypatch.setattr(repeats, "GROUP_PLACES", places)
    rng = random.Random(places)
    passages = [words(rng, n) for n in (49, 50, 51, 80, 130)] + ["ab cd " * 60]
    texts = list(ODD_TEXTS)
    for _ in range(90):
        parts = [rng.choice([words(rng, rng.randrange(1, 60)), rng.choice(passages), rng.choice(passages)[7:]]) for _ in range(rng.randrange(1, 5))]
        texts.append(rng.choice([" ", "\n", "\t \r"]).join(parts))
    texts += [texts[-1], texts[-2][:-3], "q " + texts[-3]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(d, t, None, None, 1) for d, t in zip(ids, texts, strict=True)]
    rows += [rows[-1], (None, texts[20], None, None, 1), (rows[30][0], texts[31], None, None, 1)]
    got = subtree_dedup.without_repeated_words(spark.createDataFrame(rows, DOCS))
    assert Counter(tuple(r) for r in got.withColumn("data", F.sha2("data", 256)).collect()) == brute(rows)


def test_nothing(spark):
    assert subtree_dedup.without_repeated_words(documents(spark, [])).collect() == []
    assert [tuple(r)[1:3] for r in subtree_dedup.without_repeated_words(documents(spark, [None, ""])).collect()] == [(0, 0)] * 2
