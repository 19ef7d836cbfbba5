from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import DOCS, ODD_TEXTS, documents, words

from tidemart.llm import common, decontaminate

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = item_words(text)
        n = min(len(w), 13)
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add("" if item is None else str(item))
    out = []
    for r in rows:
        w, hit, found = item_words(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[s:s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= ids
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return Counter(out)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_windows_match_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common.small, "__defaults__", (broadcast,))
    rng = random.Random(4)
    items = [(i, words(rng, n, 40)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 12, 13, 14, 20, 40, 40])]
    items += [(100, items[-1][1]), (7, words(rng, 15)), (None, "Ünï cödé-item, 13 WORDS a b c d e f g h i j"), (101, None), (102, "..."), (103, items[9][1] + " x")]
    texts = list(ODD_TEXTS)
    for _ in range(120):
        parts = [rng.choice([words(rng, rng.randrange(1, 200)), rng.choice(items)[1] or "", (rng.choice(items)[1] or "").upper().replace(" ", ", "), (rng.choice(items)[1] or "")[5:]])
                 for _ in range(rng.randrange(1, 5))]
        texts.append(" ".join(parts))
    texts.append((items[9][1] + " ") * 3)
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, texts[40], None, None, 1), (5, texts[41], None, None, 1)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, DOCS)
    want = brute(rows, items)
    assert Counter(tuple(r) for r in decontaminate.contamination_table(docs, benchmark).collect()) == want
    left = decontaminate.drop_contaminated(docs.selectExpr("*", "1 AS pos", "2 AS n_words"), benchmark)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter({k: n for k, n in sum((Counter({x[0]: c}) for x, c in want.items() if not x[-1]), Counter()).items()})


def test_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_table(documents(spark, []), none).collect() == []
    got = decontaminate.contamination_table(documents(spark, [None, "a b"]), none).collect()
    assert [tuple(r)[:4] + (r["contaminated"],) for r in sorted(got)] == [(0, 0, 0, 0, False), (1, 2, 0, 0, False)]
