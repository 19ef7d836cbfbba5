from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, documents, words

from tidemart.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    w = WORD.findall(text or "")
    triples = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed), len(lines)


def whole(x):
    return math.floor(x + 0.5)


def brute_kept(rows):
    stats = [brute_stats(r[1]) for r in rows]
    vectors = {i: [whole(v * Q.UNIT) for v in (math.log(s[1] / s[0]), math.sqrt(s[2] / s[0]), math.sqrt(s[3] / n), math.sqrt(s[4] / s[0]))]
               for i, (s, n) in enumerate(stats) if not s[5]}
    floors, fits, kept = np.array(Q.FLOORS), {}, []

    def members(group):
        return np.array([v for i, v in vectors.items() if group == "all" or group == rows[i][2:4] or group == (rows[i][2],)])

    def fit(x):
        median = np.median(x, axis=0)
        z = ((x - median) / (1.4826 * np.median(abs(x - median), axis=0) + floors * Q.UNIT)) ** 2
        found = []
        for q in (z.sum(axis=1), z.max(axis=1)):
            for step in range(Q.STEPS + 1):
                if step:
                    diff = x / Q.UNIT - mean
                    q = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
                r = np.minimum(np.floor(q * Q.RANK_UNIT), Q.RANK_MAX)
                h = x[r <= np.percentile(r, 100 * Q.SUPPORT)] / Q.UNIT
                mean = h.mean(axis=0)
                cov = Q.CONSISTENCY * np.cov(h.T, bias=True) + np.diag(floors**2)
            found.append((np.linalg.slogdet(cov)[1], mean, cov))
        _, mean, cov = min(found, key=lambda f: round(f[0], 9))
        return len(x), mean, cov

    def toward(own, wider):
        n, mean, cov = own
        w = n / (n + Q.SHRINK)
        return n, wider[1] + w * (mean - wider[1]), wider[2] + w * (cov - wider[2])

    for i, (s, _) in enumerate(stats):
        if s[5]:
            kept.append(False)
            continue
        pair = rows[i][2:4]
        for group in ("all", pair[:1], pair):
            if group not in fits:
                fits[group] = fit(members(group))
                if group != "all":
                    fits[group] = toward(fits[group], fits["all" if len(group) == 1 else pair[:1]])
        _, mean, cov = fits[pair]
        diff = np.array(vectors[i]) / Q.UNIT - mean
        kept.append(bool(diff @ np.linalg.inv(cov) @ diff <= Q.CUT))
    return Counter((r[0], *s, k) for r, (s, _), k in zip(rows, stats, kept, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_and_verdicts_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(ODD_TEXTS)]
    for i in range(500):
        text = words(rng, rng.randrange(30, 200), rng.choice([20, 3000, 3000]))
        if rng.random() < 0.15:
            text = re.sub(" ", lambda m: rng.choice([" ", " ### ", "$%& "]), text)
        if rng.random() < 0.1:
            text += ("\n" + words(rng, 15)) * rng.randrange(4)
        rows.append((100 + i, text, *rng.choice([("en", "a"), ("en", "a"), ("en", "b"), ("en", None), (None, "a"), ("de", "a"), ("fr", "tiny")]), 1))
    rows += [rows[-1]] * 3
    got = Counter(tuple(r) for r in Q.quality_table(spark.createDataFrame(rows, DOCS)).collect())
    want = brute_kept(rows)
    assert got == want
    assert 0 < sum(n for k, n in want.items() if not k[-1] and not k[-2])


def test_rejected_documents_go_and_columns_stay(spark):
    rng = random.Random(5)
    good = [words(rng, 120, 5000) for _ in range(60)]
    junk = [" ".join(f"w{j}#$%&" for j in range(i, i + 120)) for i in range(8)]
    docs = documents(spark, good + junk + [None, "few words"]).selectExpr("*", "1 AS n_words", "true AS kept")
    left = Q.keep_good(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(60))


def test_nothing(spark):
    assert Q.quality_table(documents(spark, [])).collect() == []
    assert [r["kept"] for r in Q.quality_table(documents(spark, [None])).collect()] == [False]
