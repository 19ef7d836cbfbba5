from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from helpers import DOCS, ODD_TEXTS, documents, words

from tidemart.llm import jaccard_join as J
from tidemart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    ids = [-(1 << 63) if r[0] is None else r[0] for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return Counter((r[0], len(s), None if least[find(i)] == -(1 << 63) else least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
    return " ".join(w)


def given(rng):
    texts = list(ODD_TEXTS)
    for n in (3, 5, 6, 7, 8, 9, 12, 16, 20, 25, 28, 40, 80, 200):
        base = words(rng, n)
        texts += [edited(rng, base, rng.randrange(1 + n // 12)) for _ in range(14)] + [base.upper(), base + " tail", "head " + base, base + " a b c"]
    passage = words(rng, 60)
    texts += [passage + " " + words(rng, rng.randrange(3, 60)) for _ in range(40)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(d, t, None, None, 1) for d, t in zip(ids, texts, strict=True)]
    return rows + rows[-3:] + [(None, texts[60], None, None, 1), (rows[40][0], texts[200], None, None, 1)]


@pytest.mark.parametrize(("light", "entries", "partners", "most"), [(16, 50_000, 1000, 24), (2, 4, 3, 24), (3, 50_000, 2, 0)])
def test_components_match_brute_force(spark, monkeypatch, light, entries, partners, most):
    monkeypatch.setattr(J, "LIGHT_LIST", light)
    monkeypatch.setattr(J, "LIST_ENTRIES", entries)
    monkeypatch.setattr(J, "CENTRE_PARTNERS", partners)
    monkeypatch.setattr(J, "MOST_SMALL", most)
    rows = given(random.Random(light))
    got = J.near_duplicate_table(spark.createDataFrame(rows, DOCS).repartition(3))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_first_document_of_each_component_stays(spark):
    rng = random.Random(8)
    base = words(rng, 60)
    docs = documents(spark, [base + " x", base, base + " y", None, "", words(rng, 60), words(rng, 60)]).selectExpr("*", "1 AS id", "2 AS owner", "3 AS twin")
    docs = docs.union(docs.where("doc_id = 5"))
    left = J.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 3, 4, 5, 6]


def test_unlike_documents_without_or_with_one_id_stay(spark):
    rng = random.Random(9)
    base = words(rng, 60)
    alike = [base + " x", base, base + " y"]
    unlike = [words(rng, 60) for _ in range(5)]
    rows = [(None, t, "en", "s", i) for i, t in enumerate([*alike, *unlike, unlike[0], "", None, " "])]
    rows += [(7, t, "en", "s", 100 + i) for i, t in enumerate([*alike, *(words(rng, 60) for _ in range(4)), "", "", "\n"])]
    left = [tuple(r) for r in J.keep_first(spark.createDataFrame(rows, DOCS).repartition(3)).collect()]
    assert set(left) <= set(rows)
    # Of the texts that are alike, those without an id come first.
    assert len([r for r in left if r[1] in alike]) == 1 and not [r for r in left if r[0] == 7 and r[1] in alike]
    assert sorted((r[0] or 0, r[1] or "") for r in left if r[1] not in alike) == sorted(
        [(0, t) for t in [*unlike, "", "", " "]] + [(7, r[1]) for r in rows[-7:-3]] + [(7, ""), (7, "\n")])


def test_nothing(spark):
    assert J.near_duplicate_table(documents(spark, [])).collect() == []
    assert sorted(tuple(r) for r in J.near_duplicate_table(documents(spark, [None, "", "a"])).collect()) == [(0, 0, 0), (1, 0, 1), (2, 1, 2)]


def test_bounds():
    for n in range(1, 60):
        assert J.needed_alone(n) == min(-(-3 * n // 4), n)
        for m in range(1, 60):
            t = J.needed(n, m)
            similar = [o for o in range(1, min(n, m) + 1) if 100 * o >= 75 * (n + m - o)]
            assert (min(similar) == t) if similar else (t > min(n, m))


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    assert {(r["v"], r["label"]) for r in components(links).collect()} == {(i, 0) for i in range(41)} | {(99, 99), (100, 99)}


@pytest.mark.parametrize("most_in_a_task", [8_192, 40])
def test_borderline_group_is_compared_in_few_pairs(spark, monkeypatch, most_in_a_task):
    """Texts that all share lists, few of them similar: compared pairs stay in proportion to the sets, and no link is lost."""
    rng = random.Random(11)
    base = words(rng, 136, 10_000).split()
    rows = []
    for n in range(150):
        text = base[rng.randrange(4):136 - rng.randrange(4)]
        for at in rng.sample(range(len(text)), 3):
            text[at] = f"x{n}y{at}"
        again = list(text)
        again[rng.randrange(len(again))] = f"z{n}"
        rows += [(2 * n, " ".join(text), None, None, 1), (2 * n + 1, " ".join(again), None, None, 1)]
    # Sets on both sides of a map width, so that maps are folded.
    assert len({J.map_width(len(shingles(r[1]))) for r in rows}) == 2
    compared, verified = [], J.verified

    def counted(pairs, known):
        compared.append(pairs.distinct().count())
        return verified(pairs, known)

    monkeypatch.setattr(J, "verified", counted)
    monkeypatch.setattr(J, "SLICE", most_in_a_task, raising=False)
    got = J.near_duplicate_table(spark.createDataFrame(rows, DOCS).repartition(3))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)
    assert sum(compared) <= 10 * len(rows)
