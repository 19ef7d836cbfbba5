from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, ODD_TEXTS, collected, documents, words
from pyspark.sql import functions as F

from tidemart.llm import bpe_count, line_runs, mixing, queries, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- URL filters

URLS = [None, "", "no scheme", "http://", "http://A.Example.org/es/x", "http://example.org/es/", "http://example.org/en/12?q=/es/", "x://org",
        "x://org/", "x://notorg/", "https://a.b.com/fr/?u=http://z.org/", "https://b.com/de/", "https://b.com/de", "https://com/fr/",
        "ftp://ÄX.org/é#/", "http://org?x/", "http://example.org:80/es/", "http://.org/", "http://a.org/" + "p" * 5000]


def brute_rule(url, rules):
    at = (url or "").find("://")
    rest = (url or "")[at + 3:] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    won = max(fits, default=None)
    return host, path, won and won[3], won[2] if won else "allow"


def test_urls_match_brute_force(spark):
    more = (("b.com", "", "block"), ("example.org", "/es/x", "allow"), ("a.b.com", "/fr/", "allow"))
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    for rules in (queries.URL_RULES, queries.URL_RULES + more + more):
        got = collected(url_rules.judge_urls(pages, url_rules.rules_frame(spark, rules)), "page_id")
        for i, url in enumerate(URLS * 2):
            assert tuple(got[i][c] for c in ("host", "path", "rule", "verdict")) == brute_rule(url, rules), url


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = url_rules.rules_frame(spark, [(None, "/", "block"), ("org", "/", "maybe")])
    assert collected(url_rules.judge_urls(pages, none), "page_id")[1]["verdict"] == "allow"
    assert url_rules.judge_urls(pages.limit(0), url_rules.rules_frame(spark, queries.URL_RULES)).collect() == []


# -- mixing

def brute_targets(sizes, cycle=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    share, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2.0 * sizes[s]}
        if not above:
            share |= {s: level * weight[s] for s in free}
            break
        for s in above:
            share[s] = 2.0 * sizes[s]
            left -= share[s]
        free -= above
    return share


@pytest.mark.parametrize(("seed", "most"), [(1, 20_000), (2, 20_000), (3, 3), (4, 1)])
def test_mix_matches_brute_force(spark, monkeypatch, seed, most):
    monkeypatch.setattr(mixing, "SLICE_ROWS", most)
    monkeypatch.setattr(mixing, "SLICES", 8)
    rng = random.Random(seed)
    names = ["a", "b", "Z", "é", None, "empty", "tiny"]
    rows = [(i, words(rng, rng.choice([1, 5, 40, 300])) + (" #$%" * rng.randrange(3)), "en", rng.choices(names[:5], [60, 5, 5, 2, 5])[0], 1)
            for i in range(400)] + [(400, None, "en", "empty", 0), (401, "  ", None, "empty", 0), (402, "one two three", "en", "tiny", 1),
                                    (5, "same row", "en", "a", 1), (5, "same row", "en", "a", 1), (None, "no id", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [r.asDict() for r in mixing.mix_sources(docs).collect()]
    size = {id(r): len(WORD.findall(r[1] or "")) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size[id(r)]
    targets = brute_targets(sizes)
    by_source = defaultdict(list)
    for r in rows:
        n = size[id(r)]
        u = (int(hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        w = (n + 1) / (n + 1 + 20 * len(re.findall(r"[#*$%&|<>]", r[1] or "")))
        by_source[r[3]].append((-math.log(u) / w, r[0] is not None, r[0] or 0, n))
    want = Counter()
    for s, keys in by_source.items():
        budget = math.floor(targets[s] + 0.5)
        epochs = budget // sizes[s] if sizes[s] else 0
        rest = budget - epochs * sizes[s]
        for _, known, doc, n in sorted(keys):
            part = max(0, min(n, rest))
            rest -= part
            want[(doc if known else None, n, sizes[s], round(targets[s], 6), epochs * n + part)] += 1
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got) == want


def test_budget_of_a_noisy_source_ends_in_few_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 100)
    key = F.when(F.col("id") % 3 == 0, 40.0).otherwise(1.0) * -F.log((F.xxhash64("id") % 1_000_000 + 1_000_001) / 2_000_002.0)
    sized = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, F.lit("noisy")).alias("source"),
                                       (F.col("id") % 7).alias("size"), key.alias("_key")).cache()
    plan = sized.groupBy(F.col("source").alias("_s")).agg(
        F.floor(0.8 * F.sum("size")).alias("_rest"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi"), F.lit(0).cast("long").alias("_done"),
        F.count(F.lit(1)).alias("_rows"))
    ends = mixing.budget_ends(sized, plan).collect()
    assert {r["_s"] for r in ends} == {None, "noisy"}
    rows = [tuple(r) for r in sized.select("source", "_key", "size").collect()]
    for r in ends:
        inside = [n for s, k, n in rows if s == r["_s"] and r["_lo"] <= k <= r["_hi"]]
        assert len(inside) == r["_rows"] <= 100
        assert r["_done"] == sum(n for s, k, n in rows if s == r["_s"] and k < r["_lo"])
        assert r["_done"] < r["_rest"] <= r["_done"] + sum(inside)


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(documents(spark, [])).collect() == []
    assert [r["taken"] for r in mixing.mix_sources(documents(spark, [None, ""])).collect()] == [0, 0]


# -- token counts

def test_counts_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    alphabet = "abcdeéèöß ▁  \t\n.,<>#日本😀\u00a0ﬁ0123"
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += [" " * n for n in range(40)] + ["the " * 2000, "ab" * 20000]
    got = collected(bpe_count.count_tokens(documents(spark, texts), path))
    for i, text in enumerate(texts):
        want = len(library.encode(text or ""))
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (want, len((text or "").encode()), want > 4096), repr(text)


def test_counts_of_given_documents_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    folder = "/root/testdata/sf0.001"
    got = collected(queries.token_counts(spark, folder))
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        assert got[r["doc_id"]]["n_tokens"] == len(library.encode(r["text"]))


# -- line dedup

def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(LOWER)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    gone = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [words(rng, 12) for _ in range(25)] + ["short", "", "x" * 40, " " + "Y" * 39 + "\r", "é" * 40]
    texts = list(ODD_TEXTS)
    for _ in range(150):
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", "\r"]) for x in rng.choices(pool, k=rng.randrange(1, 9))]
        texts.append("\n".join(lines))
    rows = [(i, t, None, None, 1) for i, t in enumerate(texts)] + [(None, "\n".join(pool), None, None, 1)] * 2 + [(3, texts[-1], None, None, 1)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    got = line_runs.drop_repeated_lines(docs)
    import pyspark.sql.functions as F

    found = Counter(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect())
    assert found == brute_lines([(r[0], r[1]) for r in rows])


def test_lines_of_nothing(spark):
    assert line_runs.drop_repeated_lines(documents(spark, [])).collect() == []


def test_runs_are_compacted(spark):
    store = line_runs.LineRuns()
    for doc in range(8, 0, -1):
        store.add(spark.createDataFrame([(7, 7, doc, 0, 0), (doc, 0, doc, 0, 0)], "k1 long, k2 long, owner long, twin long, pos int"))
    assert max(len(level) for level in store.levels) < line_runs.FAN_IN
    assert [tuple(r) for r in store.frequent(5).collect()] == [(7, 7, 8)]
