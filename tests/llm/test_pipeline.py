from __future__ import annotations

import random
from collections import Counter

import pytest
import test_op2
import test_op4
import test_op10
from helpers import DOCS, words
from test_op1_op3_op7_op9 import LOWER

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def brute_line_texts(rows):
    import re

    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate(LOWER)

    holders = {}
    for r in rows:
        for line in r[1].split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(r[0])
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    return [(r[0], "\n".join(x for x in r[1].split("\n") if gone.get(key(x), r[0]) == r[0]), *r[2:]) for r in rows]


def test_stages_match_brute_force(spark, tmp_path):
    rng = random.Random(11)
    items = [(i, words(rng, 30, 4000)) for i in range(5)]
    lines = [words(rng, 12, 4000) for _ in range(6)]
    rows = []
    for i in range(260):
        text = words(rng, rng.randrange(40, 140), 4000)
        if i % 9 == 0:
            text += "\n" + rng.choice(lines)
        if i and i % 11 == 0:
            text = rows[-1][1].rsplit(" ", 2)[0] + " changed"
        if i % 13 == 0:
            text += " " + rng.choice(items)[1]
        if i % 17 == 0:
            text = text.replace(" ", " #$%& ")
        rows.append((i, text, "en", rng.choice(["a", "a", "b"]), len(text)))
    for name, frame in (("documents", spark.createDataFrame(rows, DOCS)), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = {k[0] for k in test_op4.brute_kept(rows) if k[-1]}
    left = brute_line_texts([r for r in rows if r[0] in kept])
    left = [r for r in left if (r[0], r[0]) in {(k[0], k[2]) for k in test_op10.brute(left)}]
    clean = {k[0] for k in test_op2.brute(left, items) if not k[-1]}
    left = [r for r in left if r[0] in clean]
    assert 100 < len(left) < 240
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == DOCS.names
    assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter((r[0], r[1]) for r in left)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(r[1].split())) for r in left)
    assert sum(r["taken"] for r in got) == pytest.approx(1.5 * sum(r["size"] for r in got), abs=2)
