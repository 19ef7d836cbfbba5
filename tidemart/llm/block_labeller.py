"""HTML main text by a recurrent block labeller: a bidirectional LSTM in numpy over a page's leaf blocks."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.html_blocks import blocks_of

WEIGHTS = Path(__file__).with_name("block_labeller.npz")
PATH_DIM, WORD_DIM, NUMBERS = 160, 32, 8
INPUT = PATH_DIM + WORD_DIM + NUMBERS
HIDDEN = 20
# Blocks of pages that are labelled together, about; a longer page is labelled alone.
BATCH_BLOCKS = 8_192
NAME = re.compile(r"[a-z]+")
REMEMBERED = 100_000


def _hashed(token: str, dim: int) -> tuple[int, float]:
    h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
    return h % dim, 1.0 if h & 0x40000000 else -1.0


class Features:
    """Input vectors of a page's blocks; paths and words are remembered up to a bound that changes no result."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, tuple[int, float]] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(path)
        if known is None:
            known = np.zeros(PATH_DIM, np.float32)
            for depth, element in enumerate(reversed(path)):
                tag, *names = NAME.findall(element.lower())[:12] or [""]
                tokens = [f"{tag}@{min(depth, 2)}", f"in {tag}", *(f"name {n}" for n in names)]
                for token in tokens:
                    i, sign = _hashed(token, PATH_DIM)
                    known[i] += sign
            known = np.clip(known, -3, 3)
            if len(self.paths) >= REMEMBERED:
                self.paths.clear()
            self.paths[path] = known
        return known

    def page(self, blocks: list[tuple[str, tuple[str, ...], int]]) -> np.ndarray:
        out = np.zeros((len(blocks), INPUT), np.float32)
        known = self.words
        for row, (text, path, links) in enumerate(blocks):
            words = text.split(" ")
            x = out[row]
            x[:PATH_DIM] = self.path(path)
            counts = [0.0] * WORD_DIM
            for word in words:
                at = known.get(word)
                if at is None:
                    at = _hashed(word.lower().strip(".,:;!?()\"'"), WORD_DIM)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = at
                counts[at[0]] += at[1]
            n = len(words)
            norm = math.sqrt(sum(c * c for c in counts))
            x[PATH_DIM:PATH_DIM + WORD_DIM] = np.array(counts, np.float32) * (3 / (1 + norm))
            x[-NUMBERS:] = (min(math.log1p(n), 7.0) / 3, min(links / len(text), 1.0), text[-1] in ".!?:;\"'…", min(len(text) / n, 20.0) / 8, text.count(",") / n * 4,
                            row / len(blocks), sum(map(text.count, "0123456789")) / len(text), min(math.log1p(len(blocks)), 6.0) / 4)
        return out


class BlockLabeller:
    """Two LSTMs, one from the first block and one from the last, and a logistic output for each block."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    @classmethod
    def load(cls, path: Path = WEIGHTS) -> BlockLabeller:
        with np.load(path) as held:
            return cls(dict(held))

    @classmethod
    def fresh(cls, seed: int = 1) -> BlockLabeller:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, 1 / math.sqrt(INPUT), (INPUT, 4 * HIDDEN))
            w[f"h{side}"] = rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"b{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        return cls(w | {"out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)})

    def states(self, x: np.ndarray, mask: np.ndarray, side: str) -> list[tuple[np.ndarray, ...]]:
        """Per step of (pages, blocks, inputs): gates, cell and hidden state; masked steps carry the last state on."""
        w, steps = self.w, range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1)
        h, c = (np.zeros((len(x), HIDDEN), np.float32) for _ in range(2))
        given = x @ w[f"x{side}"] + w[f"b{side}"]
        out: list = [None] * x.shape[1]
        for t in steps:
            z = given[:, t] + h @ w[f"h{side}"]
            i, f, o = (1 / (1 + np.exp(-z[:, k * HIDDEN:(k + 1) * HIDDEN])) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            before, was = c, h
            c = m * (f * c + i * g) + (1 - m) * c
            h = m * (o * np.tanh(c)) + (1 - m) * h
            out[t] = (h, c, i, f, o, g, before, was)
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([np.stack([s[0] for s in self.states(x, mask, side)], 1) for side in "fb"], 2)
        return both @ self.w["out"] + self.w["bias"]

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length are labelled together."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= BATCH_BLOCKS:
                end += 1
            some = order[at:end]
            longest = max(len(pages[i]) for i in some)
            if longest:
                x, mask = padded([pages[i] for i in some], longest)
                found = self.scores(x, mask) > 0
                for row, i in enumerate(some):
                    out[i] = found[row, :len(pages[i])]
            at = end
        return out


def padded(pages: list[np.ndarray], longest: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(pages), longest, INPUT), np.float32)
    mask = np.zeros((len(pages), longest), np.float32)
    for row, page in enumerate(pages):
        x[row, :len(page)] = page
        mask[row, :len(page)] = 1
    return x, mask


def extract_main_text(pages: DataFrame, labeller: BlockLabeller | None = None) -> DataFrame:
    """Per page: page_id, url, text (the main text, empty if none), n_chars (its code points).

    The page falls into leaf blocks (text between block-level tags, white space made one space, character references decoded;
    scripts, styles, templates and the title are no text).  The labeller judges each block by its tag path with class and id names,
    its hashed words and the blocks of the whole page; main blocks are joined by one space.  Rows stay where they are read.

    Null and empty pages have no text; broken markup is read as far as it goes; repeated rows repeat; other columns are ignored.
    """
    weights = (labeller or BlockLabeller.load()).w

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = BlockLabeller(weights), Features()
        for batch in batches:
            html, row = batch.column(2), 0
            while row < len(html):
                texts: list[list[str]] = []
                vectors, total, first = [], 0, row
                while row < len(html) and total < BATCH_BLOCKS:
                    blocks = blocks_of(html[row].as_py() or "")
                    vectors.append(features.page(blocks))
                    texts.append([b[0] for b in blocks])
                    total += len(blocks)
                    row += 1
                found = [" ".join(t for t, main in zip(page, labels, strict=True) if main) for page, labels in zip(texts, model.label(vectors), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:row], batch.column(1)[first:row], pa.array(found, pa.string())], names=["page_id", "url", "text"])

    done = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(extract, "page_id long, url string, text string")
    return done.withColumn("n_chars", F.length("text").cast("long"))
