"""Substring dedup by suffix trees over words: deep internal nodes give the repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import repeats as R
from tidemart.llm import text_arrays as A
from tidemart.llm.common import stored
from tidemart.llm.suffixes import Suffixes

WINDOW = 50
GRAM = 8
SPANS = "array<struct<lo:bigint,hi:bigint>>"


def _words(chunk: A.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not hasattr(chunk, "words"):
        chunk.words = A.words(chunk)
    return chunk.words


def word_values(chunk: A.Chunk, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = _words(chunk)
    return A.word_hashes(chunk, starts, ends, family), bounds


def word_numbers(chunk: A.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the chunk, equal for equal words (by 128 bits of hash), and ``bounds`` in words."""
    starts, ends, bounds = _words(chunk)
    first, second = (A.word_hashes(chunk, starts, ends, family) for family in (0, 1))
    order = np.lexsort((second, first))
    numbers = np.zeros(len(order), np.int64)
    numbers[order] = A.runs_of([first[order], second[order]]) if len(order) else order
    return numbers, bounds


def deep_nodes(suffixes: Suffixes) -> np.ndarray:
    """The number of the subtree at the tree's full depth that each entry of ``suffixes.order`` is a leaf of.

    Neighbours in suffix order share a node as deep as what they have in common: maximal runs that share ``depth`` or more are
    the leaves under one internal node of that depth, the maximal repeats that long; runs of one are leaves alone.
    """
    return np.cumsum(suffixes.common < suffixes.depth) - 1


def later_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(t1, t2, lo, hi): words of each distinct text inside windows that also start in a text whose first doc_id is smaller.

    Windows that may occur again are dealt by an anchor, 8 words inside the window.  A part splits the suffixes of its distinct
    stretches by prefixes, longer ones where more than one suffix is left, into the subtrees of their common windows.  An anchor
    with more windows than a part should hold is dealt further by salt; each part then decides what it can, and what is left
    meets by the whole window, with the smallest doc_id taken before the shuffle.
    """

    def cut(chunk: A.Chunk, i: int, at: np.ndarray, n: np.ndarray) -> list[bytes]:
        starts, ends, bounds = _words(chunk)
        lo = bounds[i] + at
        return [chunk.data[x:y].tobytes() for x, y in zip(starts[lo], ends[lo + n + window - 2], strict=True)]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = R.Part(batches)
        if part.empty:
            return
        numbers, bounds = word_numbers(part.chunk)
        suffixes = Suffixes(numbers, bounds, window)
        string = np.repeat(np.arange(len(part.first)), np.diff(bounds))
        owner = part.owner[part.first][string]
        node = deep_nodes(suffixes)
        least = np.minimum.reduceat(owner[suffixes.order], np.flatnonzero(np.diff(node, prepend=-1)))[node]
        gone = np.zeros(len(numbers), bool)
        gone[suffixes.order] = owner[suffixes.order] > least
        # Rows of a string's smallest doc_id lose what a smaller one has; all other rows repeat that doc_id's.
        lowest = part.owner == part.owner[part.first][part.string]
        rows, others = np.flatnonzero(lowest), np.flatnonzero(~lowest)
        of, lo, hi = part.runs(gone, bounds)
        row, entry = R.each_row(of, part.string[rows])
        r = np.append(rows[row], others)
        size = np.diff(bounds)[part.string[others]]
        lo, hi = np.append(lo[entry], 0 * size), np.append(hi[entry] + window - 1, size)
        if len(r):
            yield R.found_batch(part.t1[r], part.t2[r], part.at[r] + lo, part.at[r] + hi, 0 * r, 0 * r, part.owner[r], np.zeros(len(r), bool))
        if not part.salt.any():
            return
        left = np.zeros(len(numbers), bool)
        left[suffixes.order] = True
        left = np.flatnonzero(left & ~gone & (part.salt[part.first] > 0)[string])
        w1, w2 = (A.window_hashes(word_values(part.chunk, family)[0], window, family).view(np.int64) for family in (0, 1))
        for k in range(0, len(rows), 1_000):
            row, entry = R.each_row(string[left], part.string[rows[k:k + 1_000]])
            r, w = rows[k + row], left[entry]
            yield R.found_batch(part.t1[r], part.t2[r], part.at[r] + w - bounds[string[w]], 0 * r, w1[w], w2[w], part.owner[r], np.ones(len(r), bool))

    stretches = R.repeated_stretches(texts, word_values, window, GRAM, cut, bytes_each=500)
    found = stored(stretches.mapInArrow(solve, R.FOUND), "subtrees")
    spans = found.where("NOT spread").select("t1", "t2", "lo", "hi")
    left = found.where("spread")
    least = left.groupBy("w1", "w2").agg(F.min("owner").alias("_least"), F.max("owner").alias("_most")).where("_least < _most")
    across = left.join(least, ["w1", "w2"]).where("owner > _least")
    return spans.unionByName(across.select("t1", "t2", "lo", (F.col("lo") + window).alias("hi")))


def without_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, data (binary: the words that stay, joined by one space).

    A word goes if a window of ``window`` words over it also starts in a document with a smaller doc_id, judged on the input.
    Documents that repeat a whole text of a smaller doc_id lose all words, if they have a window.

    Null and blank texts have no words; shorter texts lose nothing; rows with the same doc_id do not remove from each other; null
    doc_ids are smaller than all others; other columns are ignored.  An empty table gives an empty result.
    """
    texts = R.identified(docs)
    classes = R.text_classes(texts)
    spans = later_spans(texts, window).groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
    none = F.array().cast(SPANS)
    marks = (classes.where("copies > 1").join(spans, ["t1", "t2"], "full_outer")
             .select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.coalesce("_spans", none).alias("_spans"), F.col("first_owner").alias("_first")))
    marks = R.few(stored(marks, "spans"), "_spans")
    marked = texts.join(marks, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left").select(
        "doc_id", "text", F.coalesce("_spans", none).alias("_spans"), F.coalesce(F.col("owner") > F.col("_first"), F.lit(False)).alias("_all"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everything, marks_ = batch.column(3).to_pylist(), batch.column(2)
            for chunk in A.chunks(batch.column(1)):
                out = []
                for i in range(len(chunk.bounds) - 1):
                    words = chunk.data[chunk.bounds[i]:chunk.bounds[i + 1]].tobytes().split()
                    row, n = chunk.first + i, len(words)
                    if everything[row] and n >= window:
                        words = []
                    elif held := marks_[row].as_py():
                        lo, hi = R.merged_spans(np.array([m["lo"] for m in held]), np.array([m["hi"] for m in held]))
                        edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), n]
                        words = [x for a, b in zip(edges[::2], edges[1::2], strict=True) for x in words[a:b]]
                    out.append((n, n - len(words), b" ".join(words)))
                n, gone, data = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0)[chunk.first:chunk.first + len(out)], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(data, pa.binary())],
                                                 names=["doc_id", "n_words", "n_removed", "data"])

    return marked.mapInArrow(remove, "doc_id long, n_words long, n_removed long, data binary")
