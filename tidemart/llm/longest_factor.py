"""Substring dedup by longest previous factors: previous and next smaller positions in suffix order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import repeats as R
from tidemart.llm import text_arrays as A
from tidemart.llm.common import stored
from tidemart.llm.suffixes import Suffixes, packed, previous_factors

LENGTH = 400
GRAM = 32


def byte_values(chunk: A.Chunk, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    return A.BYTE_VALUES[family][chunk.data], chunk.bounds


def repeated_spans(texts: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """(t1, t2, lo, hi): bytes of each distinct text inside ``length``-byte strings that start elsewhere too.

    With ``keep_first`` only later copies count, in the order of (owner, text hash, position).  Exact copies of a whole text are not compared with each other here.

    Windows of ``length`` bytes that may occur again are dealt by an anchor inside them.  A part orders the suffixes of its distinct
    stretches; a window repeats an earlier one if its longest previous factor is ``length`` or more, and the place that has the
    factor is repeated by it.
    """

    def cut(chunk: A.Chunk, i: int, at: np.ndarray, n: np.ndarray) -> list[bytes]:
        lo = chunk.bounds[i] + at
        return [chunk.data[x:y].tobytes() for x, y in zip(lo, lo + n + length - 1, strict=True)]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = R.Part(batches)
        if part.empty:
            return
        data, bounds = part.chunk.data, part.chunk.bounds
        width = min(8, length)
        suffixes = Suffixes(packed(data, width), bounds, length, width)
        factor, source = previous_factors(suffixes)
        long_ = factor >= length
        earlier = np.zeros(len(data), bool)
        earlier[suffixes.order[long_]] = True
        again = earlier.copy()
        again[source[long_]] = True
        # The first place of each string goes where its factors say; the others, and the first too unless it is to stay, repeat it.
        string, lo, hi = part.runs(earlier if keep_first else again, bounds)
        copies = np.bincount(part.string)
        others = np.ones(len(part.string), bool)
        others[part.first] = False
        if not keep_first:
            others |= copies[part.string] > 1
        r = np.append(part.first[string], np.flatnonzero(others))
        size = np.diff(bounds)[part.string[others]]
        lo, hi = np.append(lo, 0 * size), np.append(hi + length - 1, size)
        if len(r):
            yield R.found_batch(part.t1[r], part.t2[r], part.at[r] + lo, part.at[r] + hi, 0 * r, 0 * r, part.owner[r], np.zeros(len(r), bool))
        # Of anchors that are split over parts, the first of each distinct window goes on.
        if not part.salt.any():
            return
        window = np.zeros(len(data), bool)
        window[suffixes.order] = True
        split = np.flatnonzero(window & ~earlier & np.repeat(part.salt[part.first] > 0, np.diff(bounds)))
        w1, w2 = (A.window_hashes(A.BYTE_VALUES[family][data], length, family).view(np.int64) for family in (0, 1))
        for k in range(0, len(split), 100_000):
            s = split[k:k + 100_000]
            string = np.searchsorted(bounds, s, "right") - 1
            r = part.first[string]
            yield R.found_batch(part.t1[r], part.t2[r], part.at[r] + s - bounds[string], 0 * r, w1[s], w2[s], part.owner[r], np.ones(len(s), bool))

    stretches = R.repeated_stretches(texts, byte_values, length, GRAM, cut, bytes_each=700)
    found = stored(stretches.mapInArrow(solve, R.FOUND), "factors")
    spans = found.where("NOT spread").select("t1", "t2", "lo", "hi")
    split = found.where("spread")
    place = F.struct("owner", "t1", "t2", "lo")
    often = split.groupBy("w1", "w2").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_parts")).where("_parts > 1")
    across = split.join(often, ["w1", "w2"])
    across = across.where(place != F.col("_first")) if keep_first else across
    return spans.unionByName(across.select("t1", "t2", "lo", (F.col("lo") + length).alias("hi")))


def without_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, data (binary: the bytes that stay).

    Texts are their UTF-8 bytes and matches never cross documents.  A byte goes if a ``length``-byte string over it also starts
    anywhere else, in the same document or another, all judged on the input; with ``keep_first`` the first place in the order of
    doc_ids stays.  Texts with an exact copy are all repeats of each other (``keep_first``: all but the smallest doc_id's).

    Null and empty texts have no bytes; texts shorter than ``length`` lose nothing; rows that repeat each other are copies; null
    doc_ids come first; other columns are ignored.  An empty table gives an empty result.
    """
    texts = R.identified(docs)
    classes = R.text_classes(texts)
    spans = (repeated_spans(texts, length, keep_first).groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans")))
    marks = (classes.where("copies > 1").join(spans, ["t1", "t2"], "full_outer")
             .select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.coalesce("_spans", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("_spans"),
                     F.coalesce("copies", F.lit(1)).alias("_copies"), F.coalesce("first_owner", F.lit(R.NO_ID)).alias("_first")))
    marks = R.few(stored(marks, "spans"), "_spans")
    marked = texts.join(marks, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left").select(
        "doc_id", "text", F.coalesce("_spans", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("_spans"),
        ((F.coalesce("_copies", F.lit(1)) > 1) & (~F.lit(keep_first) | (F.col("owner") > F.col("_first")))).alias("_all"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, everything, marks_ = batch.column(0), batch.column(3).to_pylist(), batch.column(2)
            for chunk in A.chunks(batch.column(1)):
                out = []
                for i in range(len(chunk.bounds) - 1):
                    data = chunk.data[chunk.bounds[i]:chunk.bounds[i + 1]].tobytes()
                    row = chunk.first + i
                    if everything[row] and len(data) >= length:
                        out.append((len(data), len(data), 1, b""))
                        continue
                    held = marks_[row].as_py()
                    if not held:
                        out.append((len(data), 0, 0, data))
                        continue
                    lo, hi = R.merged_spans(np.array([m["lo"] for m in held]), np.array([m["hi"] for m in held]))
                    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                    out.append((len(data), len(data) - len(kept), len(lo), kept))
                n = [pa.array(x) for x in list(zip(*out, strict=True))[:3]]
                yield pa.RecordBatch.from_arrays([docs_[chunk.first:chunk.first + len(out)], *(x.cast(pa.int64()) for x in n), pa.array([x[3] for x in out], pa.binary())],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "data"])

    return marked.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, data binary")
