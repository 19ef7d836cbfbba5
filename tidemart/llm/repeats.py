"""Where a window of one text may occur again: the stretches around repeated anchors, dealt to memory-sized parts.

Both substring operators start here.  A text is known by a 128-bit hash (t1, t2), so exact copies are one text.  Equal windows
have equal anchors; only windows whose anchor occurs in two places are shipped, each once, to the part of its anchor.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import text_arrays as A
from tidemart.llm.common import stored

NO_ID = -(1 << 63)
# An anchor with more places than this is split over parts, and its windows are compared across parts afterwards.  Bounded by
# a task's memory: 20,000 places have some 12 MB of text, and a suffix order takes about 50 bytes for each byte of distinct strings.
GROUP_PLACES = 20_000
# Bytes of text that a part holds on average.
PART_BYTES = 4 << 20
# Texts whose marks are broadcast by hint: rows and marks, both counted.
FEW_TEXTS, FEW_MARKS = 100_000, 2_000_000

STRETCHES = "a long, salt int, t1 long, t2 long, owner long, at long, n long, data binary"
FOUND = "t1 long, t2 long, lo long, hi long, w1 long, w2 long, owner long, spread boolean"


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, owner, t1, t2, text); owner is the doc_id or NO_ID."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("owner"),
                       F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("2"), text).alias("t2"), text.alias("text"))


def text_classes(texts: DataFrame) -> DataFrame:
    """(t1, t2, first_owner, copies): one row for each distinct text."""
    return texts.groupBy("t1", "t2").agg(F.min("owner").alias("first_owner"), F.count(F.lit(1)).alias("copies"))


def few(marks: DataFrame, column: str) -> DataFrame:
    """A broadcast hint if counts show few rows with few marks; else the frame as it is."""
    rows, total = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(column)), F.lit(0))).first()
    return F.broadcast(marks) if rows <= FEW_TEXTS and total <= FEW_MARKS else marks


Values = Callable[[A.Chunk], tuple[np.ndarray, np.ndarray]]


def anchor_table(texts: DataFrame, values: Values, window: int, gram: int) -> DataFrame:
    """(a, t1, t2, owner, at, n, twice): stretches of ``n`` windows from ``at`` with anchor hash ``a``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, owner = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for chunk in A.chunks(batch.column(3)):
                text, at, n, h, twice = A.anchors(*values(chunk), window, gram)
                row = text + chunk.first
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), t1[row], t2[row], owner[row], at, n, twice)],
                                                 names=["a", "t1", "t2", "owner", "at", "n", "twice"])

    return texts.select("t1", "t2", "owner", "text").mapInArrow(find, "a long, t1 long, t2 long, owner long, at long, n long, twice boolean")


def repeated_stretches(texts: DataFrame, values: Values, window: int, gram: int,
                       cut: Callable[[A.Chunk, int, np.ndarray, np.ndarray], list[bytes]], bytes_each: int) -> DataFrame:
    """STRETCHES rows of one copy of each text, dealt by (a, salt).  ``cut`` gives the bytes of stretches of one text."""
    found = stored(anchor_table(texts, values, window, gram), "anchors")
    place = F.struct("t1", "t2", "at")
    again = (found.groupBy("a").agg(F.count(F.lit(1)).alias("places"), F.min(place).alias("_x"), F.max(place).alias("_y"), F.max("twice").alias("_twice"))
             .where("_x <> _y OR _twice").select("a", F.ceil(F.col("places") / GROUP_PLACES).cast("int").alias("salts")))
    # A hot anchor sits on the larger side of this join, whose partitions Spark can split.
    kept = stored(found.join(again, "a"), "repeated_anchors")
    per_text = stored(kept.groupBy("t1", "t2").agg(F.min("owner").alias("_owner"), F.collect_set(F.struct("at", "n", "a", "salts")).alias("_marks")), "marks")
    parts = 1 + kept.count() * bytes_each // PART_BYTES

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, owner = (batch.column(i).to_pylist() for i in range(3))
            marks = batch.column(4)
            for chunk in A.chunks(batch.column(3)):
                out: list[tuple] = []
                for i in range(len(chunk.bounds) - 1):
                    row = chunk.first + i
                    held = marks[row].as_py()
                    at, n = np.array([m["at"] for m in held]), np.array([m["n"] for m in held])
                    for m, data in zip(held, cut(chunk, i, at, n), strict=True):
                        # Equal strings of a split anchor go to the same part, where they are held once.
                        out.append((m["a"], 0 if m["salts"] < 2 else 1 + zlib.crc32(data) % m["salts"], t1[row], t2[row], owner[row], m["at"], m["n"], data))
                if out:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                     names=["a", "salt", "t1", "t2", "owner", "at", "n", "data"])

    named = per_text.withColumnsRenamed({"t1": "_t1", "t2": "_t2"})
    marked = (texts.join(few(named, "_marks"), (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")) & (F.col("owner") == F.col("_owner")))
              .select("t1", "t2", "owner", "text", "_marks"))
    sizes = texts.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return marked.mapInArrow(ship, STRETCHES).repartition(max(parts, int(sizes)), "a", "salt")


def merged_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of [lo, hi) as maximal runs, touching ones joined."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    at = np.flatnonzero(new)
    return lo[at], hi[np.append(at[1:], len(lo)) - 1] if len(lo) else hi


def found_batch(t1, t2, lo, hi, w1, w2, owner, spread) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(x, np.int64)) for x in (t1, t2, lo, hi, w1, w2, owner)] + [pa.array(np.asarray(spread, bool))]
    return pa.RecordBatch.from_arrays(arrays, names=["t1", "t2", "lo", "hi", "w1", "w2", "owner", "spread"])


class Part:
    """The stretches of one part: a row for each place, in the order of places, and the distinct strings that they hold.

    Places are in the order of (owner, text hash, position).  Strings are numbered and laid end to end in the order of their first
    places, so a hot group of copies is held once.  ``string`` is the number of each row's string, ``first`` the first row of each.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        columns: list[list] = [[] for _ in range(5)]
        strings: dict[bytes, int] = {}
        numbers: list[int] = []
        for batch in batches:
            for held, i in zip(columns, range(1, 6), strict=True):
                held.append(batch.column(i).to_numpy(zero_copy_only=False))
            numbers.extend(strings.setdefault(data, len(strings)) for data in batch.column(7).to_pylist())
        self.empty = not numbers
        if self.empty:
            return
        salt, t1, t2, owner, at = (np.concatenate(c) for c in columns)
        order = np.lexsort((at, t2, t1, owner))
        # Rows that repeat each other bring the same stretch twice.
        again = np.zeros(len(order), bool)
        again[1:] = (at[order[1:]] == at[order[:-1]]) & (t1[order[1:]] == t1[order[:-1]]) & (t2[order[1:]] == t2[order[:-1]])
        order = order[~again]
        self.salt, self.t1, self.t2, self.owner, self.at = (x[order] for x in (salt, t1, t2, owner, at))
        _, first, number = np.unique(np.array(numbers)[order], return_index=True, return_inverse=True)
        by_place = np.argsort(first)
        self.first = first[by_place]
        self.string = np.argsort(by_place)[number]
        held = list(strings)
        texts = [held[n] for n in np.array(numbers)[order][self.first]]
        bounds = np.cumsum([0, *map(len, texts)])
        self.chunk = A.Chunk(0, np.frombuffer(b"".join(texts), np.uint8), bounds)

    def runs(self, gone: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(string, from, to) of the runs of ``gone``, which has an entry for each value of the strings cut by ``bounds``."""
        places = np.flatnonzero(gone)
        string = np.searchsorted(bounds, places, "right") - 1
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (string[1:] != string[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(places)) - 1 if len(at) else at
        return string[at], places[at] - bounds[string[at]], places[last] + 1 - bounds[string[at]]


def each_row(strings: np.ndarray, of_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, entry) for every row of ``of_rows`` and entry of the ascending ``strings`` that have the same string."""
    lo, hi = np.searchsorted(strings, of_rows, "left"), np.searchsorted(strings, of_rows, "right")
    row = np.repeat(np.arange(len(of_rows)), hi - lo)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[row]
