"""Size-aware heavy-light Jaccard join of shingle sets, and its connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import text_arrays as A
from tidemart.llm.common import own_names, small, stored
from tidemart.llm.components import components, extended

SHINGLE = 5
# Similarity as a fraction, so that all bounds are whole numbers: 100 * intersection >= 75 * union.
UP, DOWN = 75, 100
# The boundary between small and large sets is sought up to this size.
MOST_SMALL = 24
# Scanning one entry of an inverted list, with the checks that follow, costs as much as so many enumerated subsets.
LIST_COST = 6
# Inverted lists up to this length give all their pairs; longer ones link to a centre first.
LIGHT_LIST = 16
# Bytes of text for each range of shingle hashes; partners of one centre that are verified in one task.
RANGE_BYTES, CENTRE_PARTNERS = 4 << 20, 1_000
# Entries of an inverted list that one task holds; longer lists are split, and their parts meet in later rounds.
LIST_ENTRIES = 50_000
# Bits of a set's parity map for each shingle, and the bounds of its width; past some 7,000 shingles it tells nothing.
MAP_BITS, LEAST_MAP, MOST_MAP = 4, 512, 4096
# Entries of a list that meet in one task; longer lists are cut into slices, and each two of them meet in a task.
SLICE = 8_192
# Sets of lists are compared only with the nearest one in another component while that links this share of them; then come all others.
NEAREST_SHARE = 8
# Shingles in so many texts are put last, most frequent last.  Their number, which is broadcast, is bounded.
FREQUENT, MOST_FREQUENT = 8, 1 << 20
# Shingles or list entries that a task gathers before it sends them on.
FLUSHED = 1 << 19
NO_ID = -(1 << 63)


def needed(n: int, m: int) -> int:
    """Least intersection of similar sets of these sizes."""
    return -(-UP * (n + m) // (UP + DOWN))


def subset_sizes(n: int, most: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) for the partners of a set of ``n`` up to size ``most``."""
    return [(min(n, m), max(n, m), needed(n, m)) for m in range(1, most + 1) if needed(n, m) <= min(n, m)]


def boundary(counts: dict[int, int]) -> int:
    """Largest size of a small set, by cost: subsets of all small sets plus list entries of the others that may meet a large one."""
    def cost(b: int) -> int:
        subsets = sum(c * sum(comb(n, t) for _, _, t in subset_sizes(n, b)) for n, c in counts.items() if n <= b)
        entries = sum(c * (n - needed_alone(n) + 1) for n, c in counts.items() if n >= needed_alone(b + 1))
        return subsets + LIST_COST * entries

    return min(range(MOST_SMALL + 1), key=lambda b: (cost(b), b))


def needed_alone(n: int) -> int:
    """Least intersection of a set of ``n`` with any similar set, which is also the least size of one."""
    return -(-UP * n // DOWN)


def shingle_sets(chunk: A.Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash), distinct, ordered by text and hash."""
    starts, ends, bounds = A.words(chunk)
    values = A.word_hashes(chunk, starts, ends, 0, lower=True)
    n = np.diff(bounds)
    count = np.maximum(n - size + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(text)) - (np.cumsum(count) - count)[text] + bounds[:-1][text]
    hashes = A.window_hashes(values, size, 0)[at] if len(text) else np.zeros(0, np.uint64)
    for length in range(1, size):
        few = np.flatnonzero(n == length)
        if len(few):
            whole = A.window_hashes(values, length, 0)[bounds[few]] + np.uint64(length)
            text, hashes = np.concatenate([text, few]), np.concatenate([hashes, whole])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def _by_range(keys: np.ndarray, bits: int, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Columns of entries cut by the top ``bits`` of their key, as bytes."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    tops = (keys[order] >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, tops[1:] != tops[:-1]))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(tops)), strict=True):
        yield int(tops[lo]), [c[order[lo:hi]].tobytes() for c in columns]


def frequent_shingles(texts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (32 bits below the range bits of a hash, plus those) of frequent shingles and the logarithm of their frequency.

    Only an order is made from it, so shingles that share a cell do no harm; the order decides how fast the join is, never what
    it finds.  Counts are taken over all texts; of the cells, the most frequent ones go to the driver, at most ``MOST_FREQUENT``.
    """
    shift = np.uint64(64 - bits - 32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            out = list(_by_range(keys, bits, [((keys >> shift) & np.uint64(0xFFFFFFFF)).astype(np.uint32)]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([c[0] for _, c in out], pa.binary())], names=["range", "cells"])

        for batch in batches:
            for chunk in A.chunks(batch.column(0)):
                held.append(shingle_sets(chunk)[1])
                if sum(map(len, held)) >= FLUSHED:
                    yield from flush()
        yield from flush()

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for key, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(key, []).append(cells)
        for key, blobs in held.items():
            cells, counts = np.unique(np.frombuffer(b"".join(blobs), np.uint32), return_counts=True)
            many = counts >= FREQUENT
            yield pa.RecordBatch.from_arrays([pa.array((key << 32) + cells[many].astype(np.int64)), pa.array(counts[many].astype(np.int64))], names=["cell", "n"])

    counted = stored(texts.select("text").mapInArrow(count, "range long, cells binary").repartition(max(1, 1 << bits), "range")
                     .mapInArrow(often, "cell long, n long").withColumn("power", F.floor(F.log2("n")).cast("int")), "frequent")
    least, total = 64, 0
    for power, n in sorted(((r[0], r[1]) for r in counted.groupBy("power").count().collect()), reverse=True):
        if total + n > MOST_FREQUENT:
            break
        least, total = power, total + n
    top = counted.where(F.col("power") >= least).select("cell", "power").toPandas()
    order = np.argsort(top["cell"].to_numpy(np.int64))
    return top["cell"].to_numpy(np.int64)[order], top["power"].to_numpy(np.int64)[order]


def set_table(texts: DataFrame, bits: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(owner, twin, n, id, id2, tokens): size and 128-bit hash of each set, and its first shingles in the global order.

    The first ``n - ceil(0.75 n) + 1`` shingles: similar sets share one of them.  Sets up to ``MOST_SMALL`` have all.
    """
    held = texts.sparkSession.sparkContext.broadcast(frequent)
    shift = np.uint64(64 - bits - 32)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, powers = held.value
        for batch in batches:
            for chunk in A.chunks(batch.column(2)):
                rows = len(chunk.bounds) - 1
                text, h = shingle_sets(chunk)
                n = np.bincount(text, minlength=rows)
                ids = []
                for family in (0, 1):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(A.mixed(h + A.BASES[family]))])
                    ends = np.cumsum(n)
                    ids.append(A.mixed(sums[ends] - sums[ends - n]).view(np.int64))
                power = np.zeros(len(h), np.int64)
                if len(cells):
                    own = (h >> shift).astype(np.int64)
                    at = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
                    power = np.where(cells[at] == own, powers[at], 0)
                order = np.lexsort((h, power, text))
                place = np.arange(len(h)) - (np.cumsum(n) - n)[text]
                first = np.where(n > MOST_SMALL, n + (-UP * n // DOWN) + 1, n)
                kept = h[order][place < first[text]]
                edges = np.append(0, np.cumsum(np.minimum(first, n)))
                blobs = [kept[x:y].tobytes() for x, y in zip(edges, edges[1:], strict=False)]
                part = slice(chunk.first, chunk.first + rows)
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], pa.array(n.astype(np.int64)), pa.array(ids[0]), pa.array(ids[1]), pa.array(blobs, pa.binary())],
                                                 names=["owner", "twin", "n", "id", "id2", "tokens"])

    return texts.select("owner", "twin", "text").mapInArrow(sets, "owner long, twin long, n long, id long, id2 long, tokens binary")


PAIRS = "token long, a long, b long, n int, pos int"


def candidates(sets: DataFrame, small_up_to: int, bits: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """PAIRS rows: candidate pairs (a, b) with token 0, and entries (token, a) of lists that were too long for all pairs, with b 0.

    Small sets meet in enumerated subsets as large as their intersection must be: sets with a subset in common are similar, so one
    link for each to the first is enough.  Large sets, and small ones that a large one may be similar to, meet in the inverted
    lists of their first shingles, under length and position bounds.
    """
    held = sets.sparkSession.sparkContext.broadcast(frequent)
    shift = np.uint64(64 - bits - 32)
    listed_from = needed_alone(small_up_to + 1)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, powers = held.value
        seen: set[int] = set()
        held_: tuple[list, list, list, list] = ([], [], [], [])

        def flush() -> Iterator[pa.RecordBatch]:
            token, owner, size, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in held_)
            for x in held_:
                x.clear()
            if not len(token):
                return
            salt = np.zeros(len(token), np.int64)
            if len(cells):
                own = (token >> shift).astype(np.int64)
                at = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
                parts = np.where(cells[at] == own, (2 << powers[at]) // LIST_ENTRIES + 1, 1)
                parts = np.where(place < 0, 1, parts)
                salt = np.where(parts > 1, 1 + (owner.view(np.uint64) % parts.astype(np.uint64)).astype(np.int64), 0)
            for s in np.unique(salt):
                w = salt == s
                out = list(_by_range(token[w], bits, [token[w], owner[w], size[w], place[w]]))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([int(s)] * len(out), pa.int64()),
                                                  *(pa.array([c[i] for _, c in out], pa.binary()) for i in range(4))],
                                                 names=["range", "salt", "token", "owner", "size", "place"])

        def add(token: np.ndarray, key: int, n: int, place: np.ndarray) -> None:
            for x, values in zip(held_, (token, np.full(len(token), key, np.int64), np.full(len(token), n, np.int32), place), strict=True):
                x.append(values)

        for batch in batches:
            waiting = 0
            for n, key, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key in seen:  # copies of a set that this task has sent
                    continue
                seen.add(key)
                h = np.frombuffer(blob, np.uint64)
                if n >= listed_from:
                    p = n - needed_alone(n) + 1
                    add(h[:p], key, n, np.arange(p, dtype=np.int32))
                    waiting += p
                if n <= small_up_to:
                    ordered = np.sort(h)
                    for lo, hi, t in subset_sizes(n, small_up_to):
                        picks = np.array(list(combinations(range(n), t)), np.int64)
                        seed = (lo << 16) + (hi << 8) + t
                        keys = A.mixed(np.cumsum(A.mixed(ordered[picks] + np.arange(1, t + 1, dtype=np.uint64) * A.BASES[1]), axis=1)[:, -1] + np.uint64(seed))
                        add(keys, key, n, np.full(len(keys), -1, np.int32))
                        waiting += len(keys)
                if waiting >= FLUSHED:
                    yield from flush()
                    waiting = 0
            yield from flush()

    def pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_: dict[tuple[int, int], list[list[bytes]]] = {}
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                held_.setdefault(row[:2], []).append(row[2:])
        kinds = (np.uint64, np.int64, np.int32, np.int32)
        while held_:
            (_, salt), rows = held_.popitem()
            token, owner, size, place = (np.frombuffer(b"".join(r[i] for r in rows), k) for i, k in enumerate(kinds))
            yield from _pairs_of_lists(token, owner, size, place, small_up_to, salt > 0)

    dealt = sets.select("n", "id", "tokens").mapInArrow(entries, "range long, salt long, token binary, owner binary, size binary, place binary")
    return dealt.repartition(max(1, 1 << bits), "range", "salt").mapInArrow(pair_up, PAIRS)


def may_match(n1, n2, p1, p2) -> np.ndarray:
    """Length bound, and position bound for the first shingle that two sets share."""
    n1, n2, p1, p2 = (np.asarray(x, np.int64) for x in (n1, n2, p1, p2))
    least = -(-UP * (n1 + n2) // (UP + DOWN))
    return (least <= np.minimum(n1, n2)) & (1 + np.minimum(n1 - 1 - p1, n2 - 1 - p2) >= least)


def _pairs_of_lists(token, owner, size, place, small_up_to, part_of_list) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((owner, size, token))
    token, owner, size, place = token[order], owner[order], size[order], place[order]
    once = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
    token, owner, size, place = token[once], owner[once], size[once], place[once]
    new = np.append(True, token[1:] != token[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(token)))
    run = np.cumsum(new) - 1
    subset = place[first] < 0
    pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def listed(x: np.ndarray, y: np.ndarray) -> None:
        ok = may_match(size[x], size[y], place[x], place[y]) & (np.maximum(size[x], size[y]) > small_up_to)
        pairs.append((owner[x[ok]], owner[y[ok]]))

    light = np.flatnonzero((length <= LIGHT_LIST)[run] & ~subset[run])
    for step in range(1, min(LIGHT_LIST, len(token))):
        x = light[light + step < len(token)]
        x = x[run[x] == run[x + step]]
        if not len(x):
            break
        listed(x, x + step)
    # A centre for each long list: of the sets near its middle size, so that most lengths fit, the one with the least id, so
    # that lists of much the same sets have the same centre and give the same pairs.
    long_ = np.flatnonzero((length > LIGHT_LIST) & ~subset) if not part_of_list else np.flatnonzero(~subset)
    members = np.flatnonzero(np.isin(run, long_))
    if len(members):
        middle = size[(first + length // 2)[run[members]]]
        near = members[(size[members] >= 0.9 * middle) & (size[members] <= 1.1 * middle)]
        by_id = near[np.lexsort((owner[near], run[near]))]
        heads = by_id[np.append(True, run[by_id[1:]] != run[by_id[:-1]])]
        centres = np.zeros(len(first), np.int64)
        centres[run[heads]] = heads
        centre = centres[run[members]]
        apart = members != centre
        listed(members[apart], centre[apart])
    # Subsets in common: each smaller set links to the first larger one and each larger one to the first smaller one; sets of
    # one size link to the first if the subset was made for pairs of that size, which the check of pairs decides.
    s = np.flatnonzero(subset[run])
    if len(s):
        least = first[run[s]]
        larger = s[size[s] != size[least]][::-1]
        first_larger = first.copy()
        first_larger[run[larger]] = larger
        partner = np.where(size[s] == size[least], first_larger[run[s]], least)
        pairs.append((owner[s], owner[partner]))
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1)) if pairs else (np.zeros(0, np.int64),) * 2
    low, high = np.minimum(a, b), np.maximum(a, b)
    keep = low != high
    both = np.unique(np.stack([low[keep], high[keep]], 1), axis=0)
    zero = np.zeros(len(both), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(zero.astype(np.int64)), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(zero), pa.array(zero)], names=["token", "a", "b", "n", "pos"])
    if len(members):
        zero = np.zeros(len(members), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(token[members].view(np.int64)), pa.array(owner[members]), pa.array(zero), pa.array(size[members]), pa.array(place[members])],
                                         names=["token", "a", "b", "n", "pos"])


def verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b), stored and distinct, those that are similar, by their whole sets.  ``known``: (id, text) of one text for each set.

    The texts of b come to the text of a in one task, one after the other; a set with many partners has its text sent to several
    tasks.
    """
    # The end with more partners becomes the centre.
    degree = stored(pairs.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("d")), "degrees")
    turned = (pairs.join(degree.select(F.col("v").alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col("v").alias("b"), F.col("d").alias("db")), "b")
              .select(F.when(F.col("da") >= F.col("db"), F.col("a")).otherwise(F.col("b")).alias("c"), F.when(F.col("da") >= F.col("db"), F.col("b")).otherwise(F.col("a")).alias("m")))
    spread = turned.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / CENTRE_PARTNERS).cast("int").alias("parts"))
    turned = stored(turned.join(spread, "c").withColumn("part", F.pmod(F.hash("m"), F.col("parts"))), "turned")
    ids = turned.select(F.explode(F.array("c", "m")).alias("id")).distinct()
    known = stored(known.join(small(stored(ids, "ids")), "id"), "known")
    centres = (turned.select("c", "part").distinct().join(known, F.col("c") == F.col("id")).select("c", "part", F.lit(True).alias("centre"), "id", "text"))
    members = turned.join(known, F.col("m") == F.col("id")).select("c", "part", F.lit(False).alias("centre"), "id", "text")
    dealt = centres.unionByName(members).repartition("c", "part").sortWithinPartitions("c", "part", F.col("centre").desc())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, whole = None, np.zeros(0, np.uint64)
        for batch in batches:
            c, part, centre, key = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for chunk in A.chunks(batch.column(4)):
                text, h = shingle_sets(chunk)
                cuts = np.searchsorted(text, np.arange(len(chunk.bounds)))
                for i in range(len(chunk.bounds) - 1):
                    row, own = chunk.first + i, h[cuts[i]:cuts[i + 1]]
                    if centre[row]:
                        of, whole = (c[row], part[row]), own.copy()
                        continue
                    if not len(own) or not len(whole):
                        continue
                    assert of == (c[row], part[row])
                    at = np.minimum(np.searchsorted(whole, own), len(whole) - 1)
                    common = int((whole[at] == own).sum())
                    if DOWN * common >= UP * (len(own) + len(whole) - common):
                        out.append((c[row], key[row]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def map_width(n: int) -> int:
    return min(MOST_MAP, max(LEAST_MAP, 1 << (MAP_BITS * n - 1).bit_length()))


def parity_maps(chunk: A.Chunk) -> list[bytes]:
    """A bitmap of each text of the chunk, in which each shingle of its set turns one bit.

    The maps of two sets differ in no more bits than the sets in shingles, which bounds their intersection without their texts.
    The two halves of a map, one xored with the other, are the map of half the width, so sets of unlike size can be compared.
    """
    text, h = shingle_sets(chunk)
    cuts = np.searchsorted(text, np.arange(len(chunk.bounds)))
    places = A.mixed(h)
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        width = map_width(int(hi - lo))
        turned = np.bincount((places[lo:hi] & np.uint64(width - 1)).astype(np.int64), minlength=width)
        out.append(np.packbits((turned & 1).astype(np.uint8)).tobytes())
    return out


def map_table(known: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, map): the parity map of each set of ``ids``.  ``known``: (id, text) of one text for each set."""

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in A.chunks(batch.column(1)):
                rows = len(chunk.bounds) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0)[chunk.first:chunk.first + rows], pa.array(parity_maps(chunk), pa.binary())], names=["id", "map"])

    return known.join(small(ids), "id").select("id", "text").mapInArrow(maps, "id long, map binary")


def _with_labels(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of lists that still hold more than one component, with their component ``label``."""
    held = lists.join(labels, F.col("a") == F.col("v"), "left").select("token", "a", "n", "pos", F.coalesce("label", "a").alias("label"))
    mixed = held.groupBy("token").agg(F.min("label").alias("_x"), F.max("label").alias("_y")).where("_x <> _y").select("token")
    return stored(held.join(mixed, "token"), "mixed")


def near_pairs(apart: DataFrame, maps: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) of sets that share a list, are in different components and may be similar by size, position and parity map.

    ``nearest``: of each set's pairs only the one whose bound is highest, so that there are no more pairs than sets.  Sets are
    compared where their list is gathered, a bounded slice of it with another, and only what passes becomes a row.
    """
    slices = apart.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    own = F.pmod(F.hash("a"), F.col("slices"))
    met = apart.join(slices, "token").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = (met.join(maps, F.col("a") == F.col("id"))
             .select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "a", "label", "n", "pos", "map")
             .repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "n"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1).astype(np.int64)
            if not len(keys):
                continue
            new = np.flatnonzero(np.append(last is None or (keys[0] != last).any(), (keys[1:] != keys[:-1]).any(axis=1)))
            last = keys[-1]
            # Whole groups go on together once they fill a slice.
            if len(new) and sum(map(len, held)) + int(new[-1]) >= SLICE:
                held.append(batch.slice(0, int(new[-1])))
                yield from _near_in_lists(held, nearest)
                held = [batch.slice(int(new[-1]))]
            else:
                held.append(batch)
        if held:
            yield from _near_in_lists(held, nearest)

    found = dealt.mapInArrow(find, "a long, b long, spare int")
    if nearest:
        found = found.groupBy("a").agg(F.max_by("b", "spare").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near_in_lists(batches: list[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
    """(a, b, spare) for the entries of whole groups, ordered by group and size; ``spare``: what the bound leaves above the need."""

    def found(a: np.ndarray, b: np.ndarray, spare: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(spare.astype(np.int32))], names=["a", "b", "spare"])

    held = pa.Table.from_batches(batches).combine_chunks()
    token, x, y, own, owner, label, size, place = (held.column(i).to_numpy().astype(np.int64) for i in range(8))
    maps = held.column(8).to_pylist()
    width = np.array([8 * len(m) for m in maps], np.int64)
    tables = {}
    for v in np.unique(width).tolist():
        rows = np.flatnonzero(width >= v)
        tables[v] = np.zeros((len(width), v // 64), np.uint64)
        for w in np.unique(width[rows]).tolist():
            these = rows[width[rows] == w]
            whole = np.frombuffer(b"".join(maps[i] for i in these), np.uint64).reshape(len(these), w // v, v // 64)
            tables[v][these] = np.bitwise_xor.reduce(whole, axis=1)
    run = np.cumsum(np.append(False, (token[1:] != token[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    best, partner = np.full(len(run), -1), np.zeros(len(run), np.int64)
    i, step = np.arange(len(run)), 1
    while True:
        i = i[i + step < len(run)]
        # Sizes grow within a group, so a set that is too small for this one is too small for all further ones.
        i = i[(run[i] == run[i + step]) & (needed(size[i], size[i + step]) <= size[i])]
        if not len(i):
            break
        p = i[(label[i] != label[i + step]) & ((x[i] == y[i]) | (own[i] != own[i + step])) & may_match(size[i], size[i + step], place[i], place[i + step])]
        q = p + step
        differ = np.zeros(len(p), np.int64)
        narrow = np.minimum(width[p], width[q])
        for v in np.unique(narrow).tolist():
            these = narrow == v
            differ[these] = np.bitwise_count(tables[v][p[these]] ^ tables[v][q[these]]).sum(axis=1)
        spare = (size[p] + size[q] - differ) // 2 - needed(size[p], size[q])
        ok = spare >= 0
        p, q, spare = p[ok], q[ok], spare[ok]
        if not nearest:
            if len(p):
                yield found(owner[p], owner[q], spare)
        else:
            for e, f in ((p, q), (q, p)):
                better = spare > best[e]
                best[e[better]], partner[e[better]] = spare[better], owner[f[better]]
        step += 1
    if nearest:
        has = best >= 0
        yield found(owner[has], partner[has], best[has])


def similar_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owner, twin, n, id) of every row of ``docs``, and (v, label): the component of each set id that has a link.

    Rows with equal sets are one set.  Long lists first link to their centre.  Their sets that ended in different components are
    compared with the nearest one by parity map, round by round while that links many, and then with every one that the map does
    not rule out: no similar pair is left in two components.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("owner"), F.xxhash64(text).alias("twin"), text.alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(30, max(4, int(total // RANGE_BYTES).bit_length()))
    frequent = frequent_shingles(texts, bits)
    every = stored(set_table(texts, bits, frequent), "sets")
    counts = {r[0]: r[1] for r in every.where((F.col("n") > 0) & (F.col("n") <= 2 * MOST_SMALL)).groupBy("n").count().collect()}
    small_up_to = boundary(counts)
    found = stored(candidates(every.where("n > 0"), small_up_to, bits, frequent), "candidates")
    ends = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    firsts = every.where("n > 0").groupBy("id").agg(F.min(F.struct("owner", "twin")).alias("_f"))
    wanted = stored(firsts.join(ends, "id").select("id", F.col("_f.owner").alias("_o"), F.col("_f.twin").alias("_t")), "wanted")
    twins = texts.join(small(wanted), (F.col("owner") == F.col("_o")) & (F.col("twin") == F.col("_t"))).select("id", "text")
    # Repeated rows bring a text twice: the same set, so any one will do.
    known = stored(twins.groupBy("id").agg(F.first("text").alias("text")), "texts")
    labels = components(verified(stored(found.where("token = 0").select("a", "b").distinct(), "pairs"), known))
    lists = found.where("token <> 0")
    if not lists.isEmpty():
        labels = _joined_lists(lists, labels, known)
    return every.select("owner", "twin", "n", "id"), labels


def _joined_lists(lists: DataFrame, labels: DataFrame, known: DataFrame) -> DataFrame:
    """``labels`` with all links between sets of one list: none that is similar is left in another component."""
    apart = _with_labels(lists, labels)
    if apart.isEmpty():
        return labels
    ids = stored(apart.select(F.col("a").alias("id")).distinct(), "ids")
    maps = stored(map_table(known, ids), "maps")
    enough, nearest, compared = ids.count() / NEAREST_SHARE, True, None
    while True:
        pairs = near_pairs(apart, maps, nearest)
        if not nearest:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = stored(pairs, "near")
        if pairs.isEmpty():
            return labels
        links = stored(verified(pairs, known), "links")
        linked = links.count()
        if linked:
            labels = extended(labels, links)
        if not nearest:
            return labels
        nearest, compared = linked >= enough, compared.unionByName(pairs) if compared else pairs
        if linked:
            apart = _with_labels(apart.drop("label"), labels)
            if apart.isEmpty():
                return labels


def groups(docs: DataFrame) -> DataFrame:
    """Per row: owner, twin, n_shingles, first (the smallest owner reachable by links, its own included), label of its component.

    Null and blank texts have no shingles, link with nothing and have no label; a null doc_id counts as the smallest; rows that share a doc_id
    count by their texts; other columns are ignored.  An empty table gives an empty result.
    """
    every, labels = similar_sets(docs)
    labelled = every.join(labels, F.col("id") == F.col("v"), "left").withColumn("label", F.coalesce("label", "id"))
    firsts = stored(labelled.where("n > 0").groupBy("label").agg(F.min("owner").alias("first")), "firsts")
    return (labelled.join(firsts.withColumnRenamed("label", "_l"), F.col("label") == F.col("_l"), "left")
            .select("owner", "twin", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("owner")).alias("first"),
                    F.when(F.col("n") > 0, F.col("label")).alias("label")))


def near_duplicate_table(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (null where the smallest doc_id is null); see ``groups``."""
    found = groups(docs)
    return found.select(*[F.when(F.col(c) != NO_ID, F.col(c)).alias(name) for c, name in (("owner", "doc_id"), )], "n_shingles",
                        F.when(F.col("first") != NO_ID, F.col("first")).alias("component_id"))


@own_names
def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Of a component's rows with that doc_id the least text by hash stays, and of rows that repeat each other any one.  Rows that
    share a doc_id, or have none, are not repeats for that: unlike texts are components of their own.  Texts without shingles are
    repeats only under one doc_id that is not null.
    """
    text = F.coalesce("text", F.lit(""))
    owner, twin = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64(text)
    alone = F.col("label").isNull()
    repeats = F.when(alone & (F.col("owner") == NO_ID), F.lit(1).cast("long")).otherwise(F.count(F.lit(1))).alias("_rows")
    of_owner = groups(docs).where("owner = first").groupBy("label", "owner", "twin").agg(repeats)
    marks = stored(of_owner.groupBy("label", F.when(alone, F.col("owner")), F.when(alone, F.col("twin")))
                   .agg(F.min(F.struct("owner", "twin", "_rows")).alias("_m"))
                   .select(F.col("_m.owner").alias("_o"), F.col("_m.twin").alias("_t"), F.col("_m._rows").alias("_rows")), "kept")
    kept = docs.join(marks, (owner == F.col("_o")) & (twin == F.col("_t")))
    if marks.where("_rows > 1").isEmpty():
        return kept.select(*docs.columns)
    again = kept.where("_rows > 1").dropDuplicates(["_o", "_t"])
    return kept.where("_rows = 1").unionByName(again).select(*docs.columns)
