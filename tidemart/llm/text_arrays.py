"""Texts as numpy arrays: bytes and words of an Arrow column, window hashes, winnowed anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are taken in chunks of about this many bytes (a longer text is a chunk of its own), so arrays stay small.
CHUNK_BYTES = 1 << 19
U = np.uint64

_random = np.random.Generator(np.random.PCG64(20240607))
# Two families of hashes: a value for each byte, and an odd base.
BYTE_VALUES = _random.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
BASES = _random.integers(0, 1 << 64, 2, dtype=np.uint64) | U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def power(base: np.uint64, n: int) -> np.uint64:
    return U(pow(int(base), n, 1 << 64))


class Chunk:
    """Consecutive texts of one batch: ``data`` (bytes), ``bounds`` (where each text starts, and the end), ``first`` row."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray) -> None:
        self.first, self.data, self.bounds = first, data, bounds


def chunks(column: pa.Array) -> Iterator[Chunk]:
    """Null texts are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield Chunk(row, whole[at[row]:at[end]], at[row:end + 1] - at[row])
        row = end


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and ``bounds`` in words."""
    inside = ~IS_SPACE[chunk.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    edges = chunk.bounds[:-1]
    edges = edges[edges < len(inside)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, chunk.bounds)


_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power_table(family: int, inverse: bool, n: int) -> np.ndarray:
    """Powers of a base, or of its inverse, up to ``n``; kept for chunks of the usual size."""
    held = _powers.get((family, inverse))
    if held is None or len(held) < n:
        base = int(BASES[family])
        base = pow(base, -1, 1 << 64) if inverse else base
        size = max(n, CHUNK_BYTES + 4096)
        held = np.ones(size, U)
        held[1:] = U(base)
        held = np.cumprod(held)
        if size <= 4 * CHUNK_BYTES:
            _powers[family, inverse] = held
    return held


def word_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, family: int, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z lower-cased if asked."""
    values = BYTE_VALUES[family]
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    n = len(chunk.data)
    sums = np.zeros(n + 1, U)
    np.cumsum(values[chunk.data] * _power_table(family, False, n + 1)[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power_table(family, True, n + 1)[starts])


def window_hashes(values: np.ndarray, n: int, family: int) -> np.ndarray:
    """Hash of each run of ``n`` values, built from runs of doubling length; shorter than ``values`` by ``n - 1``."""
    total = len(values) - n + 1
    if total <= 0:
        return np.zeros(0, U)
    base = BASES[family]
    out, out_n, run, run_n, left = None, 0, values, 1, n
    while left:
        if left & 1:
            if out is None:
                out, out_n = run, run_n
            else:
                size = len(run) - out_n
                out = out[:size] * power(base, run_n) + run[out_n:out_n + size]
                out_n += run_n
        left >>= 1
        if left:
            run = run[:-run_n] * power(base, run_n) + run[run_n:]
            run_n *= 2
    return mixed(out[:total])


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (n - size)], values[n - size:]) if n > size else values


def anchors(values: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The windows of ``window`` values inside each text, grouped by anchor: (text, first window, number of windows, anchor hash, twice).

    The anchor of a window is its ``gram`` values with the least hash, the first of equal ones.  Equal windows have equal anchors,
    so windows with an anchor that occurs once are unique.  Every window is in exactly one group.  ``twice``: neighbouring windows
    whose anchors are equal but stand in different places are one group, as in texts that repeat a short period.
    """
    texts = np.repeat(np.arange(len(bounds) - 1), np.maximum(np.diff(bounds) - window + 1, 0))
    if not len(texts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U), np.zeros(0, bool)
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    firsts = np.cumsum(counts) - counts
    starts = np.arange(len(texts)) - firsts[texts] + bounds[texts]
    grams = window_hashes(values, gram, 0)
    bits = U(max(1, int(len(grams)).bit_length()))
    keys = ((grams >> bits) << bits) | np.arange(len(grams), dtype=U)
    least = sliding_min(keys, window - gram + 1)[starts]
    places = (least & ((U(1) << bits) - U(1))).astype(np.int64)
    hashes = grams[places]
    new = np.ones(len(starts), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(starts)))
    return texts[at], starts[at] - bounds[texts[at]], sizes, hashes[at], places[at] != places[np.append(at[1:], len(starts)) - 1]


def runs_of(sorted_keys: list[np.ndarray]) -> np.ndarray:
    """Number of the run of equal keys that each entry is in."""
    new = np.ones(len(sorted_keys[0]), bool)
    same = np.ones(max(len(new) - 1, 0), bool)
    for key in sorted_keys:
        same &= key[1:] == key[:-1]
    new[1:] = ~same
    return np.cumsum(new) - 1
