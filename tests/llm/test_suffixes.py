from __future__ import annotations

import random

import numpy as np
import pytest

from tidemart.llm.suffixes import Suffixes, packed, previous_factors


def in_common(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y, strict=True)) if a != b), len(x))


@pytest.mark.parametrize("seed", range(60))
def test_order_common_and_factors_match_brute_force(seed):
    rng = random.Random(seed)
    depth = rng.choice([1, 3, 8, 9, 16, 20, 25, 50])
    width = rng.choice([1, min(8, depth)])
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(80))) for _ in range(rng.randrange(1, 6))]
    strings += [strings[0][3:] + strings[-1], b"a" * rng.randrange(90)]
    text, bounds = b"".join(strings), np.cumsum([0, *map(len, strings)])
    leaves = sorted((text[p:p + depth], p) for x, y in zip(bounds, bounds[1:], strict=False) for p in range(x, y - depth + 1))
    got = Suffixes(packed(np.frombuffer(text, np.uint8), width), bounds, depth, width)
    assert got.order.tolist() == [p for _, p in leaves]
    assert got.common.tolist() == [in_common(leaves[i][0], leaves[i - 1][0]) if i else 0 for i in range(len(leaves))]
    factor, source = previous_factors(got)
    for (x, p), n, q in zip(leaves, factor.tolist(), source.tolist(), strict=True):
        assert n == max((in_common(x, y) for y, r in leaves if r < p), default=0)
        assert n == 0 or (0 <= q < p and text[q:q + n] == x[:n])


def test_nothing():
    empty = Suffixes(np.zeros(0, np.uint64), np.array([0]), 5)
    assert len(empty.order) == 0 and [len(x) for x in previous_factors(empty)] == [0, 0]
