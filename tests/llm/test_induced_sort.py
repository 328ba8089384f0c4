"""Suffix arrays against sorted suffixes."""

import random

import numpy as np
import pytest

from firmdyn.llm import induced_sort
from firmdyn.llm.induced_sort import permuted_prefixes, suffix_array


def texts():
    rng = random.Random(5)
    yield from ([], [1], [1, 1, 1], [2, 1, 2, 1], [1, 2, 3], [3, 2, 1], [1] * 50 + [2] + [1] * 50)
    for k in (2, 3, 5, 40):
        for n in (5, 30, 400):
            yield [rng.randrange(1, k + 1) for _ in range(n)]
    words = [[rng.randrange(1, 27) for _ in range(rng.randrange(1, 9))] for _ in range(12)]
    for _ in range(5):
        yield [c for _ in range(300) for c in rng.choice(words)]
    yield [1, 2] * 300
    yield [2, 1, 1] * 200 + [2, 1] * 100


@pytest.mark.parametrize("share", [1, 64, 1 << 30])
def test_against_sorting(monkeypatch, share):
    monkeypatch.setattr(induced_sort, "BUCKET_ROWS", share)  # recursion all the way, mixed, doubling at once
    for text in texts():
        t = np.array([*text, 0], np.int32)
        whole = [tuple(t[i:].tolist()) for i in range(len(t))]
        assert suffix_array(t, 41).tolist() == sorted(range(len(t)), key=whole.__getitem__)


def test_common_prefixes():
    rng = random.Random(6)
    for limit in (1, 7, 8, 9, 50):
        raw = np.array([rng.choice([0, 97, 255]) for _ in range(30)] * 9 + [3] * 60, np.uint8)
        t = np.append(raw.astype(np.int32) + 1, 0)
        sa = suffix_array(t, 257)
        at = np.arange(len(raw) - limit)
        before = {b: a for a, b in zip(sa.tolist(), sa.tolist()[1:])}

        def common(a, b):
            n = 0
            while n < limit and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            return n

        want = [common(i, before[i]) for i in at.tolist()]
        got = permuted_prefixes(raw, sa, at, limit)
        inside = np.array([before[i] + limit <= len(raw) for i in at.tolist()])
        assert got[inside].tolist() == np.array(want)[inside].tolist()
