"""Suffix arrays by induced sorting, in whole-array steps.

Suffixes are of type S (smaller than the next one) or L; a leftmost S suffix follows one of type L.
The substrings from one leftmost S position to the next are sorted by one round of inducing and
named by rank; if names repeat, the suffixes of the string of names are sorted in the same way.
A last round induces all suffixes from the sorted leftmost ones.

Inducing goes bucket by bucket (first symbol): all suffixes that a bucket's known entries bring
about are put into their buckets in one step, so the work is linear and a bucket costs a few
array operations. Where there are nearly as many names as positions, buckets hold next to nothing,
and the string of names is sorted by doubling its ranks instead.
"""

from __future__ import annotations

import numpy as np

#: A level goes bucket by bucket if it has that many positions a symbol at least.
BUCKET_ROWS = 64


def _types(t: np.ndarray) -> np.ndarray:
    """Which suffixes are of type S."""
    n = len(t)
    smaller, differs = np.ones(n, bool), np.zeros(n, bool)
    smaller[:-1] = t[:-1] < t[1:]
    differs[:-1] = t[:-1] != t[1:]
    differs[-1] = True
    ends = np.flatnonzero(differs)  # a run of equal symbols is decided at its end
    return np.repeat(smaller[ends], np.diff(ends, prepend=-1))


def _place(sa: np.ndarray, t: np.ndarray, at: np.ndarray, suffixes: np.ndarray, step: int) -> None:
    """Puts suffixes in their order at the fronts ``at`` of their buckets, which move by ``step``."""
    symbols = t[suffixes]
    order = np.argsort(symbols, kind="stable")
    symbols, suffixes = symbols[order], suffixes[order]
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    counts = np.diff(first, append=len(symbols))
    nth = np.arange(len(symbols)) - np.repeat(first, counts)
    sa[at[symbols] + step * nth] = suffixes
    at[symbols[first]] += step * counts


def _induce(t: np.ndarray, is_s: np.ndarray, bounds: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes, induced from the leftmost S ones in the given order."""
    sa = np.full(len(t), -1, np.int32)
    sizes = np.bincount(t[leftmost], minlength=len(bounds) - 1)
    groups = leftmost[np.argsort(t[leftmost], kind="stable")]
    group_at = np.concatenate(([0], np.cumsum(sizes)))
    heads = bounds[:-1].copy()
    for c in np.flatnonzero(np.diff(bounds)).tolist():
        done = int(bounds[c])
        while done < heads[c]:
            known = sa[done:heads[c]]
            done = int(heads[c])
            before = known[known > 0] - 1
            before = before[~is_s[before]]
            if len(before):
                _place(sa, t, heads, before, 1)
        own = groups[group_at[c]:group_at[c + 1]]
        before = own[own > 0] - 1
        if len(before):
            _place(sa, t, heads, before, 1)
    tails = bounds[1:] - 1
    for c in np.flatnonzero(np.diff(bounds))[::-1].tolist():
        done, low = int(bounds[c + 1]) - 1, int(heads[c])
        while done > tails[c]:
            known = sa[tails[c] + 1:done + 1][::-1]
            done = int(tails[c])
            before = known[known > 0] - 1
            before = before[is_s[before]]
            if len(before):
                _place(sa, t, tails, before, -1)
        if c == t[-1]:  # the end is the smallest suffix, and nothing induces it
            sa[bounds[c]] = len(t) - 1
            low = int(bounds[c]) + 1
            known = sa[bounds[c]:low]
        else:
            known = sa[bounds[c]:low][::-1]
        before = known[known > 0] - 1
        before = before[is_s[before]]
        if len(before):
            _place(sa, t, tails, before, -1)
    return sa


def _names(t: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings at ``ordered`` (sorted), equal ones alike, in the order of the text."""
    length = np.zeros(len(t), np.int32)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    length[leftmost[-1]] = 1
    own = length[ordered]
    pairs = np.flatnonzero(own[1:] == own[:-1])  # only those as long as the one before can be equal to it
    sizes = own[pairs]
    differs = np.ones(len(ordered), bool)
    if len(pairs):
        starts = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum()), dtype=np.int32)
        here = np.repeat(ordered[pairs] - starts.astype(np.int32), sizes) + inside
        there = np.repeat(ordered[pairs + 1] - starts.astype(np.int32), sizes) + inside
        unequal = t[here] != t[there]
        differs[pairs + 1] = np.add.reduceat(unequal, starts) > 0
    name = np.empty(len(t), np.int32)  # by position
    name[ordered] = np.cumsum(differs) - 1
    return name[leftmost]


def _doubled(ranks: np.ndarray) -> np.ndarray:
    """The suffix array of a string of ranks, by ranks of ever longer beginnings."""
    n, width = len(ranks), 1
    order = np.argsort(ranks, kind="stable")
    ranks = ranks.astype(np.int64)
    # a rank is the place of the first suffix that begins alike
    first = np.flatnonzero(np.concatenate(([True], ranks[order][1:] != ranks[order][:-1])))
    ranks[order] = np.repeat(first, np.diff(first, append=n))
    while True:
        sizes = np.bincount(ranks, minlength=n)
        open_at = np.flatnonzero(np.repeat(sizes[first] > 1, np.diff(first, append=n)))
        if not len(open_at):
            return order
        rows = order[open_at]
        later = np.where(rows + width < n, ranks[np.minimum(rows + width, n - 1)], -1)
        key = ranks[rows] * (n + 1) + later + 1
        by = np.argsort(key, kind="stable")
        order[open_at] = rows = rows[by]
        new = np.concatenate(([True], key[by][1:] != key[by][:-1]))
        begin = open_at[np.flatnonzero(new)]
        ranks[rows] = np.repeat(begin, np.diff(np.flatnonzero(new), append=len(rows)))
        first = np.flatnonzero(np.concatenate(([True], ranks[order][1:] != ranks[order][:-1])))
        width *= 2


def suffix_array(t: np.ndarray, n_symbols: int) -> np.ndarray:
    """Suffixes of ``t`` in their order. The last symbol must be smaller than all others."""
    if len(t) < 3:
        return np.arange(len(t), dtype=np.int32)[::-1]
    t = t.astype(np.uint16 if n_symbols <= 1 << 16 else np.int32)  # 16 bits are sorted by radix
    is_s = _types(t)
    leftmost = np.flatnonzero(np.concatenate(([False], is_s[1:] & ~is_s[:-1]))).astype(np.int32)
    bounds = np.concatenate(([0], np.cumsum(np.bincount(t, minlength=n_symbols))))
    is_leftmost = np.zeros(len(t), bool)
    is_leftmost[leftmost] = True
    rough = _induce(t, is_s, bounds, leftmost)
    names = _names(t, leftmost, rough[is_leftmost[rough]])
    n_names = int(names.max()) + 1
    if n_names < len(names):
        deeper = suffix_array if n_names * BUCKET_ROWS <= len(names) else lambda ranks, _: _doubled(ranks)
        order = deeper(names, n_names)
    else:
        order = np.empty(len(names), np.int64)
        order[names] = np.arange(len(names))
    return _induce(t, is_s, bounds, leftmost[order])


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, the first one highest; zeros beyond the end."""
    out = np.zeros(len(raw) + 8, np.uint64)
    out[:len(raw)] = raw
    for width in (1, 2, 4):
        moved = np.zeros_like(out)
        moved[:-width] = out[width:]
        out = (out << np.uint64(8 * width)) | moved
    return out


def permuted_prefixes(raw: np.ndarray, sa: np.ndarray, at: np.ndarray, limit: int) -> np.ndarray:
    """For each position of ``at``, in text order: how many bytes it has in common with the suffix
    before it in the array, up to ``limit``. ``raw`` goes on for ``limit`` bytes from all of them."""
    before = np.full(len(sa), -1, np.int32)
    before[sa[1:]] = sa[:-1]
    words = _words(raw)
    common = np.zeros(len(at), np.int64)
    left = np.flatnonzero(before[at] >= 0)
    here, there = at[left], before[at[left]]
    for done in range(0, limit, 8):
        a, b = words[np.minimum(here + done, len(raw))], words[np.minimum(there + done, len(raw))]
        same = a == b
        off = np.flatnonzero(~same)
        if len(off):  # equal leading bytes of the word
            apart = a[off] ^ b[off]
            common[left[off]] = done + sum((apart >> np.uint64(8 * low) == 0).astype(np.int64) for low in range(1, 8))
        left, here, there = left[same], here[same], there[same]
    common[left] = limit
    return np.minimum(common, limit)
