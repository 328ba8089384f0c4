"""Repeated strings against a dictionary of all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from firmdyn.llm import suffix_dedup
from firmdyn.llm.suffix_dedup import _repeated, remove_repeats, segments, smaller_elsewhere

SCHEMA = "doc_id long, text string, n_bytes int, k string, label string"


def brute(rows, match=50, last=float("inf")):
    least = {}
    for i, t in rows:
        raw, i = (t or "").encode(), last if i is None else i
        for a in range(len(raw) - match + 1):
            w = raw[a:a + match]
            least[w] = min(least.get(w, last), i)
    out = []
    for i, t in rows:
        raw, own = (t or "").encode(), last if i is None else i
        gone = np.zeros(len(raw) + 1, bool)
        for a in range(len(raw) - match + 1):
            if least[raw[a:a + match]] < own:
                gone[a:a + match] = True
        begins = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(raw) else 0
        out.append((str(i), len(raw), int(gone.sum()), begins,
                    hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out)


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def rows(seed=4, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    shared = [prose(rng, 25, words) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(1, 40), words)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared)[rng.randrange(60):], prose(rng, rng.randrange(1, 20), words)]
        out.append((1000 - 7 * i, " ".join(parts)))
    base = out[5][1]
    out += [(2000 + i, base) for i in range(30)]  # copies
    out += [(3000 + i, base[:40 + i] + "#" + base[41 + i:]) for i in range(40)]  # near copies
    out += [(4000, "a" * 300), (4001, "a" * 49), (4002, "a" * 50), (4003, "b" + "a" * 60), (4004, "ab" * 90), (4005, "ba" * 90)]
    out += [(4010, None), (4011, ""), (4012, "é日本😀" * 20), (4013, "x" + "é日本😀" * 12), (4014, "\0" * 70), (4015, "\0" * 60 + "\1")]
    return out


def run(spark, data, **options):
    docs = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in data], SCHEMA).repartition(6)
    return sorted((str(r.doc_id), *tuple(r)[1:]) for r in remove_repeats(docs, **options).collect())


def test_against_all_windows(spark):
    data = rows()
    assert run(spark, data) == brute(data)


def test_without_hot_anchors(spark, monkeypatch):
    data = rows(9, 60)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 10**9)  # the other tests have some, by their near copies
    assert run(spark, data) == brute(data)


def test_repeated_and_null_ids(spark):
    data = rows(11, 40)
    passage = data[0][1]
    data += [(500, passage + " one"), (500, passage + " two"), (500, passage + " two"), (None, passage + " three"),
             (None, passage), (None, "only here " * 3 + passage[:30]), (None, None), (7, passage + " two")]
    assert run(spark, data) == brute(data)


def test_other_ids_and_length(spark):
    data = [(f"{i:04}", t) for i, t in rows(12, 40)]
    docs = spark.createDataFrame(data, "key string, body string").repartition(3)
    out = sorted(tuple(r) for r in remove_repeats(docs, "key", "body", match=23).collect())
    assert out == brute(data, 23, "~")


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    assert run(spark, [(1, None)]) == brute([(1, None)])


def test_equal_windows_share_an_anchor():
    rng = random.Random(8)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(200))) for _ in range(40)] + ["", "a" * 120]
    raw = np.frombuffer("".join(strings).encode(), np.uint8)
    at = np.cumsum([0] + [len(s) for s in strings])
    text, first, count, place, h = segments(raw, at, 50)
    anchor, seen = {}, 0
    for t, a, n, p, key in zip(text, first, count, place, h):
        assert at[t] <= a and a + n + 49 <= at[t + 1]
        for w in range(a, a + n):
            assert w <= p <= w + 30
            assert anchor.setdefault(raw[w:w + 50].tobytes(), (key, p - w)) == (key, p - w)
            seen += 1
    assert seen == sum(max(0, len(s) - 49) for s in strings)


def test_blocks_cover_every_window(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 200)
    texts = [None if i % 7 == 0 else "".join(chr(97 + (j * j + i) % 26) for j in range(37 * i % 900)) for i in range(40)]
    got = defaultdict(list)
    for raw, at, rows_, base in suffix_dedup._blocks(pa.array([t or "" for t in texts]), 50):
        text, first, count, _, _ = segments(raw, at, 50)
        for t, a, n in zip(text, first, count):
            for w in range(a, a + n):
                got[int(rows_[t])].append((int(w - at[t] + base[t]), raw[w:w + 50].tobytes()))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert sorted(got[i]) == [(a, raw[a:a + 50]) for a in range(len(raw) - 49)]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_runs_over_batches(block):
    data = [(1, 5), (1, 5), (2, 1), (2, 2), (2, 1), (3, 9), (4, 4), (4, 4), (4, 4), (4, 6), (4, 4), (5, 1)]
    batches = [pa.RecordBatch.from_pydict({"h": [h for h, _ in data[i:i + block]], "k": [k for _, k in data[i:i + block]]})
               for i in range(0, len(data), block)]
    got = {(r["h"], r["k"]) for b in _repeated(iter(batches)) for r in b.to_pylist()}
    assert got == {(2, 1), (2, 2), (4, 4), (4, 6)}


def test_hot_anchors_in_pieces():
    """Pieces hold every window of their segments, and equal windows get one key."""
    data = [t.encode() for _, t in rows(3, 30) if t]
    key = {}
    for t in data:
        raw = np.frombuffer(t, np.uint8)
        text, first, count, place, _ = segments(raw, np.array([0, len(raw)]), 50)
        windows = []
        for _, a, n, h in zip(*suffix_dedup._pieces(raw, text, first, count, place, 50)):
            assert n <= suffix_dedup.EDGE
            for w in range(a, a + n):
                assert key.setdefault(t[w:w + 50], h) == h
                windows.append(w)
        assert sorted(windows) == list(range(max(0, len(t) - 49)))


def test_digests_do_not_depend_on_the_place():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    row = np.concatenate([rng.integers(0, 1 << 63, 17, dtype=np.uint64), part, part[::-1], part])
    a, b = suffix_dedup._digests(row, np.array([17, 97, 57, 18]), np.array([57, 137, 97, 57]))
    for d in (a, b):
        assert d[0] == d[1] and len(set(d.tolist())) == 3


def test_smaller_elsewhere():
    rng = random.Random(2)
    strings = sorted({bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(5, 40))) for _ in range(200)})
    labels = np.array([rng.randrange(60) for _ in strings])
    least = defaultdict(lambda: 99)
    for s, v in zip(strings, labels):
        for a in range(len(s) - 5):
            least[s[a:a + 6]] = min(least[s[a:a + 6]], v)
    want = {(i, a) for i, (s, v) in enumerate(zip(strings, labels)) for a in range(len(s) - 5) if least[s[a:a + 6]] < v}
    got = [(int(i), int(w)) for i, a, n in zip(*smaller_elsewhere(pa.array(strings, pa.binary()), labels, 6)) for w in range(a, a + n)]
    assert len(got) == len(set(got)) and set(got) == want
