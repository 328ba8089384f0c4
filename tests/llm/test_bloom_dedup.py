"""Bloom deduplication against a dictionary, with small filters and many slices."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from firmdyn.llm.bloom_dedup import bloom_exact_dedup, drop_copies

SCHEMA = "doc_id long, text string, keep_id long, sha string, kept boolean"


def rows():
    rng = random.Random(3)
    out = [(1, None), (2, ""), (3, " "), (4, "\n\t "), (5, "a b"), (6, "a \n b"), (7, "a b"), (8, "A b")]
    out += [(100 + i, f"text {rng.randrange(60)}") for i in range(150)]
    out += [(1000 + i, "hot   copy" if i % 2 else "hot copy") for i in range(200)]
    out += [(5, "a b"), (5, "other"), (None, "a b"), (None, "nobody"), (None, "nobody"), (300, "x" * 100_000)]
    return [(i, t, -1, "x", None) for i, t in out]


def brute(data):
    groups = defaultdict(list)
    for i, t, *_ in data:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append(i)
    out = []
    for sha, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        done = False
        for i in ids:
            out.append((str(i), str(keep), len(ids), i == keep and not done, sha))
            done |= i == keep
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"bits_per_row": 1 << 10, "slice_bits": 1 << 17}])
def test_against_brute_force(spark, options):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(7)
    out = bloom_exact_dedup(docs, **options).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in out) == brute(data)


def test_false_positives_do_not_matter(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    out = bloom_exact_dedup(docs, bits_per_row=1).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in out) == brute(data)


def test_rows_that_stay(spark):
    data = rows()
    stay = drop_copies(spark.createDataFrame(data, SCHEMA))
    assert stay.columns == ["doc_id", "text", "keep_id", "sha", "kept"]
    want = sorted((i, sha) for i, _, _, kept, sha in brute(data) if kept)
    got = sorted((str(r.doc_id), hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest())
                 for r in stay.collect())
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bloom_exact_dedup(docs).collect() == []
    assert drop_copies(docs).collect() == []
