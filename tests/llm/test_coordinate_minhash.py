"""Near duplicates against all pairs of shingle sets, on texts with planted copies."""

import random
import re

import pytest

from firmdyn.llm.coordinate_minhash import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string, kept string, set_key string, n int"


def brute(rows, width, percent):
    sets = {}
    for i, t, *_ in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        k = min(width, len(words))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return sorted((i, len(sets[i]), find(i), i == find(i)) for i in ids)


def corpus():
    rng = random.Random(11)
    vocab = ["the", "of", "a"] * 6 + [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, i = [], 0

    def add(words):
        nonlocal i
        rows.append((i, " ".join(words), "x", "y", 0))
        i += 1

    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randrange(1, 150))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            add(w)
    big = [rng.choice(vocab) for _ in range(200)]
    for _ in range(120):  # a large group of near copies, some of them apart
        w = list(big)
        for _ in range(rng.choice([1, 2, 3, 8, 12])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
        add(w)
    for _ in range(60):  # one passage that makes up most of many texts
        add(passage + [rng.choice(vocab) for _ in range(rng.randrange(3, 25))])
    for _ in range(50):
        add(["Exact", "copies", "of", "one", "text", "here"])
    for t in (None, "", " \n", "one", "One", "one two", "É é", "é é", "long " * 30_000):
        rows.append((i, t, "x", "y", 0))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent,matches", [(3, 85, 40), (5, 80, 36)])
def test_against_all_pairs(spark, width, percent, matches):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    out = near_duplicates(docs, width=width, percent=percent, matches=matches).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == brute(rows, width, percent)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"),
            (2, "something else"), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_duplicates(docs, width=3).collect())
    assert out == [("1", "1", False), ("1", "1", True), ("2", "1", False), ("2", "2", True),
                   ("3", "3", True), ("None", "None", True), ("None", "None", True)]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert drop_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def variant(text, at):
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


def test_one_id_with_texts_of_two_groups(spark):
    """Sets that share an id are nodes of their own: every dropped text has a near copy that stays."""
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(0, variant(a, 3)), (1, a), (1, b), (3, variant(b, 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (3, 1, False)]
    assert sorted(map(tuple, drop_near_duplicates(docs).collect())) == [(0, variant(a, 3)), (1, b)]


def test_rows_that_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, a), (5, variant(a, 9)), (5, b), (5, None), (5, ""), (6, variant(b, 2)), (4, variant(a, 50)),
            (7, c), (7, c), (None, c), (None, a), (None, None), (8, "few words"), (9, "few words")]
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, row string").repartition(4)
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    want = [(5, b), (5, None), (5, ""), (4, variant(a, 50)), (7, c), (None, c), (None, a), (None, None), (8, "few words")]
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(map(str, want))
