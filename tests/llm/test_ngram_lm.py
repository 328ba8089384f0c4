"""The distributed model against one made with dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmdyn.llm import ngram_lm
from firmdyn.llm.common import fold
from firmdyn.llm.ef_trie import EliasFano, Trie
from firmdyn.llm.ngram_lm import score_documents

SCHEMA = "doc_id long, text string, train string, block long, score string"


def corpus():
    rng = random.Random(8)
    vocab = ["the", "The", "of"] * 8 + [f"w{i}" for i in range(400)] + ["é", "É"]
    out = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    out += [(1000 + i, t) for i, t in enumerate([None, "", " \n", "one", "unseen words here", "the " * 4000])]
    out += [out[5], out[5], (None, "the w1 w2")]
    return [(i, t, "x", 0, "y") for i, t in out]


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]


def brute(rows, is_train):
    words, pairs, after = Counter(), Counter(), defaultdict(set)
    for i, t, *_ in rows:
        if is_train(i):
            found = tokens(t)
            words.update(found)
            for a, b in zip([b""] + found, found):
                pairs[a, b] += 1
                after[a].add(b)
    n, v = sum(words.values()), len(words)
    out = []
    for i, t, *_ in rows:
        found = tokens(t)
        base = [(words[w] + 1) / (n + v + 1) for w in found]
        score = 0.0
        for a, b, p in zip([b""] + found, found, base):
            c = words[a]
            if c:
                p = max(pairs[a, b] - .75, 0) / c + .75 * len(after[a]) / c * p
            score += math.log10(p)
        out.append((str(i), not is_train(i), len(found), sum(words[w] > 0 for w in found), n,
                    sum(map(math.log10, base)), score))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_against_dictionaries(spark, monkeypatch, small):
    if small:  # many blocks and shards
        for name in ("BLOCK_TOKENS", "SHARD_WORDS", "SHARD_PAIRS"):
            monkeypatch.setattr(ngram_lm, name, 500)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    held = {r.doc_id for r in docs.where(fold("doc_id", 7) == 2).collect()}
    out = sorted((str(r.doc_id), not r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in score_documents(docs, fold("doc_id", 7) != 2).collect())
    want = brute(rows, lambda i: i not in held)
    assert [r[:5] for r in out] == [r[:5] for r in want]
    step = ngram_lm.Scale(want[0][4]).step
    for got, exp in zip(out, want):
        assert got[5] == pytest.approx(exp[5], rel=1e-9)
        assert got[6] == pytest.approx(exp[6], abs=1.2 * abs(step) * got[2])  # codes are rounded


def test_edges(spark):
    rows = corpus()[:20]
    out = score_documents(spark.createDataFrame(rows, SCHEMA), fold("doc_id", 7) < 0).collect()
    assert {(r.train_tokens, r.n_known, r.score) for r in out} == {(0, 0, 0.0)}
    assert score_documents(spark.createDataFrame([], SCHEMA), fold("doc_id", 7) != 2).collect() == []


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 2**40), (900, 900), (3000, 10**6), (3000, 2**45), (2000, 50)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n).astype(np.uint64))
    ef = EliasFano.of(values)
    assert (ef.get(np.arange(n)) == values).all()
    asked = np.r_[values, rng.integers(0, top, 500).astype(np.uint64), np.uint64(2 * top)].astype(np.uint64)
    found = ef.find(asked)
    assert ((found >= 0) == np.isin(asked, values)).all()
    assert (values[found[found >= 0]] == asked[found >= 0]).all()


def test_trie():
    rng = np.random.default_rng(1)
    sizes = rng.zipf(1.7, 400).clip(1, 900)
    after = np.concatenate([np.sort(rng.choice(5000, s, replace=False)) for s in sizes])
    first = np.sort(rng.choice(10**6, 400, replace=False))
    codes = rng.integers(0, 256, len(after)).astype(np.uint8)
    trie = Trie(first, sizes, after, codes[:400], codes)
    at, found = trie.find(first, sizes, after)
    assert (at == np.arange(400)).all() and (found == np.arange(len(after))).all()
    assert (trie.probabilities[found] == codes).all()
    held = set(zip(np.repeat(first, sizes).tolist(), after.tolist()))
    _, found = trie.find(first, sizes, after + 1)
    assert [f >= 0 for f in found] == [x in held for x in zip(np.repeat(first, sizes).tolist(), (after + 1).tolist())]
    assert (trie.find(first + 10**6, sizes, after)[1] == -1).all()


def test_split_contexts_change_no_score(spark, monkeypatch):
    for name in ("BLOCK_TOKENS", "SHARD_WORDS", "SHARD_PAIRS"):
        monkeypatch.setattr(ngram_lm, name, 500)
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    whole, split = (sorted((str(r.doc_id), r.n_tokens, r.base_score, r.score) for r in score_documents(
        docs, fold("doc_id", 7) != 2, split_tokens=n).collect()) for n in (1 << 40, 20))
    assert [r[:2] for r in split] == [r[:2] for r in whole]
    for a, b in zip(split, whole):
        assert a[2:] == pytest.approx(b[2:], rel=1e-12)
