"""The forward sums against an enumeration, and held-out accuracy on the given documents."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from firmdyn.llm.common import fold
from firmdyn.llm import piece_langid
from firmdyn.llm.piece_langid import (SPACE_MARK, VOCABULARY, Lattice, Pieces, WordScores, draw, identify_languages,
                                      load_pieces, score_long)
from firmdyn.llm.queries import op7_piece_langid
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, score string, id int"


@pytest.fixture(scope="module")
def pieces():
    return load_pieces(public_tokenizers.path(VOCABULARY))


def every_segmentation(word, prob):
    """The probabilities of all segmentations, by recursion."""
    if not word:
        return 1.0
    total = sum(prob[word[:n]] * every_segmentation(word[n:], prob)
                for n in range(1, len(word) + 1) if word[:n] in prob)
    if word[0] not in prob:
        spelled = math.prod(prob[f"<0x{b:02X}>"] for b in word[0].encode())
        total += spelled * every_segmentation(word[1:], prob)
    return total


def test_sums_over_all_segmentations(pieces):
    rng = np.random.default_rng(4)
    p = rng.random((len(pieces) + 1, 2)) ** 4
    p[-1] = 0
    words = ["the", "a", "thations", "über", "漢字x", "\U0001F9FF", "", "é" * 3, "international", "zzq"]
    lattice = Lattice(Pieces(pieces), words)
    got = lattice.forward(p)
    for row, i in enumerate(lattice.order):
        for k in range(2):
            prob = dict(zip(pieces, p[:, k]))
            assert got[row, k] == pytest.approx(math.log(every_segmentation(SPACE_MARK + words[i], prob)), rel=1e-9)


def test_expected_counts(pieces):
    rng = np.random.default_rng(5)
    p = np.r_[rng.random(len(pieces)) * 1e-2, 0.0]
    words, weight = ["thations", "inner"], np.array([2.0, 3.0])
    lattice = Lattice(Pieces(pieces), words)
    got = lattice.expected(p[:, None], weight[lattice.order])
    step, value = 1e-6, sum(w * lattice.forward(p[:, None])[r, 0] for r, w in enumerate(weight[lattice.order]))
    for i in np.flatnonzero(got)[::5]:
        q = p.copy()
        q[i] *= 1 + step
        more = sum(w * lattice.forward(q[:, None])[r, 0] for r, w in enumerate(weight[lattice.order]))
        assert (more - value) / step == pytest.approx(got[i], rel=1e-2, abs=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = op7_piece_langid(spark, SF001).join(docs, "doc_id")
    right = out.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert out.count() == docs.count() and right > 0.95


def test_edges(spark):
    rows = [(1, "der die das und nicht", "de", "x", 0), (2, "the and of that with", "en", "x", 0),
            (3, None, "en", "x", 0), (4, "", None, "x", 0), (5, "123 !!!", "en", "x", 0),
            (6, "the and of " + "that" * 5000, None, "x", 0), (None, "nicht und die", None, "x", 0),
            (1, "der die das und nicht", "de", "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = sorted((str(r.doc_id), r.lang_pred, 0 <= r.score <= 1)
                 for r in identify_languages(docs, fold("doc_id", 3) >= 0).collect())
    assert out == [("1", "de", True), ("1", "de", True), ("2", "en", True), ("3", "und", True), ("4", "und", True),
                   ("5", "und", True), ("6", "en", True), ("None", "de", True)]
    unlabelled = identify_languages(docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert identify_languages(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def log_sum(word, prob):
    """The log of the sum over all segmentations, added up in log space."""
    logs, longest = [0.0], max(map(len, prob))
    for end in range(1, len(word) + 1):
        terms = [logs[end - n] + math.log(prob[word[end - n:end]])
                 for n in range(1, min(longest, end) + 1) if word[end - n:end] in prob]
        if word[end - 1] not in prob:
            terms.append(logs[end - 1] + sum(math.log(prob[f"<0x{b:02X}>"]) for b in word[end - 1].encode()))
        top = max(terms)
        logs.append(top + math.log(sum(math.exp(t - top) for t in terms)))
    return logs[-1]


def test_long_runs(pieces):
    assert {f"<0x{b:02X}>" for b in range(256)} <= set(pieces)
    p = np.full((len(pieces) + 1, 1), 1e-7)
    p[::3] = 1e-4
    p[-1] = 0
    words = ["\U0001F9FF" * 50, "the" + "\U0001F9FF" * 50 + "the", "a\0b", "qzx7" * 1000, "the"]
    lattice = Lattice(Pieces(pieces), words)
    got = lattice.forward(p)[:, 0]
    prob = dict(zip(pieces, p[:, 0]))
    assert got == pytest.approx([log_sum(SPACE_MARK + words[i], prob) for i in lattice.order], rel=1e-9)
    # every segmentation spells the word: its pieces' expected lengths add up to the word's
    for word in ("qzx7" * 1000, "internationalisation" * 200):
        uses = Lattice(Pieces(pieces), [word]).expected(p, np.ones(1))
        assert sum(len(x) * u for x, u in zip(pieces, uses)) == pytest.approx(len(word) + 1, rel=1e-6)


def test_labelled_long_words(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(4000))
    rows = [(1, "der die das und nicht " + long, "de", "x", 0), (2, "the and of that with", "en", "x", 0),
            (3, "the and that", None, "x", 0), (4, "und nicht die", None, "x", 0),
            (5, "the and " + "\U0001F9FF" * 50 + " of that with", None, "x", 0)]
    out = {r.doc_id: r for r in identify_languages(spark.createDataFrame(rows, SCHEMA), F.lit(True)).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["de", "en", "en", "de", "en"]
    assert all(0 <= r.score <= 1 for r in out.values())


def test_expected_bytes(pieces):
    p = np.r_[np.full(len(pieces), 1e-3), 0.0]
    uses = Lattice(Pieces(pieces), ["a\U0001F9FF\U0001F9FFb"]).expected(p[:, None], np.array([3.0]))
    for b, n in Counter("\U0001F9FF\U0001F9FF".encode()).items():
        assert uses[pieces.index(f"<0x{b:02X}>")] == pytest.approx(3.0 * n)


def test_every_language_keeps_its_words(spark):
    """The bound on words holds per language; a script outside the vocabulary is learned by its bytes."""
    common = " ".join(f"aa{i} aa{i}" for i in range(40))
    rows = [(i, common, lang, "x", 0) for i, lang in enumerate(["aa", "bb", "cc"])]
    rows += [(10, "zulu words here", "zz", "x", 0), (11, "\U0001F9FF\U0001F9FE \U0001F9FF", "zy", "x", 0)]
    rows += [(20, "here zulu", None, "x", 0), (21, "a \U0001F9FE\U0001F9FF", None, "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = {r.doc_id: r.lang_pred for r in identify_languages(docs, F.lit(True), sample_words=40).collect()}
    assert out[20] == "zz" and out[10] == "zz" and out[21] == "zy"


def test_words_in_runs_equal_whole_words(pieces, monkeypatch):
    rng = np.random.default_rng(8)
    p = rng.random((len(pieces) + 1, 3)) ** 6
    p[-1] = 0
    p /= p.sum(axis=0)
    table = Pieces(pieces)
    words = ["internationalisation" * 400, "".join(rng.choice(list("abcdeth\U0001F9FF漢\0"), 9000)), "a" * 8192, "e" * 4097,
             "\U0001F9FF" * 8193]
    for word in words:
        whole = Lattice(table, [word]).forward(p)[0]
        assert score_long(table, word, p) == pytest.approx(whole, rel=1e-12)
    for run in (20, 33, 64):  # many runs, in several blocks, and a last run of any length
        monkeypatch.setattr(piece_langid, "RUN", run)
        monkeypatch.setattr(piece_langid, "BLOCK_CHARS", 5 * run)
        for n in (run + 1, 2 * run - 1, 2 * run, 2 * run + 1, 700):
            word = words[1][:n]
            prob = dict(zip(pieces, p[:, 2]))
            assert score_long(table, word, p)[2] == pytest.approx(log_sum(SPACE_MARK + word, prob), rel=1e-10)
    monkeypatch.undo()
    scores = WordScores(table, p)
    rows = scores.rows(["the", words[0], "and", "the"])
    assert scores.scores[rows[1]] == pytest.approx(Lattice(table, [words[0]]).forward(p)[0], rel=1e-12)
    assert scores.scores[rows[0]] == pytest.approx(Lattice(table, ["the"]).forward(p)[0]) and rows[0] == rows[3]


def test_draw(spark):
    """The lowest hashes of each language, rows without an id or with the id of others among them."""
    rows = [(i if i % 3 else None, "ab"[i % 2], f"text {i % 700}") for i in range(2000)] + [(7, "c", None)] * 5
    docs = spark.createDataFrame(rows, "id long, lang string, text string").repartition(5)
    found = [(r.lang, r.hash, r.text) for r in docs.withColumn("hash", F.xxhash64("id", "text")).collect()]
    for lang, want in (("a", 50), ("b", 50), ("c", 5)):
        lowest = Counter((h, t) for _, h, t in sorted((x for x in found if x[0] == lang), key=lambda x: x[1])[:want])
        got = Counter()
        for r in draw(docs, 50).where(F.col("lang") == lang).collect():
            got[r.text] += r.copies
        expected = Counter()
        for (_, t), n in lowest.items():
            expected[t] += n
        assert got == expected
