"""Co-training: held-out accuracy on the given labels, what the views see, and edges."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firmdyn.llm.common import fold
from firmdyn.llm.cotraining import (META_SIZE, SCORED_ROWS, TEXT_SIZE, Model, Rows, View, WordFeatures, _extract, _score,
                                    co_train, feature_rows, fit, fit_small, meta_features, quality_scores, score_rows, taught_documents, text_features)
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality_score double, label string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    held = fold("doc_id", 3) == 0
    out = quality_scores(docs, labels.where(~held)).join(labels.where(held), "doc_id").toPandas()
    right = (out.quality_score >= 0.5) == (out.quality == 1)
    assert len(out) > 50 and right.mean() > 0.97
    assert right[out.quality == 1].mean() > 0.98  # clean documents stay


def test_pseudo_labels_teach_the_other_view():
    rng = np.random.default_rng(3)
    n, known = 2400, 160  # too few to know the bad sources
    good = rng.random(n) < 0.5
    cache = WordFeatures()
    text = [text_features(" ".join(rng.choice(["fine", "good", "calm"] if g else ["spam", "junk", "buy"], 20)), cache)
            for g in good]
    meta = [meta_features("clean.org" if g else f"bad{rng.integers(300)}.com", "en", 100) for g in good]
    pool = set(range(known, n))

    def draw(views):
        out, used = [], set()
        for k, (view, rows) in enumerate(zip(views, (text, meta))):
            for i in sorted(pool):
                p = 1 / (1 + np.exp(-view.odds(Rows([rows[i]]))[0]))
                if p >= 0.9 or p <= 0.1:
                    out.append((1 - k, (meta, text)[k][i], int(p >= 0.9)))
                    used.add(i)
        pool.difference_update(used)
        return out

    model = co_train(text[:known], meta[:known], good[:known].astype(int), draw, rounds=3)
    untaught = fit(Rows(meta[:known]), good[:known].astype(float), META_SIZE)
    all_text, rest = Rows(text), np.arange(known, n)

    def rows(which):
        return Rows([meta[i] for i in which])

    taught = ((rows(rest).scores(model.meta) * model.calibrate[1][0] + model.calibrate[1][1]) > 0) == good[rest]
    assert isinstance(model, Model) and taught.mean() > 0.99
    bad = rest[~good[rest]]
    unseen = bad[rows(bad).scores(untaught) == rows(bad).scores(untaught).max()]
    gain = rows(unseen).scores(untaught) - rows(unseen).scores(model.meta)
    assert len(unseen) > 100 and (gain > 1).mean() > 0.9  # sources that no label showed it
    both = model.probability(all_text.scores(model.text), Rows(meta).scores(model.meta))
    assert ((both > 0.5) == good).mean() > 0.99


def test_a_round_against_brute_force(spark):
    """What the views hand over: from all unlabelled documents, one of each print, evenly over sources."""
    rng = np.random.default_rng(5)
    words = ["fine", "good", "calm", "spam", "junk", "buy"]
    docs = [(i if i % 50 else None, " ".join(rng.choice(words, 6)), "en", "big" if i % 10 else f"rare{i % 3}", 10.0 * (i % 7))
            for i in range(900)]
    docs += [(2000 + i, "spam junk", "en", None, 1.0) for i in range(300)]  # copies, source unknown
    known = spark.createDataFrame([(i, 1) for i in range(1, 200)], "id long, label int")
    features = feature_rows(spark.createDataFrame(
        docs, "id long, text string, lang string, source string, n_chars double").coalesce(1)).cache()
    cache = WordFeatures()
    of = {r.uid: r for r in features.collect()}
    rows = {r.uid: (text_features(docs[r.uid][1], cache), meta_features(docs[r.uid][3], "en", docs[r.uid][4])) for r in of.values()}
    assert [of[i].id for i in range(len(docs))] == [d[0] for d in docs]
    views = [View(rng.normal(0, 9, TEXT_SIZE + 1), 1.0, 0.0), View(rng.normal(0, 3, META_SIZE + 1), 1.0, 0.0)]
    used = np.array(sorted({of[i].print for i in range(300, 320)}))
    got = taught_documents(features, known, views, used, 20, 0.8).collect()
    want = set()
    for k in (0, 1):
        for label in (0, 1):
            by_source = {}
            for uid, r in of.items():
                p = 1 / (1 + np.exp(-views[k].odds(Rows([rows[uid][k]]))[0]))
                if (p >= 0.8 if label else p <= 1 - 0.8) and r.print not in used and (r.id is None or not 1 <= r.id < 200):
                    first = by_source.setdefault(r.source, {})
                    first[r.print] = min(uid, first.get(r.print, uid))
            ranked = [(nth, p, uid) for prints in by_source.values() for nth, (p, uid) in enumerate(sorted(prints.items()))]
            want |= {(uid, 1 - k, label) for _, _, uid in sorted(ranked)[:20]}
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 40
    taken = {of[uid].source for uid, *_ in want}
    assert {"big", "rare0", "rare1", "rare2"} <= taken
    features.unpersist()


def test_counts_beyond_a_byte_are_whole(spark):
    text = "many " * 70_000 + "once"
    docs = spark.createDataFrame([(1, text, "en", "s", 1.0)], "id long, text string, lang string, source string, n_chars double")
    r = feature_rows(docs).first()
    n = np.frombuffer(r["count"], f"<u{len(r['count']) * 2 // len(r.found)}")
    assert n.max() >= 70_000 and n.sum() == 2 * 70_001


def test_calibration():
    rng = np.random.default_rng(4)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * z - 1)))).astype(float)
    assert fit_small(z[:, None], y) == pytest.approx([2, -1], abs=0.2)


def test_features_are_in_their_ranges():
    cache = WordFeatures()
    for t in (None, "", "one", "É " * 10, "A!! b*** 12 " * 5000, "漢字"):
        at, value = text_features(t, cache)
        assert at.min() >= 0 and at.max() < TEXT_SIZE and np.isfinite(value).all()
    for m in ((None, None, None), ("s", "l", float("nan")), ("s", "l", -5), ("s", "l", 10**12)):
        assert meta_features(*m)[0].max() < META_SIZE


def test_few_rows_at_a_time():
    names = ["id", "text", "source", "lang", "n_chars"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, (i, f"word{i} " * (i % 9), "a", "en", float(i)))) for i in range(1200)])
    parts = list(_extract(iter([batch])))
    assert max(p.num_rows for p in parts) <= SCORED_ROWS
    single = [next(_extract(iter([batch.slice(i, 1)]))) for i in range(batch.num_rows)]
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches(single).to_pylist()
    given = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([batch.column("text")], ["text"]),
                                        *(batch.column(c) for c in names[2:])], ["row", *names[2:]])
    scored = list(_score(SimpleNamespace(value=0.5), "text")(iter([given])))
    assert [p.num_rows for p in scored] == [SCORED_ROWS, SCORED_ROWS, 1200 - 2 * SCORED_ROWS]


def rows():
    out = [(i, "plain words of a good page " * 5, "en", "a", 100, 0.0, "x") for i in range(40)]
    out += [(100 + i, "JUNK!! " * 30, "en", "b", 50, 0.0, "x") for i in range(40)]
    return out + [(200, None, None, None, None, None, "x"), (201, "", "en", "a", 0, 0.0, "x"), (None, "JUNK!! " * 9, "en", "b", 1, 0.0, "x"),
                  (0, "plain words of a good page " * 5, "en", "a", 100, 0.0, "x"), (2**60 + 1, "JUNK!! " * 40_000, "en", "b", 9, 0.0, "x")]


def test_edges(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(30), *range(100, 130)]] + [(5, 0), (5, 1), (31, None), (999, 1)],
                                   "doc_id long, quality int")
    out = score_rows(docs, labels).collect()
    assert sorted(map(str, (tuple(r.row) for r in out))) == sorted(map(str, rows()))
    of = {r.row.doc_id: r.quality_score for r in out}
    assert min(of[i] for i in range(40)) > 0.5 > max(of[100 + i] for i in range(40)) and of[2**60 + 1] < 0.5
    one = quality_scores(docs, labels.where("quality = 1")).collect()
    none = quality_scores(docs, labels.where("false")).collect()
    assert {r.quality_score for r in one} == {1.0} and {r.quality_score for r in none} == {0.5}
    assert quality_scores(spark.createDataFrame([], SCHEMA), labels).collect() == []
