"""The pipeline's stages: decisions, columns, awkward rows, and the run as a whole."""

import tiktoken
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firmdyn.llm.chunked_bpe import VOCABULARY, load_ranks, parse_ranks
from tests.conftest import SF0001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_over_the_given_tables(spark):
    docs = first = spark.read.parquet(f"{SF0001}/documents.parquet").cache()
    counts, ids = [], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stash(stage(spark, docs, SF0001))
        assert docs.columns == COLUMNS and docs.schema == first.schema
        counts.append(docs.count())
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert docs.join(first, COLUMNS, "left_semi").count() == counts[-1]  # rows are unchanged
    assert counts[0] < first.count() and counts[1] < counts[0] and counts[2] < counts[1]
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & ids[0]) > 0.97 * len(good & {r.doc_id for r in first.collect()})
    assert ids[3] == ids[2] and counts[3] >= counts[2]  # the mix loses nothing
    out = corpus_pipeline.run(spark, SF0001).collect()
    library = tiktoken.Encoding("all", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=parse_ranks(load_ranks(public_tokenizers.path(VOCABULARY))))
    of = {r.doc_id: r.text for r in first.collect()}
    assert len(out) == counts[3] and {r.doc_id for r in out} == ids[3]
    assert all(r.text == of[r.doc_id] and r.ids == library.encode_ordinary(r.text) for r in out)


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_documents(spark, empty):
    schema = "doc_id long, text string, lang string, source string, n_chars long, quality_score int, row string, id int, position int"
    rows = [] if empty else [(i, t, None if i % 2 else "en", None if i % 3 else "a", None, 0, "x", 0, 0) for i, t in enumerate(
        [None, "", "", " ", "one", "one", "ONE", "words of a text that is long enough to be near another of its kind " * 9,
         "words of a text that is long enough to be near another of its kind " * 9 + "!", "é" * 100_000])] + [
        (None, "null id", "en", "a", 1, 0, "x", 0, 0), (4, "one", None, "a", 1, 0, "x", 0, 0), (4, "else", None, "a", 1, 0, "x", 0, 0)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stash(stage(spark, docs, SF0001))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.names == spark.createDataFrame([], schema).schema.names
    assert docs.columns[0] == "doc_id" and (docs.count() == 0 or not empty)


def test_dedup_stages_on_awkward_documents(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "a  b"), (5, "x " * 50), (6, "x " * 50 + "y"), (None, "a\tb")]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    exact = corpus_pipeline.exact_dedup(spark, docs, SF0001)
    assert sorted(r.doc_id for r in exact.collect()) == [1, 3, 5, 6]
    words = " ".join(f"w{i}" for i in range(100))
    near = spark.createDataFrame([(1, words), (2, words + " z"), (3, None), (None, words), (4, "other " + words[200:])],
                                 "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, near, SF0001).collect()
    assert {r.doc_id for r in kept} == {1, 3, None, 4}
    assert corpus_pipeline.mix(spark, docs.limit(0), SF0001).select(F.count("*")).first()[0] == 0


def test_a_task_holds_one_python_worker(spark):
    """Workers stay with the executor after the task, so one more is memory that every later stage lacks."""
    docs = corpus_pipeline.stash(spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}", 6) for i in range(400)],
                                                       "doc_id long, text string, lang string, source string, n_chars long"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    tokens = corpus_pipeline.tokens(spark, docs, SF0001)
    assert plan(tokens).count("MapInArrow") == 1
    assert {(r.doc_id, r.text) for r in tokens.collect()} == {(i, f"text {i}") for i in range(400)}
    mixed = corpus_pipeline.mix(spark, docs, SF0001)
    assert "RDD" not in plan(mixed) and mixed.distinct().count() == 400
