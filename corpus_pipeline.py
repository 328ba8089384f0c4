"""The corpus pipeline: documents in, token records out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that ``run`` writes as parquet and rereads as the next stage's docs. All but the last
return the columns of documents.

Defined cases: null and empty texts are judged by the classifier like others, are equal to each
other for the exact stage, have no shingles for the near one, and encode to no ids; rows that
repeat an id with other texts are documents of their own; an empty table gives no rows; further
columns of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmdyn.llm.bloom_dedup import drop_copies
from firmdyn.llm.chunked_bpe import decode_documents, encode_documents
from firmdyn.llm.common import table
from firmdyn.llm.coordinate_minhash import drop_near_duplicates
from firmdyn.llm.cotraining import score_rows
from firmdyn.llm.pfair_mix import mixed_rows
from firmdyn.session import stash

#: Documents with a lower probability of being good go.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained classifier takes for good ones."""
    scored = score_rows(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("quality_score") >= LEAST_QUALITY).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts stays: the one with the smallest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by similar five-word shingles stays."""
    return drop_near_duplicates(docs, width=5, percent=80, matches=36)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the weights of a tempered mixture: every document is used, those of the smaller
    sources again until the largest is through, in the order of the Pfair schedule."""
    return mixed_rows(docs, temperature=0.7)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text as decoded from the ids; one row per use. The ids are
    written first: a task that encodes and decodes keeps two Python workers, which stay with the executor."""
    return decode_documents(stash(encode_documents(docs))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier, the signatures and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
