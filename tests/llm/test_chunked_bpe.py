"""Chunked encoding against the tokenizer library, and the decoding round trip."""

import random

import public_tokenizers
import pytest
import tiktoken

from firmdyn.llm.chunked_bpe import (DECODED_ROWS, VOCABULARY, decode_documents, encode_documents, load_ranks,
                                     parse_ranks)

SCHEMA = "doc_id long, text string, ids string, id long, sha string"


@pytest.fixture(scope="module")
def library():
    ranks = parse_ranks(load_ranks(public_tokenizers.path(VOCABULARY)))
    return tiktoken.Encoding("all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def texts():
    rng = random.Random(5)
    parts = ["the ", "don't", "we'll", "'", "  ", "\n\n ", " \t", "é", "naïve ", "12345", "!!! ", "#$%",
             "\x1c", "\x85", " ", "漢字", "🙂🙂 ", "á ", "x" * 40, " " * 40, "<|endoftext|>"]
    out = [None, "", " ", "a", "'ll", "x" * 3000, " " * 500, "word " * 200, "\n" * 300 + "z"]
    out += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 200))) for _ in range(120)]
    return out


def test_matches_library_and_round_trips(spark, library):
    rows = [(i, t, "clash", -i, "x") for i, t in enumerate(texts())]
    rows += [rows[20], rows[20], (None, "null id " * 40, "c", 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = decode_documents(encode_documents(docs, chunk_chars=48, overlap_chars=16)).collect()
    want = sorted((str(r[0]), library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in out) == want


def test_rows_of_several_parts_of_a_batch(spark):
    rows = [(i, f"row {i} é " * (i % 7)) for i in range(2 * DECODED_ROWS + 90)] + [(-1, None)]
    encoded = encode_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    out = {r.doc_id: bytes(r.decoded).decode() for r in decode_documents(encoded.coalesce(1)).collect()}
    assert out == {i: t or "" for i, t in rows}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert decode_documents(encode_documents(docs)).collect() == []
    with pytest.raises(ValueError):
        encode_documents(docs, chunk_chars=8, overlap_chars=8)
