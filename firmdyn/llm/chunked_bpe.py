"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text longer than ``chunk_chars`` is cut into chunks that overlap by ``overlap_chars``. Tasks
pre-tokenise the chunks independently; where a boundary of the left chunk is also a boundary of
the right one, the two runs have resynchronised (the pattern never looks behind, so from a
shared boundary on both agree), and the document is stitched there. Each chunk then encodes the
pieces between its own and the next chunk's stitch, again in parallel. Shorter texts are one
chunk and never leave their task. A document with a pair of chunks that never resynchronise
(one piece longer than the overlap) is encoded in one go.

Decoding concatenates the raw bytes of the ids.

Defined cases: null text counts as empty and gives no ids; repeated rows each get a row; columns
other than the id and the text are not read; no rows give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.session import stash

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Python's \s holds four control characters that are no Unicode white space.
PATTERN = public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
#: Characters after a match within which the pattern's choice is settled (a contraction has 3).
SETTLED = 4
#: Pieces that a worker remembers, and the longest of them.
CACHE_PIECES, CACHE_CHARS = 1 << 16, 64
#: Ids in one Arrow batch of results.
BATCH_IDS = 1 << 18
#: Rows whose ids are decoded at a time.
DECODED_ROWS = 256


def load_ranks(path: str) -> bytes:
    """The vocabulary file as is: lines of base64 piece and rank, about a megabyte."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


class Encoder(dict):
    """Piece -> ids; remembers the pieces it has encoded, up to CACHE_PIECES."""

    def __init__(self, raw: bytes):
        super().__init__()
        self.pieces = regex.compile(PATTERN)
        # one match per call: the pieces are found by the operator, not by the library
        self.bpe = tiktoken.Encoding("pieces", pat_str=r"(?s:.+)",
                                     mergeable_ranks=parse_ranks(raw), special_tokens={})

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.bpe.encode_ordinary(piece))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, pieces)))


def _id_lists(lists: list[list[int]]) -> pa.Array:
    flat = np.fromiter(chain.from_iterable(lists), dtype=np.int32)
    ends = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat))


def _encode_batches(raw, piece_lists):
    """Function for mapInArrow: the batch's other columns, and ids of each row's pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(raw.value)  # for this task: a reused worker process keeps nothing of it
        for batch in batches:
            at, lists, n = 0, [], 0
            rows = piece_lists(enc, batch)
            keep = [c for c in batch.schema.names if not c.startswith("_")]
            for i in range(batch.num_rows):
                lists.append(enc.encode(next(rows)))
                n += len(lists[-1])
                if n >= BATCH_IDS or i + 1 == batch.num_rows:
                    part = batch.slice(at, len(lists))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c) for c in keep] + [_id_lists(lists)], [*keep, "ids"])
                    at, lists, n = i + 1, [], 0

    return run


def _whole(enc: Encoder, batch: pa.RecordBatch):
    for text in batch.column("_text"):
        yield enc.pieces.findall(text.as_py() or "")


def _stitched(enc: Encoder, batch: pa.RecordBatch):
    """The pieces from the chunk's own stitch up to the next chunk's."""
    for text, start, sync, end in zip(*(batch.column(c).to_pylist()
                                        for c in ("_text", "_start", "_sync", "_end"))):
        pieces = enc.pieces.findall(text, sync - start)
        if end is not None:
            stops = np.cumsum([len(p) for p in pieces])
            pieces = pieces[:int(np.searchsorted(stops, end - sync, side="right"))]
        yield pieces


def _boundaries(overlap: int, stride: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = regex.compile(PATTERN)
        for batch in batches:
            heads, tails = [], []
            for text, start, last in zip(batch["text"], batch["start"], batch["last"]):
                head = [m.start() + start for m in pieces.finditer(text, 0, min(len(text), overlap + SETTLED))
                        if m.start() < overlap]
                tail = []
                if not last:
                    settled = len(text) - SETTLED
                    tail = [m.end() + start for m in pieces.finditer(text)
                            if stride <= m.end() <= settled]
                heads.append(head)
                tails.append(tail)
            yield batch[["id", "sha", "chunk"]].assign(head=heads, tail=tails)

    return run


def encode_documents(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text", *, chunk_chars: int = 1 << 15,
                     overlap_chars: int = 1 << 10) -> DataFrame:
    """One row per input row: id, ids (array of token ids). ``vocabulary`` is the path of a
    tiktoken rank file (default: the public multilingual one)."""
    if overlap_chars >= chunk_chars:
        raise ValueError("overlap_chars must be below chunk_chars")
    spark = docs.sparkSession
    raw = spark.sparkContext.broadcast(
        load_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("_text"))
    whole_schema = f"id {id_type}, ids array<int>"
    encode_whole = _encode_batches(raw, _whole)

    is_long = F.length("_text") > chunk_chars
    short = rows.where(~is_long).mapInArrow(encode_whole, whole_schema)

    stride = chunk_chars - overlap_chars
    long = rows.where(is_long).withColumn("sha", F.sha2(F.col("_text").cast("binary"), 256))
    last = F.ceil((F.length("_text") - overlap_chars) / stride).cast("int") - 1
    chunks = stash(
        long.select("id", "sha", "_text", last.alias("_last"))
            .select("id", "sha", "_text", "_last",
                    F.explode(F.sequence(F.lit(0), "_last")).alias("chunk"))
            .select("id", "sha", "chunk", (F.col("chunk") * stride).alias("start"),
                    (F.col("chunk") == F.col("_last")).alias("last"),
                    F.substring("_text", F.col("chunk") * stride + 1, F.lit(chunk_chars)).alias("text"))
            .dropDuplicates(["id", "sha", "chunk"]))
    bounds = chunks.mapInPandas(
        _boundaries(overlap_chars, stride),
        f"id {id_type}, sha string, chunk int, head array<int>, tail array<int>")
    in_order = Window.partitionBy("id", "sha").orderBy("chunk")
    document = Window.partitionBy("id", "sha")
    sync = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(
        F.array_min(F.array_intersect("head", F.lag("tail").over(in_order))))
    stitches = stash(
        bounds.withColumn("_sync", sync)
              .withColumn("_end", F.lead("_sync").over(in_order))
              .withColumn("_broken", F.max(F.col("_sync").isNull()).over(document))
              .select("id", "sha", "chunk", "_sync", "_end", "_broken"))
    null_safe = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["sha"] == b["sha"])
    good = stitches.where(~F.col("_broken"))
    pieces = (chunks.join(good, null_safe(chunks, good) & (chunks["chunk"] == good["chunk"]))
              .select(chunks["id"], chunks["sha"], chunks["chunk"], chunks["text"].alias("_text"),
                      chunks["start"].alias("_start"), "_sync", "_end"))
    encoded = pieces.mapInArrow(_encode_batches(raw, _stitched),
                                f"id {id_type}, sha string, chunk int, ids array<int>")
    stitched = encoded.groupBy("id", "sha").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))),
                              lambda c: c["ids"])).alias("ids"))
    listed = long.select("id", "sha")
    long_done = listed.join(stitched, null_safe(listed, stitched)).select(listed["id"], "ids")
    broken = stitches.where("_broken").select("id", "sha").distinct()
    unstitched = (long.join(broken, null_safe(long, broken), "left_semi")
                  .select("id", "_text").mapInArrow(encode_whole, whole_schema))
    return (short.unionByName(long_done).unionByName(unstitched)
            .withColumnRenamed("id", id_col))


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with a binary column ``decoded``: the raw bytes of ``ids``, concatenated."""
    spark = encoded.sparkSession
    raw = spark.sparkContext.broadcast(
        load_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = parse_ranks(raw.value)
        piece_of = np.empty(max(ranks.values()) + 1, dtype=object)
        for piece, rank in ranks.items():
            piece_of[rank] = piece
        for batch in (b.slice(i, DECODED_ROWS) for b in batches for i in range(0, b.num_rows, DECODED_ROWS)):
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            pieces = piece_of[lists.values[ends[0]:ends[-1]].to_numpy()]
            ends = ends - ends[0]
            out = [b"".join(pieces[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    schema = encoded.schema.simpleString()[len("struct<"):-1]
    return encoded.mapInArrow(run, f"{schema},decoded:binary")
