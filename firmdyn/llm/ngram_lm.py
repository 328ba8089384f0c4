"""Language-model scoring with an Elias-Fano n-gram trie (words and pairs of words).

The corpus is numbered once: tasks write blocks of about ``BLOCK_TOKENS`` tokens as numbers into
the block's own vocabulary. Two exchanges follow, each of one compressed row per block and shard:

1. the blocks' words go to vocabulary shards, which add up the training counts over all blocks,
   number the words globally and answer every block;
2. the blocks' distinct word pairs go to trie shards, with the training counts, the context's
   total and the quantised probability of the second word. A shard adds up the counts, smooths
   them (absolute discounting, interpolated with the word's own probability), builds its part of
   the trie, and answers every block by looking its pairs up there.

Each block then sums the answers over its documents. All counts cover all training documents;
nothing is pruned. A context with at least SPLIT_TOKENS training tokens is spread over shards by
its second words. Those shards post their numbers of distinct ones, which are added up per context,
and answer with counts; the blocks smooth these by the sum, so the split changes no score.

The probability of a text is that of its words and its end; the first word follows an end.

Defined cases: null text counts as empty (an end alone); repeated rows are scored alike and count
as often as they occur; without training documents every probability is 1; columns other than id,
text and the training flag are not read; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmdyn.llm.ef_trie import Trie
from firmdyn.session import stash, stash_observed

BLOCK_TOKENS = 1 << 21
#: Vocabulary entries and word pairs of one shard, about.
SHARD_WORDS, SHARD_PAIRS = 1 << 19, 1 << 20
SPLIT_TOKENS = 1 << 20
DISCOUNT = 0.75
#: Codes of a probability: 0 is 1, the others fall evenly to the least one.
CODES = 255
END = b""


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 as one compressed byte string: each in the smallest type
    that holds it, all first bytes, then all second ones, and so on."""
    arrays = [a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays]
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], "<i8")
    planes = [np.ascontiguousarray(a[:, None].view(np.uint8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *planes]))


def unpack(raw: bytes) -> list[np.ndarray]:
    """The arrays that were packed, as 64-bit integers."""
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 1 + 2 * n)[1:]
    out, at = [], 8 * (1 + 2 * n)
    for kind, size in zip(head[::2], head[1::2].tolist()):
        dtype = np.dtype(chr(kind))
        planes = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel().astype(np.int64))
        at += planes.size
    return out


def _pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))  # no word holds a line end


def _unpack_words(raw: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(raw).split(b"\n")


def _shard_of_words(words: list[bytes], shards: int) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (h % np.uint64(shards)).astype(np.int64)


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks: ids and training flags of documents, token counts, tokens, vocabulary, counts."""
    part, nth = TaskContext.get().partitionId(), 0
    number: dict[bytes, int] = {END: 0}
    ids, flags, tokens, size = [], [], [], 0

    def block() -> pd.DataFrame:
        sizes = np.array([len(t) for t in tokens], np.int64)
        flat = np.concatenate(tokens).astype(np.uint32)
        counts = np.bincount(flat[np.repeat(flags, sizes)], minlength=len(number))
        return pd.DataFrame({
            "block": [(part << 24) + nth], "ids": [ids], "n_tokens": [len(flat)], "n_words": [len(number)],
            "tokens": [pack(np.array(flags, np.int64), sizes, flat)],
            "words": [_pack_words(list(number))], "counts": [pack(counts)]})

    for batch in batches:
        for doc, text, train in zip(batch["id"], batch["text"], batch["train"]):
            found = (text or "").encode("utf-8", "surrogatepass").lower().split()
            tokens.append(np.array([*(number.setdefault(w, len(number)) for w in found), 0], np.uint32))
            ids.append(doc)
            flags.append(bool(train))
            size += len(tokens[-1])
            if size >= BLOCK_TOKENS:
                yield block()
                nth += 1
                number, ids, flags, tokens, size = {END: 0}, [], [], [], 0
    if ids:
        yield block()


def _post_words(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, words, counts in zip(batch["block"], batch["words"], batch["counts"]):
                words, counts = _unpack_words(words), unpack(counts)[0]
                shard = _shard_of_words(words, shards)
                order = np.argsort(shard, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    yield pd.DataFrame({"shard": [shard[at[0]]], "block": [block],
                                        "words": [_pack_words([words[i] for i in at])],
                                        "numbers": [pack(at, counts[at])]})

    return run


def _count_words(shards: int):
    """Function of one vocabulary shard: for each block its words' global numbers and counts, and
    (with a null block) the shard's distinct and all training tokens."""

    def run(key: tuple, posted: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        numbered = [[number.setdefault(w, len(number)) for w in _unpack_words(x)] for x in posted["words"]]
        sent = [unpack(x) for x in posted["numbers"]]
        total = np.zeros(len(number), np.int64)
        for ids, (_, counts) in zip(numbered, sent):
            total[ids] += counts
        rows = [(block, pack(local, np.array(ids, np.int64) * shards + key[0], total[ids]), None, None)
                for block, ids, (local, _) in zip(posted["block"], numbered, sent)]
        rows.append((None, None, int((total > 0).sum()), int(total.sum())))
        out = pd.DataFrame(rows, columns=["block", "numbers", "v", "n"])
        return out.astype({"block": "Int64", "v": "Int64", "n": "Int64"})

    return run


class Block:
    """A block's tokens with the global numbers and counts of its vocabulary."""

    def __init__(self, row: pd.Series, vocabulary: pd.DataFrame):
        self.ids, n = row["ids"], int(row["n_words"])
        self.flags, self.sizes, self.tokens = unpack(row["tokens"])
        self.number, self.count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for raw in vocabulary["numbers"]:
            local, number, count = unpack(raw)
            self.number[local], self.count[local] = number, count

    def pairs(self, shards: int, split: int):
        """Distinct pairs with a known first word, by shard: context, successor (both in the
        block's numbers), shard; and of every token the pair it ends, or -1."""
        before = np.r_[0, self.tokens[:-1]]
        before[np.cumsum(self.sizes) - self.sizes] = 0  # a document begins after an end
        distinct, pair = np.unique((before << 32) | self.tokens, return_inverse=True)
        first, second = distinct >> 32, distinct & 0xFFFFFFFF
        known = self.count[first] > 0
        spread = np.uint64(1) + (self.count[first] // split).astype(np.uint64)
        own = (self.number[first].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        part = (self.number[second].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(20)) % spread
        shard = np.where(known, ((own >> np.uint64(17)) + part) % np.uint64(shards), np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place[shard == shards] = -1
        keep = order[:int(known.sum())]
        train = np.bincount(pair, np.repeat(self.flags, self.sizes), len(distinct)).astype(np.int64)
        return first[keep], second[keep], shard[keep], train[keep], place[pair]


class Scale:
    """Codes of log10 probabilities; ``least`` is below the smallest one."""

    def __init__(self, total: int):
        self.step = -(math.log10(total) + 4) / CODES
        self.total = total

    def code(self, log10: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(log10 / self.step), 0, CODES).astype(np.uint8)

    def word(self, count: np.ndarray) -> np.ndarray:
        """Log10 of a word's own probability."""
        return np.log10((count + 1) / self.total)


def smooth(count: np.ndarray, n: np.ndarray, types: np.ndarray, lower: np.ndarray,
           scale: Scale) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the contexts' back-off weights and of the pairs' probabilities, for the counts of
    the pairs and of their contexts, the contexts' distinct successors, and the codes of the
    successors' own probabilities."""
    backoff = DISCOUNT * types / n
    p = np.maximum(count - DISCOUNT, 0) / n + backoff * 10 ** (lower * scale.step)
    return scale.code(np.log10(backoff)), scale.code(np.log10(np.minimum(p, 1)))


def _post_pairs(shards: int, scale: Scale, split: int):
    def run(block: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, row in block.iterrows():
            b = Block(row, vocabulary)
            first, second, shard, train, _ = b.pairs(shards, split)
            code = scale.code(scale.word(b.count))
            for at in np.split(np.arange(len(first)), np.flatnonzero(np.diff(shard)) + 1):
                if not len(at):
                    continue
                f, s = first[at], second[at]
                starts = np.r_[0, np.flatnonzero(np.diff(f)) + 1]
                rows.append((int(shard[at[0]]), int(row["block"]), pack(
                    b.number[f[starts]], np.diff(np.r_[starts, len(at)]), b.count[f[starts]],
                    b.number[s], train[at], code[s])))
        return pd.DataFrame(rows, columns=["shard", "block", "pairs"])

    return run


def build_trie(context: np.ndarray, total: np.ndarray, successor: np.ndarray, train: np.ndarray,
               lower: np.ndarray, scale: Scale) -> tuple[Trie, np.ndarray, tuple[np.ndarray, ...]]:
    """The trie of the pairs (possibly repeated; their ``train`` counts are added up) that occur
    in training, the pairs' counts, and of every context its number, count and distinct
    successors. ``total`` is the context's count, ``lower`` the successor's probability code."""
    order = np.lexsort((successor, context))
    c, s = context[order], successor[order]
    starts = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (s[1:] != s[:-1])]) if len(c) else np.empty(0, np.int64)
    count = np.add.reduceat(train[order].astype(np.int64), starts) if len(c) else np.empty(0, np.int64)
    starts, count = starts[count > 0], count[count > 0]
    c, s, n, low = c[starts], s[starts], total[order][starts], lower[order][starts]
    begin = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[begin, len(c)])
    backoffs, probabilities = smooth(count, n, np.repeat(sizes, sizes), low, scale)
    return Trie(c[begin], sizes, s, backoffs[begin], probabilities), count, (c[begin], n[begin], sizes)


def _answer(scale: Scale, split: int):
    """Function of one trie shard: builds its trie and answers every block's pairs, with codes or,
    in contexts that are split, with counts; a row without a block has the split contexts and
    their distinct successors here."""

    def run(key: tuple, posted: pd.DataFrame) -> pd.DataFrame:
        sent = [unpack(x) for x in posted["pairs"]]
        context, total = (np.concatenate([np.repeat(x[i], x[1]) for x in sent]) for i in (0, 2))
        trie, count, (contexts, n, types) = build_trie(context, total, *(np.concatenate([x[i] for x in sent]) for i in (3, 4, 5)), scale)
        del context, total
        hot = n >= split
        out = [(None, key[0], pack(contexts[hot], types[hot]))] if hot.any() else []
        for block, (first, sizes, total, second, _, lower) in zip(posted["block"], sent):
            at, found = trie.find(first, sizes, second)
            backoff = np.where(at >= 0, trie.backoffs[np.maximum(at, 0)], 0).astype(np.int64)
            code = np.minimum(np.repeat(backoff, sizes) + lower, CODES)
            some = found >= 0
            code[some] = trie.probabilities[found[some]]
            hot = np.repeat(total >= split, sizes)
            counts = np.zeros(int(hot.sum()), np.int64)
            counts[some[hot]] = count[found[hot & some]]
            code[hot] = 0
            out.append((block, key[0], pack(code, counts)))
        return pd.DataFrame(out, columns=["block", "shard", "codes"]).astype({"block": "Int64"})

    return run


def split_types(posted: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Split contexts and their distinct successors, added up over their shards."""
    sent = [unpack(x) for x in posted]
    contexts, types = (np.concatenate([np.empty(0, np.int64), *(x[i] for x in sent)]) for i in (0, 1))
    contexts, at = np.unique(contexts, return_inverse=True)
    return contexts, np.bincount(at, types, len(contexts)).astype(np.int64)


def _score(shards: int, scale: Scale, split: int, contexts: np.ndarray, types: np.ndarray):
    def run(block: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = []
        answers = given[given["codes"].notna()].sort_values("shard")
        for _, row in block.iterrows():
            b = Block(row, given[given["numbers"].notna()])
            first, second, _, _, place = b.pairs(shards, split)
            sent = [unpack(x) for x in answers["codes"]]
            code, count = (np.concatenate([np.empty(0, np.int64), *(x[i] for x in sent)]) for i in (0, 1))
            hot = np.flatnonzero(b.count[first] >= split)
            if len(hot):
                own, lower = first[hot], scale.code(scale.word(b.count))[second[hot]]
                distinct = types[np.searchsorted(contexts, b.number[own])]
                backoff, probability = smooth(count, b.count[own], distinct, lower, scale)
                code[hot] = np.where(count > 0, probability, np.minimum(backoff.astype(np.int64) + lower, CODES))
            word = scale.word(b.count)[b.tokens]
            model = word.copy()
            asked = place >= 0
            model[asked] = code[place[asked]] * scale.step
            starts = np.cumsum(b.sizes) - b.sizes
            out.append(pd.DataFrame({
                "id": b.ids, "train": b.flags.astype(bool), "n_tokens": b.sizes,
                "n_known": np.add.reduceat((b.count > 0)[b.tokens].astype(np.int64), starts),
                "base_score": np.add.reduceat(word, starts), "score": np.add.reduceat(model, starts)}))
        return pd.concat(out)

    return run


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id",
                    text_col: str = "text", *, split_tokens: int = SPLIT_TOKENS) -> DataFrame:
    """One row per input row: id, train, n_tokens, n_known, train_tokens, base_score (the words'
    own add-one probabilities), score (the model's); both are log10 of the text's probability.
    Learns from the rows where ``train`` holds. ``split_tokens`` decides which contexts are spread
    over shards, not the result."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks, seen = stash_observed(
        docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), train.alias("train"))
            .mapInPandas(_number, "block long, ids array<string>, n_tokens long, n_words long, "
                                  "tokens binary, words binary, counts binary"),
        tokens=F.sum("n_tokens"), words=F.sum("n_words"))
    word_shards = 1 + (seen["words"] or 0) // SHARD_WORDS
    pair_shards = 1 + (seen["tokens"] or 0) // SHARD_PAIRS

    posted = blocks.select("block", "words", "counts").mapInPandas(
        _post_words(word_shards), "shard long, block long, words binary, numbers binary")
    vocabulary = stash(posted.groupBy("shard").applyInPandas(
        _count_words(word_shards), "block long, numbers binary, v long, n long"))
    size = vocabulary.where("block is null").agg(F.sum("v"), F.sum("n")).first()  # two numbers
    distinct, tokens = size[0] or 0, size[1] or 0
    scale = Scale(tokens + distinct + 1)

    numbers = vocabulary.where("block is not null").select("block", "numbers")
    body = blocks.select("block", "ids", "n_words", "tokens")
    asked = (body.groupBy("block").cogroup(numbers.groupBy("block"))
             .applyInPandas(_post_pairs(pair_shards, scale, split_tokens), "shard long, block long, pairs binary"))
    answers = stash(asked.groupBy("shard").applyInPandas(
        _answer(scale, split_tokens), "block long, shard long, codes binary"))
    # a row per shard with split contexts, of which there are at most all tokens / split_tokens
    contexts, types = split_types([r["codes"] for r in answers.where("block is null").select("codes").collect()])
    given = numbers.select("block", F.lit(None).cast("long").alias("shard"), "numbers",
                           F.lit(None).cast("binary").alias("codes")).unionByName(
        answers.where("block is not null").select("block", "shard", F.lit(None).cast("binary").alias("numbers"), "codes"))
    scored = (body.groupBy("block").cogroup(given.groupBy("block"))
              .applyInPandas(_score(pair_shards, scale, split_tokens, contexts, types), "id string, train boolean, n_tokens long, "
                                                         "n_known long, base_score double, score double"))
    return scored.select(F.col("id").cast(id_type).alias(id_col), "train", "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
