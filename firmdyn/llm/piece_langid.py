"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word is the sum over all its segmentations into pieces, which the forward algorithm adds up in
one pass over its positions; no piece crosses a space, so a text's probability is the product
over its words, and a word that was scored before is looked up. The probabilities are learned by
expectation maximisation (the same lattice, forward and backward) from a bounded sample of
labelled documents: ``sample_docs`` and ``sample_words`` distinct words, both per language, so a
language's model does not depend on which others there are.

Words of any length are scored whole. Those longer than RUN characters are taken in runs that are
scored side by side: a run is linear in the sums of the few positions before it from which a piece
can reach into it, so it is followed once from each of them, and the runs' matrices are multiplied
in the word's order. A character outside the vocabulary is spelled in the vocabulary's byte pieces.
Only learning, which sees a sample anyway, counts such a word's runs as words.

Defined cases: texts of any length are scored whole, a few million characters at a time; null texts and texts without a letter get ``und`` and score 0, as does every text
when nothing is labelled; equal scores go to the alphabetically first language; repeated rows are
judged alike; columns other than id, text and language are not read, and the language only to
learn; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.llm.common import written

VOCABULARY = "piece_bpe_32k.model"
SPACE_MARK = "▁"
RUN = 4096
#: Sums of a position are rescaled, with those that still count, when one is below this.
RESCALE = 1e-100
#: Characters that are scored at once, and word scores that a task remembers.
BLOCK_CHARS, CACHE_SCORES = 1 << 20, 800_000
#: Characters of a language's words whose lattices are held over the rounds of learning.
HELD_CHARS = 1 << 21
#: Parts of a language's rows by hash, of which the lowest are found side by side.
HASH_PARTS = 64
#: Rounds of expectation maximisation, and the count that smooths every piece.
ROUNDS, SMOOTHING = 3, 0.1
_BASE, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18
#: What a hash can be besides a piece's number: the start of a longer piece, or neither.
PREFIX, NOTHING = -2, -1


def load_pieces(path: str) -> list[str]:
    """The vocabulary's ordinary and byte pieces (bytes as <0xNN>)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i))]


class Pieces:
    """Finds pieces in arrays of code points, by a rolling hash."""

    def __init__(self, pieces: list[str]):
        self.longest = max(len(p) for p in pieces if not _is_byte(p))
        self.n = len(pieces)
        self.bytes = np.full(256, self.n)
        found: dict[int, int] = {}
        for i, p in enumerate(pieces):
            if _is_byte(p):
                self.bytes[int(p[3:5], 16)] = i
                continue
            h = 0
            for c in p:
                h = (h * int(_BASE) + ord(c) + 1) % 2**64
                found.setdefault(h, PREFIX)
            found[h] = i
        keys, ids = np.array(list(found), np.uint64), np.array(list(found.values()))
        # two tables by different bits of the hash; what meets in both goes to a sorted rest
        self.tables, left = [], np.arange(len(keys))
        for part in range(2):
            slot = self._slot(keys[left], part)
            _, first = np.unique(slot, return_index=True)
            held = np.zeros(1 << _SLOT_BITS, np.uint64)
            held_id = np.full(1 << _SLOT_BITS, NOTHING, np.int32)
            held[slot[first]], held_id[slot[first]] = keys[left[first]], ids[left[first]]
            self.tables.append((held, held_id))
            left = np.delete(left, first)
        order = left[np.argsort(keys[left])]
        self.rest = keys[order], ids[order].astype(np.int32)

    @staticmethod
    def _slot(h: np.ndarray, part: int) -> np.ndarray:
        shift = np.uint64(64 - _SLOT_BITS * (part + 1))
        return ((h * _SPREAD) >> shift) & np.uint64((1 << _SLOT_BITS) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(h.shape, NOTHING, np.int32)
        for part, (held, held_id) in enumerate(self.tables):
            slot = self._slot(h, part)
            np.copyto(out, held_id[slot], where=held[slot] == h)
        if len(self.rest[0]):
            at = np.minimum(np.searchsorted(self.rest[0], h), len(self.rest[0]) - 1)
            np.copyto(out, self.rest[1][at], where=self.rest[0][at] == h)
        return out


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")


class Lattice:
    """The piece lattices of some words, longest word first."""

    def __init__(self, pieces: Pieces, words: list[str], mark: str = SPACE_MARK):
        size = np.array([len(mark) + len(w) for w in words])
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.width = int(self.size[0])
        n = len(words)
        chars = np.zeros((self.width, n), np.uint32)  # a row holds a position of every word
        inside = np.zeros(chars.shape, bool)
        row = np.repeat(np.arange(n), self.size)
        position = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        text = "".join([mark + words[i] for i in self.order.tolist()])
        chars[position, row] = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        inside[position, row] = True
        chars, inside = chars.ravel(), inside.ravel()
        #: words that reach position p
        self.alive = np.searchsorted(-self.size, -np.arange(self.width + 1), side="right")
        code = np.where(inside, chars.astype(np.uint64) + np.uint64(1), np.uint64(0))
        at = np.flatnonzero(inside)
        h = np.zeros(len(at), np.uint64)
        columns = np.arange(self.width + 1) * n
        #: per length: the words and pieces, and where each start's begin
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length in range(1, min(pieces.longest, self.width) + 1):
            fits = at + (length - 1) * n < len(code)
            at, h = at[fits], h[fits]
            h = h * _BASE + code[at + (length - 1) * n]
            ids = pieces.find(h)
            piece = ids >= 0
            here = at[piece]
            self.found.append((here % n, ids[piece], np.searchsorted(here, columns)))
            if length == 1:
                known = np.zeros(len(chars), bool)
                known[here] = True
                self.unknown = [(i % n, i // n, pieces.bytes[list(chr(chars[i]).encode("utf-8", "replace"))])
                                for i in np.flatnonzero(~known & inside)]
            longer = ids != NOTHING  # a piece may begin a longer one
            at, h = at[longer], h[longer]

    def pieces_at(self, start: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Words with a piece of that length at that position, and the pieces."""
        words, ids, begin = self.found[length - 1]
        part = slice(begin[start], begin[start + 1])
        return words[part], ids[part]

    def spelled(self, p: np.ndarray) -> dict[int, list[tuple[int, np.ndarray]]]:
        """Per position: (word, probability) of the characters outside the vocabulary."""
        out: dict[int, list[tuple[int, np.ndarray]]] = {}
        for row, col, ids in self.unknown:
            out.setdefault(col, []).append((row, p[ids].prod(axis=0)))
        return out

    def forward(self, p: np.ndarray, keep: bool = False):
        """log P(word), words by languages, for probabilities ``p`` (pieces and a last row of
        zeros, by languages); with ``keep`` also the log sums of every position.

        Sums are held relative to a scale per word and language. No piece reaches over a character
        that is spelled in bytes, so sums before one may overflow: they are never read again."""
        n, langs = len(self.size), p.shape[1]
        sums = {0: np.ones((n, langs))}
        scale = np.zeros((n, langs))
        out = np.zeros((n, langs))
        kept = [np.zeros((n, langs))]
        spelled = self.spelled(p)
        for end in range(1, self.width + 1):
            m = self.alive[end]
            total = np.zeros((m, langs))
            for length in range(1, min(len(self.found), end) + 1):
                rows, ids = self.pieces_at(end - length, length)
                if len(rows):
                    total[rows] += sums[end - length][rows] * p[ids]
            for row, prob in spelled.get(end - 1, ()):
                if row < m:
                    total[row] += sums[end - 1][row] * prob
            sums[end] = total
            done = np.arange(self.alive[end + 1] if end < self.width else 0, m)
            out[done] = np.log(total[done]) + scale[done]
            if keep:
                kept.append(np.log(total) + scale[:m])
            sums.pop(end - len(self.found), None)
            if total.min() < RESCALE:
                scale[:m] += np.log(total)
                with np.errstate(over="ignore"):
                    sums = {k: s[:m] / total for k, s in sums.items()}
        return (out, kept) if keep else out

    def transfer(self, p: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
        """How the sums of a word's last ``before`` positions follow from those of its first ``before``
        (the last of these is where it begins): matrices, words by from by to by languages, and their
        log scales, words by languages. Rescaled as in ``forward``, by the greatest sum of a word."""
        n, langs = len(self.size), p.shape[1]
        sums = {}
        for k in range(before):
            sums[k] = np.zeros((n, before, langs))
            sums[k][:, k] = 1
        scale, out = np.zeros((n, langs)), np.zeros((n, before, before, langs))
        spelled = self.spelled(p)
        for end in range(before, self.width + 1):
            m = self.alive[end]
            total = np.zeros((m, before, langs))
            for length in range(1, min(len(self.found), end) + 1):
                rows, ids = self.pieces_at(end - length, length)
                if len(rows):
                    total[rows] += sums[end - length][rows] * p[ids][:, None]
            for row, prob in spelled.get(end - 1, ()):
                if row < m:
                    total[row] += sums[end - 1][row] * prob
            sums[end] = total
            del sums[end - before]
            top = total.max(axis=1)
            if top.min() < RESCALE:
                scale[:m] += np.log(top)
                with np.errstate(over="ignore", invalid="ignore"):
                    sums = {k: x[:m] / top[:, None] for k, x in sums.items()}
            for k, to in enumerate(range(end - before + 1, end + 1)):
                done = slice(self.alive[end + 1] if end < self.width else 0, m)
                out[done, :, k] = sums[to][done]
        out[~np.isfinite(out)] = 0  # overflown before a spelled character: never read again
        return out, scale

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in the words (of one language), ``weight`` of each."""
        whole, kept = self.forward(p, keep=True)
        n = len(self.size)
        back = np.zeros((n, self.width + 1))  # relative to a scale per word, as in forward
        back[np.arange(n), self.size] = 1
        scale = np.zeros(n)
        counts = np.zeros(len(p))
        spelled = self.spelled(p)
        unknown = {(col, row): ids for row, col, ids in self.unknown}
        for start in range(self.width - 1, -1, -1):
            m = self.alive[start + 1]
            share = weight[:m] * np.exp(kept[start][:m, 0] + scale[:m] - whole[:m, 0])
            for length in range(1, min(len(self.found), self.width - start) + 1):
                rows, ids = self.pieces_at(start, length)
                if len(rows):
                    use = p[ids, 0] * back[rows, start + length]
                    back[rows, start] += use
                    np.add.at(counts, ids, use * share[rows])
            for row, prob in spelled.get(start, ()):
                if row < m:
                    use = prob[0] * back[row, start + 1]
                    back[row, start] += use
                    np.add.at(counts, unknown[start, row], use * share[row])
            top = back[:m, start].copy()
            if top.min() < RESCALE:
                scale[:m] += np.log(top)
                with np.errstate(over="ignore"):
                    back[:m, start:start + len(self.found) + 1] /= top[:, None]
        return counts


def _blocks(words: list[str], chars: int = BLOCK_CHARS) -> Iterator[np.ndarray]:
    """Indexes of the words in blocks of similar length and bounded size."""
    order = np.argsort([len(w) for w in words], kind="stable")
    at = 0
    while at < len(order):
        n = 1
        while at + n < len(order) and (n + 1) * (len(words[order[at + n]]) + 1) <= chars:
            n = min(2 * n, len(order) - at) if (2 * n) * (len(words[order[min(at + 2 * n, len(order) - 1)]]) + 1) <= chars else n + max(1, n // 8)
        yield order[at:at + min(n, len(order) - at)]
        at += n


def learn(pieces: Pieces, words: list[str], n: np.ndarray) -> np.ndarray:
    """A language's piece probabilities (and a zero) from its words and their counts."""
    blocks = [(b, [words[i] for i in b]) for b in _blocks(words, 1 << 17)]
    held = sum(map(len, words)) <= HELD_CHARS
    lattices = [Lattice(pieces, own) for _, own in blocks] if held else None
    p = np.r_[np.full(pieces.n, 1 / pieces.n), 0.0]
    for _ in range(ROUNDS):
        found = np.zeros(pieces.n + 1)
        for k, (b, own) in enumerate(blocks):
            lattice = lattices[k] if held else Lattice(pieces, own)
            found += lattice.expected(p[:, None], n[b][lattice.order])
        p = np.r_[found[:-1] + SMOOTHING, 0.0]
        p /= p.sum()
    return p


def score_long(pieces: Pieces, word: str, p: np.ndarray) -> np.ndarray:
    """log P(word) per language, in runs of RUN characters."""
    before = pieces.longest
    whole = "\0" * (before - 1) + SPACE_MARK + word  # no piece reaches over the filling
    ends = range(0, len(word) + 1, RUN)
    state, scale = np.zeros((before, p.shape[1])), np.zeros(p.shape[1])
    state[-1] = 1
    at_once = max(1, BLOCK_CHARS // RUN)
    for first in range(0, len(ends), at_once):
        runs = [whole[a:a + RUN + before - 1] for a in ends[first:first + at_once]]
        lattice = Lattice(pieces, runs, "")
        steps, scales = lattice.transfer(p, before)
        for row in np.argsort(lattice.order):
            state = np.einsum("fl,ftl->tl", state, steps[row])
            last = state[-1]
            with np.errstate(over="ignore"):
                state = state / last
            state[~np.isfinite(state)] = 0  # as in transfer
            scale += np.log(last) + scales[row]
    return scale


class WordScores:
    """Word -> row of log-probabilities, for the words a task has met lately."""

    def __init__(self, pieces: Pieces, p: np.ndarray):
        self.pieces, self.p = pieces, p
        self.row: dict[str, int] = {}
        self.scores = np.empty((0, p.shape[1]))

    def rows(self, words: list[str]) -> list[int]:
        if len(self.row) * self.p.shape[1] > CACHE_SCORES:
            self.row, self.scores = {}, self.scores[:0]
        fresh = list({w for w in words if w not in self.row})
        if fresh:
            found = np.empty((len(fresh), self.p.shape[1]))
            long = np.array([len(w) > RUN for w in fresh])
            short = np.flatnonzero(~long)
            for b in _blocks([fresh[i] for i in short]):
                lattice = Lattice(self.pieces, [fresh[short[i]] for i in b])
                found[short[b[lattice.order]]] = lattice.forward(self.p)
            for i in np.flatnonzero(long):
                found[i] = score_long(self.pieces, fresh[i], self.p)
            self.row.update(zip(fresh, range(len(self.row), len(self.row) + len(fresh))))
            self.scores = np.concatenate([self.scores, found])
        return list(map(self.row.__getitem__, words))


def learned_words(text: str) -> list[str]:
    """The words that are counted to learn: long ones in runs."""
    words = text.split()
    if len(text) > RUN and max(map(len, words), default=0) > RUN:
        words = [w[i:i + RUN] for w in words for i in range(0, len(w), RUN)]
    return words


def _identify(pieces, langs: list[str], p):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = WordScores(pieces.value, p.value)
        for batch in batches:
            for part in _by_size(batch):
                lists = [(t or "").split() if langs else [] for t in part["text"]]
                rows = scores.rows([w for x in lists for w in x]) if langs else []
                found = scores.scores[rows]
                ends = np.r_[0, np.cumsum([len(x) for x in lists])]
                pred, best = [], []
                for text, a, b in zip(part["text"], ends[:-1], ends[1:]):
                    if not langs or not any(map(str.isalpha, text or "")):
                        pred.append("und")
                        best.append(0.0)
                        continue
                    log = found[a:b].sum(axis=0)
                    odds = np.exp(log - log.max())
                    k = int(np.argmax(odds))
                    pred.append(langs[k])
                    best.append(float(odds[k] / odds.sum()))
                yield pd.DataFrame({"id": part["id"], "lang_pred": pred, "score": best})

    return run


def _by_size(batch: pd.DataFrame, chars: int = 4 << 20) -> Iterator[pd.DataFrame]:
    total = np.cumsum([len(t or "") for t in batch["text"]])
    for _, part in batch.groupby(total // chars, sort=True):
        yield part


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in _by_size(batch):
            found: dict[tuple[str, str], int] = {}
            for lang, text, copies in zip(part["lang"], part["text"], part["copies"]):
                for w in learned_words(text or ""):
                    found[lang, w] = found.get((lang, w), 0) + copies
            yield pd.DataFrame([(a, w, n) for (a, w), n in found.items()], columns=["lang", "word", "n"])


def _most_frequent(words: list[str], n: np.ndarray, limit: int) -> tuple[list[str], np.ndarray]:
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))[:limit]
    return [words[i] for i in order], n[order]


def _post_words(limit: int):
    """Function of a task that holds all counts of its words: per language one row of the most
    frequent ones (a language's most frequent words are among those of the tasks)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[list[str], np.ndarray]] = {}
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                words, n = held.get(lang, ([], np.empty(0, np.int64)))
                words, n = words + own["word"].tolist(), np.r_[n, own["n"].to_numpy(np.int64)]
                held[lang] = _most_frequent(words, n, limit) if len(words) > 2 * limit else (words, n)
        for lang, (words, n) in held.items():
            words, n = _most_frequent(words, n, limit)
            yield pd.DataFrame({"lang": [lang], "words": [words], "n": [n]})

    return run


def _learn(pieces, limit: int):
    """Function of one language's posted words: its probabilities."""

    def run(key: tuple, posted: pd.DataFrame) -> pd.DataFrame:
        words = [w for x in posted["words"] for w in x]
        words, n = _most_frequent(words, np.concatenate(list(posted["n"])), limit)
        return pd.DataFrame({"lang": [key[0]], "p": [learn(pieces.value, words, n.astype(float)).tobytes()]})

    return run


def draw(docs: DataFrame, n: int) -> DataFrame:
    """(lang, text, copies): per language the ``n`` rows of (id, lang, text) whose hashes are lowest.

    Only hashes are ranked, in HASH_PARTS parts of a language and then in the whole, after a limit in
    the map tasks; the texts are fetched by hash, equal rows as one."""
    hashed = docs.withColumn("hash", F.xxhash64("id", "text"))
    keys = hashed.select("lang", "hash", F.pmod("hash", F.lit(HASH_PARTS)).alias("part"))
    for group in (["lang", "part"], ["lang"]):
        lowest = F.row_number().over(Window.partitionBy(*group).orderBy("hash"))
        keys = keys.withColumn("nth", lowest).where(F.col("nth") <= n).drop("nth")
    drawn = written(keys.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("copies")))
    return (hashed.join(drawn, ["lang", "hash"]).groupBy("lang", "hash", "copies").agg(F.min("text").alias("text"))
            .select("lang", "text", "copies"))


def identify_languages(docs: DataFrame, may_learn: Column, vocabulary: str | None = None,
                       id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
                       sample_docs: int = 500, sample_words: int = 200_000) -> DataFrame:
    """One row per input row: id, lang_pred, score. Learns from rows where ``may_learn`` holds
    and the language is known: of each language the ``sample_docs`` rows that hash lowest,
    and of their words the language's ``sample_words`` most frequent (the model sees no other
    bound)."""
    sc = docs.sparkSession.sparkContext
    pieces = sc.broadcast(Pieces(load_pieces(vocabulary or public_tokenizers.path(VOCABULARY))))
    labelled = (docs.where(may_learn & F.col(lang_col).isNotNull())
                .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    sample = draw(labelled, sample_docs)
    counts = (sample.mapInPandas(_count_words, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    posted = counts.mapInPandas(_post_words(sample_words), "lang string, words array<string>, n array<long>")
    learned = posted.groupBy("lang").applyInPandas(
        _learn(pieces, sample_words), "lang string, p binary").collect()  # a row per language
    langs = sorted(r["lang"] for r in learned)
    found = {r["lang"]: np.frombuffer(r["p"]) for r in learned}
    p = np.stack([found[x] for x in langs], axis=1) if langs else np.zeros((pieces.value.n + 1, 0))
    id_type = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInPandas(_identify(pieces, langs, sc.broadcast(p)),
                         f"id {id_type}, lang_pred string, score double")
            .withColumnRenamed("id", id_col))
