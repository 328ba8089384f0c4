"""Quality rules as a short-circuit cascade.

A rule rejects a document by a test on a few measures of its text. Measures differ in cost (a
count of bytes against a search for repeated eight-word windows) and rules in how much they
reject, so both are estimated on a sample first; the rules then run in the order of documents
rejected per second, and a rule's measures are taken only of the documents that are still alive.
The order changes the work, never the verdict: a document is kept if no rule rejects it.

Defined cases: null text has no words, lines or symbols and fails ``few_words``; repeated rows
are judged alike; columns other than the id and the text are not read; no rows give no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmdyn.llm.common import fold

#: Bytes of text that are measured at once.
BLOCK_BYTES = 4 << 20
WINDOW = 8


def _byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE = _byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
_SYMBOL = _byte_class(b"#*$%&|<>")
_UPPER = _byte_class(bytes(range(65, 91)))
_LOWER = _byte_class(bytes(range(97, 123)))
_ALPHA = _UPPER | _LOWER | _byte_class(bytes(range(128, 256)))
_LEAD = ~_byte_class(bytes(range(128, 192)))


class Texts:
    """A block of texts as one byte buffer, with the measures that rules ask for."""

    def __init__(self, texts: pa.Array):
        self.texts = texts = texts.cast(pa.large_string())
        self.ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        self.raw = raw[self.ends[0]:self.ends[-1]]
        self.ends = self.ends - self.ends[0]
        self._words = self._ids = None

    def __len__(self) -> int:
        return len(self.texts)

    def take(self, rows: np.ndarray) -> Texts:
        return self if len(rows) == len(self) else Texts(self.texts.take(pa.array(rows)))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return total[self.ends[1:]] - total[self.ends[:-1]]

    @property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word, in the order of the buffer."""
        if self._words is None:
            inside = np.r_[False, ~_SPACE[self.raw], False]
            starts = inside[1:-1] & ~inside[:-2]
            stops = inside[1:-1] & ~inside[2:]
            # a text's end also ends a word
            first, last = self.ends[:-1], self.ends[1:] - 1
            filled = last >= first
            starts[first[filled]] = inside[1:-1][first[filled]]
            stops[last[filled]] = inside[1:-1][last[filled]]
            self._words = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        return self._words

    @property
    def word_ids(self) -> np.ndarray:
        """A number for every word; equal words of the block have equal ones."""
        if self._ids is None:
            raw, (starts, stops) = self.raw.tobytes(), self.words
            number: dict[bytes, int] = {}
            self._ids = np.fromiter((number.setdefault(raw[a:b], len(number))
                                     for a, b in zip(starts.tolist(), stops.tolist())), np.int64, len(starts))
        return self._ids

    def words_with(self, flags: np.ndarray) -> np.ndarray:
        """Which words have a flagged byte."""
        total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        starts, stops = self.words
        return total[stops] > total[starts]

    def count_words(self, which: np.ndarray | None = None) -> np.ndarray:
        starts = self.words[0] if which is None else self.words[0][which]
        return np.diff(np.searchsorted(starts, self.ends))


def n_words(t: Texts) -> np.ndarray:
    return t.count_words()


def word_chars(t: Texts) -> np.ndarray:
    return t.per_text(~_SPACE[t.raw] & _LEAD[t.raw])


def n_symbols(t: Texts) -> np.ndarray:
    return t.per_text(_SYMBOL[t.raw])


def _lines(t: Texts) -> Iterator[list[bytes]]:
    raw = t.raw.tobytes()
    for a, b in zip(t.ends[:-1], t.ends[1:]):
        yield [line for line in raw[a:b].split(b"\n") if line.strip()]


def n_lines(t: Texts) -> np.ndarray:
    return np.array([len(x) for x in _lines(t)], np.int64)


def n_dup_lines(t: Texts) -> np.ndarray:
    return np.array([len(x) - len(set(x)) for x in _lines(t)], np.int64)


def alpha_words(t: Texts) -> np.ndarray:
    return t.count_words(t.words_with(_ALPHA[t.raw]))


def upper_words(t: Texts) -> np.ndarray:
    return t.count_words(t.words_with(_UPPER[t.raw]) & ~t.words_with(_LOWER[t.raw]))


def echo_words(t: Texts) -> np.ndarray:
    """Words that are equal to the word before them in the text."""
    ids = t.word_ids
    text = np.repeat(np.arange(len(t)), t.count_words())
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (text[1:] == text[:-1])
    return t.count_words(same)


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each distinct pair; both sides hold numbers below 2**32."""
    return np.unique((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64),
                     return_inverse=True)[1]


def n_repeat_words(t: Texts) -> np.ndarray:
    """Words that lie in an eight-word window which the text holds twice or more."""
    ids = t.word_ids
    first = np.searchsorted(t.words[0], t.ends)
    text = np.repeat(np.arange(len(t)), np.diff(first))
    n = len(ids) - WINDOW + 1
    if n < 1:
        return np.zeros(len(t), np.int64)
    for step in (1, 2, 4):  # pairs, then fours, then eights
        ids = _ranks(ids[:-step], ids[step:])
    inside = text[:n] == text[WINDOW - 1:]
    at = np.flatnonzero(inside)
    same = _ranks(text[at], ids[at])
    at = at[np.bincount(same)[same] > 1] if len(at) else at
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    covered = np.r_[0, np.cumsum(np.cumsum(change[:-1]) > 0)]
    return covered[first[1:]] - covered[first[:-1]]


MEASURES: dict[str, Callable[[Texts], np.ndarray]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, alpha_words,
                            upper_words, echo_words, n_repeat_words)}


@dataclass(frozen=True)
class Rule:
    """Rejects where ``test`` holds of the named measures."""

    name: str
    needs: tuple[str, ...]
    test: Callable[..., np.ndarray]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 30 * n),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda n, d: (d > 2) & (10 * d > 3 * n)),
    Rule("echoes", ("n_words", "echo_words"), lambda n, e: 10 * e > 3 * n),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 2 * n) | (c > 20 * n)),
    Rule("letters", ("n_words", "alpha_words"), lambda n, a: 10 * a < 7 * n),
    Rule("capitals", ("n_words", "upper_words"), lambda n, u: 2 * u > n),
)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, Texts]]:
    """The batch's ids and texts in blocks of about BLOCK_BYTES."""
    text = batch.column("text").fill_null("")
    size = np.cumsum(pa.compute.binary_length(text).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        n = max(1, int(np.searchsorted(size, done + BLOCK_BYTES, side="right")) - at)
        yield batch.column("id").slice(at, n), Texts(text.slice(at, n))
        at += n


def judge(texts: Texts, rules: tuple[Rule, ...], always: tuple[str, ...]) -> tuple[dict, np.ndarray]:
    """The measures in ``always`` of every text, and which texts pass the rules in order."""
    known = {name: MEASURES[name](texts) for name in always}
    alive = np.ones(len(texts), bool)
    for rule in rules:
        rows = np.flatnonzero(alive)
        if not len(rows):
            break
        missing = [m for m in rule.needs if m not in known]
        if missing:
            left = texts.take(rows)
            for m in missing:
                known[m] = np.zeros(len(texts), np.int64)
                known[m][rows] = MEASURES[m](left)
        alive[rows[rule.test(*(known[m][rows] for m in rule.needs))]] = False
    return {m: known[m] for m in always}, alive


def estimate(docs: DataFrame, rules: tuple[Rule, ...], always: tuple[str, ...], id_col: str,
             text_col: str, sample_rows: int) -> dict[str, tuple[float, float]]:
    """Per rule: seconds and rejected documents, over a sample of about ``sample_rows`` rows
    (chosen by a hash of the id). Measures in ``always`` cost nothing extra."""
    total = docs.count()
    part = docs.where(fold(id_col, max(1, total // sample_rows)) == 0) if total else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected = np.zeros(len(rules)), np.zeros(len(rules))
        for batch in batches:
            for _, texts in _blocks(batch):
                free = {m: MEASURES[m](texts) for m in always}
                for i, rule in enumerate(rules):
                    fresh = Texts(texts.texts)
                    began = time.perf_counter()
                    known = free | {m: MEASURES[m](fresh) for m in rule.needs if m not in free}
                    rejected[i] += rule.test(*(known[m] for m in rule.needs)).sum()
                    cost[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array([r.name for r in rules]), pa.array(cost), pa.array(rejected)],
            ["rule", "seconds", "rejected"])

    rows = (part.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "rule string, seconds double, rejected double")
            .groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")))
    return {r["rule"]: (r["seconds"], r["rejected"]) for r in rows.collect()}  # a row per rule


def in_order(rules: tuple[Rule, ...], found: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Most documents rejected per second first."""
    def gain(rule: Rule) -> float:
        seconds, rejected = found.get(rule.name, (0.0, 0.0))
        return rejected / max(seconds, 1e-9)

    return tuple(sorted(rules, key=gain, reverse=True))


def rule_cascade(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 rules: tuple[Rule, ...] = RULES, always: tuple[str, ...] = (),
                 sample_rows: int = 2000) -> DataFrame:
    """One row per input row: id, the measures named in ``always``, and kept."""
    ordered = in_order(rules, estimate(docs, rules, always, id_col, text_col, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _blocks(batch):
                known, alive = judge(texts, ordered, always)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(known[m], pa.int64()) for m in always), pa.array(alive)],
                    ["id", *always, "kept"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"id {id_type}", *(f"{m} long" for m in always), "kept boolean"])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))
