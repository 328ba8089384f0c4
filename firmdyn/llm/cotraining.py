"""Quality classification by co-training two views of a document.

One classifier sees only the text (hashed words, word shapes, and measures of repetition and
characters), the other only the page's metadata (source, language, length as recorded). Both start
from the labelled sample. In each round each of them scores every unlabelled document, and of what it
is confident of (by its calibrated probability) ``taught_rows`` documents of each class go, with that
pseudo-label, to the training set of the other. At the end both are calibrated on labelled documents
that neither was trained on, a logistic combination of the two calibrated views is fitted there
too, and all documents are scored with it.

The features of all documents are written once, as small integers; a round reads that table. The
documents that a view hands over are drawn by a hash of their features, evenly over the sources
(the first of every source, then the second, ...), so a rare source takes part however large the
corpus is; copies of a document are one candidate. Only the training sets are bounded:
``labelled_rows`` labelled documents, chosen by a hash of the id, and what is handed over.

Defined cases: null text is an empty one, null metadata a value of its own; several labels of an
id count by their mean (ties are good), null labels do not count; an id with several rows is
labelled by one of them (the one with the smallest hash); documents with a label are never given
another one; rows without an id are unlabelled documents; a document that the views judge
differently goes to each with the other's label; without labels, or with fewer than four of one
class, the score is the good ones' share (0.5 without labels) and nothing else is learned;
repeated rows are scored alike; very long texts count as a whole; other columns are not read; no
rows give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmdyn.session import RunTables, stash

WORDS, SHAPES, BINS = 1 << 12, 1 << 10, 1 << 8
TEXT_SIZE, META_SIZE = WORDS + SHAPES + BINS, 1 << 12
#: Weight of the measures among the text's features (its words' weights add up to 1).
BIN_WEIGHT = 0.25
#: Weight of each of the metadata's features.
META_WEIGHT = 0.5
#: Documents whose features are in memory at a time.
SCORED_ROWS = 512
#: Tasks in which the documents of a source are first cut to those that a round may hand over.
SALTS = 64
CACHE_WORDS = 1 << 17
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>!@^~{}[]\\=+_"


@cache
def _shape_number(*kind) -> int:
    return zlib.crc32(repr(kind).encode()) % SHAPES


def _shape(word: bytes) -> int:
    """A number below SHAPES: capitals, digits, symbols, end and length of a word."""
    if word.isalpha():  # most words
        return _shape_number(word.isupper(), word[:1].isupper(), False, False, b"", min(7, len(word).bit_length()))
    letters, end, size = word.strip(b".,;:!?\"'()"), word[-1:], len(word)
    return _shape_number(letters.isupper(), letters[:1].isupper(), len(word.translate(None, _DIGITS)) < size,
                         len(word.translate(None, _SYMBOLS)) < size, b"" if end.isalnum() else end,
                         min(7, size.bit_length()))


class WordFeatures(dict):
    """Word -> its word feature times SHAPES, plus its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = zlib.crc32(word.lower()) % WORDS * SHAPES + _shape(word)
        return out


def _measures(data: bytes, words: list[bytes], distinct: int) -> list[int]:
    """The bin of each measure of a text; it has ``distinct`` different words."""
    n, size = max(1, len(words)), max(1, len(data))
    share = [sum(map(eq, words, words[1:])) / n, distinct / n,
             (size - len(data.translate(None, _UPPER))) / size, (size - len(data.translate(None, _SYMBOLS))) / size,
             (size - len(data.translate(None, _DIGITS))) / size]
    return [min(15, int(16 * math.sqrt(s))) for s in share] + [min(31, len(words).bit_length()),
                                                              min(31, int(size / n))]


def _all_bins(bins: Sequence[int]) -> list[int]:
    """Features of the measures: all bins up to the measure's, so near values look alike."""
    return [WORDS + SHAPES + 32 * k + j for k, b in enumerate(bins) for j in range(b + 1)]


def text_counts(text: str | None, known: WordFeatures) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Features of the words, how often each occurs, and the number of bins of each measure."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = Counter(words)
    code = np.fromiter(map(known.__getitem__, n), np.int64, len(n))
    times = np.fromiter(n.values(), np.float64, len(n))
    count = np.bincount(np.r_[code // SHAPES, WORDS + code % SHAPES], np.r_[times, times], WORDS + SHAPES)
    found = np.flatnonzero(count)
    return found.astype("<u2"), count[found].astype(np.int64), _measures(data, words, len(n))


def from_counts(found: np.ndarray, count: np.ndarray, bins: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """A feature row: words by their share (a word has two features), and the measures."""
    bins = _all_bins(bins)
    value = np.r_[count * (2 / max(1, count.sum())), np.full(len(bins), BIN_WEIGHT)]
    return np.r_[found, bins].astype(np.int32), value.astype(np.float32)


def text_features(text: str | None, known: WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    return from_counts(*text_counts(text, known))


def meta_features(source, lang, n_chars) -> tuple[np.ndarray, np.ndarray]:
    size = "-" if n_chars is None or n_chars != n_chars else str(int(2 * math.log2(1 + max(0, n_chars))))
    names = (f"s:{source}", f"l:{lang}", f"n:{size}", f"x:{lang}:{size}")
    at = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) % META_SIZE for x in names], np.int32)
    return at, np.full(len(at), META_WEIGHT, np.float32)


#: Features and their values.
Row = tuple[np.ndarray, np.ndarray]


class Rows:
    """Sparse feature rows."""

    def __init__(self, rows: list[Row]):
        self.sizes = np.array([len(a) for a, _ in rows], np.int64)
        self.at = np.concatenate([a for a, _ in rows]) if rows else np.empty(0, np.int32)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.empty(0, np.float32)
        self.row = np.repeat(np.arange(len(rows)), self.sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], len(self)) + w[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: Rows, labels: np.ndarray, size: int, rounds: int = 150, rate: float = 1.0,
        ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression (weights and a last bias) by full-batch adaptive gradients; both
    classes weigh the same."""
    w, seen = np.zeros(size + 1), np.full(size + 1, 1e-8)
    weight = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels <= 0).sum()))
    for _ in range(rounds):
        error = weight * (_sigmoid(rows.scores(w)) - labels)
        step = np.r_[np.bincount(rows.at, rows.value * error[rows.row], size), error.sum()] + ridge * w
        seen += step * step
        w -= rate * step / np.sqrt(seen)
    return w


def fit_small(x: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression of a few columns by Newton's method: calibration and combination."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    # Platt's targets keep a separable sample from infinite weights
    good = labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    for _ in range(50):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - target) + ridge * w)
        w -= step * min(1.0, 5.0 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class View:
    """A view's classifier and its calibration."""

    w: np.ndarray
    slope: float
    bias: float

    def odds(self, rows: Rows) -> np.ndarray:
        return self.slope * rows.scores(self.w) + self.bias


#: The views of a round -> what they hand over: (view that is taught, its feature row, label).
Draw = Callable[[list[View]], list[tuple[int, Row, int]]]


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    #: calibrations (slope, bias) of the views, and the combination of their log odds
    calibrate: tuple[np.ndarray, np.ndarray]
    combine: np.ndarray

    def probability(self, text_score: np.ndarray, meta_score: np.ndarray) -> np.ndarray:
        odds = [c[0] * z + c[1] for c, z in zip(self.calibrate, (text_score, meta_score))]
        return _sigmoid(np.c_[odds[0], odds[1], np.ones(len(text_score))] @ self.combine)


def co_train(text: list[Row], meta: list[Row], labels: np.ndarray, draw: Draw, rounds: int) -> Model | float:
    """Trains on the labelled rows (``labels`` 1 or 0), given in an order without meaning, and on what
    ``draw`` returns for the two views of a round. Returns the good share instead of a model if there
    are not both classes."""
    if len(np.unique(labels)) < 2 or min(np.bincount(labels)) < 4:
        return float(labels.mean()) if len(labels) else 0.5
    # every fourth of each class calibrates
    held = np.concatenate([np.flatnonzero(labels == c)[::4] for c in (0, 1)])
    first = np.setdiff1d(np.arange(len(labels)), held)
    held_rows = [Rows([v[i] for i in held]) for v in (text, meta)]
    own = [[v[i] for i in first] for v in (text, meta)]
    told = [labels[first].astype(float).tolist() for _ in own]

    def trained() -> list[View]:
        views = []
        for k, size in enumerate((TEXT_SIZE, META_SIZE)):
            w = fit(Rows(own[k]), np.array(told[k]), size)
            slope, bias = fit_small(held_rows[k].scores(w)[:, None], labels[held])
            views.append(View(w, slope, bias))
        return views

    for _ in range(rounds):
        taught = draw(trained())
        for k, row, label in taught:
            own[k].append(row)
            told[k].append(label)
        if not taught:
            break
    views = trained()
    odds = np.c_[tuple(v.odds(rows) for v, rows in zip(views, held_rows))]
    return Model(views[0].w, views[1].w, tuple(np.array([v.slope, v.bias]) for v in views), fit_small(odds, labels[held]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordFeatures()
    for batch in (b.slice(i, SCORED_ROWS) for b in batches for i in range(0, b.num_rows, SCORED_ROWS)):
        found, count, bins = [], [], []
        for text in batch.column("text"):  # one text at a time in memory
            f, n, b = text_counts(text.as_py(), known)
            found.append(f.tobytes())
            count.append(n.astype(np.min_scalar_type(n.max(initial=0))).tobytes())
            bins.append(bytes(b))
        columns = (batch.column(c).to_pylist() for c in ("source", "lang", "n_chars"))
        meta = [meta_features(*x)[0].astype("<u2").tobytes() for x in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("source"), *(pa.array(x, pa.binary()) for x in (found, count, bins, meta))],
            ["id", "source", "found", "count", "bins", "meta"])


def _text_row(found: bytes, count: bytes, bins: bytes) -> Row:
    at = np.frombuffer(found, "<u2")
    n = np.frombuffer(count, f"<u{len(count) // len(at)}") if len(at) else np.empty(0, np.int64)
    return from_counts(at, n.astype(np.int64), list(bins))


def _meta_row(meta: bytes) -> Row:
    at = np.frombuffer(meta, "<u2").astype(np.int32)
    return at, np.full(len(at), META_WEIGHT, np.float32)


def _sure(given, confident: float):
    """The documents that one of the views is confident of, with the view that is taught and the label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views, used = given.value
        for batch in (b.slice(i, SCORED_ROWS) for b in batches for i in range(0, b.num_rows, SCORED_ROWS)):
            columns = [batch.column(c).to_pylist() for c in ("found", "count", "bins", "meta")]
            rows = (Rows([_text_row(*x) for x in zip(*columns[:3])]), Rows([_meta_row(m) for m in columns[3]]))
            fresh = ~np.isin(batch.column("print").to_numpy(), used)
            for k, (view, own) in enumerate(zip(views, rows)):
                p = _sigmoid(view.odds(own))
                for label, sure in ((1, p >= confident), (0, p <= 1 - confident)):
                    at = np.flatnonzero(sure & fresh)
                    kept = [batch.column(c).take(pa.array(at)) for c in ("uid", "id", "print", "source")]
                    yield pa.RecordBatch.from_arrays(
                        kept + [pa.array(np.full(len(at), x, np.int32)) for x in (1 - k, label)],
                        ["uid", "id", "print", "source", "view", "label"])

    return run


def taught_documents(features: DataFrame, known: DataFrame, views: list[View], used: np.ndarray,
                     taught_rows: int, confident: float) -> DataFrame:
    """(uid, view, label): what the views hand over. Of the documents whose id is not ``known`` and whose
    print is not ``used``, at most ``taught_rows`` for each view that is taught and each label, one
    of each print, evenly over the sources and in the order of the prints."""
    given = features.sparkSession.sparkContext.broadcast((views, used))
    rows = features.select("uid", "id", "print", "source", "found", "count", "bins", "meta")
    schema = rows.select("uid", "id", "print", "source").schema.add("view", "integer").add("label", "integer")
    sure = (rows.mapInArrow(_sure(given, confident), schema).join(known.select("id"), "id", "left_anti")
            .groupBy("view", "label", "source", "print").agg(F.min("uid").alias("uid")))

    def cut(df: DataFrame, keys: list[str], order: list[str], nth: str) -> DataFrame:
        w = Window.partitionBy("view", "label", *keys).orderBy(*order)
        return df.withColumn(nth, F.row_number().over(w)).where(F.col(nth) <= taught_rows)

    # a source's documents meet in SALTS tasks first, so the last task of a large one gets few of them
    dealt = cut(sure.withColumn("salt", F.pmod("print", F.lit(SALTS))), ["source", "salt"], ["print"], "_n")
    return cut(cut(dealt, ["source"], ["print"], "nth"), [], ["nth", "print", "source"], "_n").select("uid", "view", "label")


class WordWeights(dict):
    """Word -> the sum of its features' weights."""

    def __init__(self, w: np.ndarray):
        super().__init__()
        self.w = w

    def __missing__(self, word: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = float(self.w[zlib.crc32(word.lower()) % WORDS] + self.w[WORDS + _shape(word)])
        return out


def _score(model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        weights = None if isinstance(m, float) else WordWeights(m.text)
        for batch in (b.slice(i, SCORED_ROWS) for b in batches for i in range(0, b.num_rows, SCORED_ROWS)):
            if weights is None:
                p = np.full(batch.num_rows, m)
            else:
                z = []
                for text in batch.column("row").field(text_col):  # one text at a time in memory
                    data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    words = data.split()
                    z.append(sum(map(weights.__getitem__, words)) / max(1, len(words))
                             + BIN_WEIGHT * m.text[_all_bins(_measures(data, words, len(set(words))))].sum() + m.text[-1])
                columns = (batch.column(c).to_pylist() for c in ("source", "lang", "n_chars"))
                p = m.probability(np.array(z, float), Rows([meta_features(*x) for x in zip(*columns)]).scores(m.meta))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p, pa.float64())],
                                             ["row", "quality_score"])

    return run


def score_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", *, text_col: str = "text",
               source_col: str = "source", lang_col: str = "lang", size_col: str = "n_chars",
               label_col: str = "quality", labelled_rows: int = 3000, taught_rows: int = 500, rounds: int = 3,
               confident: float = 0.97) -> DataFrame:
    """One row per input row: row (a struct of its columns), quality_score (probability of a good
    document)."""
    spark = docs.sparkSession
    known = (labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    views = [F.col(id_col), F.col(text_col), F.col(source_col).cast("string"), F.col(lang_col).cast("string"),
             F.col(size_col).cast("double")]
    rows = docs.select(*[c.alias(n) for c, n in zip(views, ("id", "text", "source", "lang", "n_chars"))])
    with RunTables(spark):  # the features go when the model is there
        features = stash(feature_rows(rows))
        model = spark.sparkContext.broadcast(
            _learn(features, known, labelled_rows, taught_rows, rounds, confident))
    given = docs.select(F.struct("*").alias("row"), *[c.alias(n) for c, n in zip(
        views[2:], ("source", "lang", "n_chars"))])
    return given.mapInArrow(_score(model, text_col), given.select("row").schema.add("quality_score", "double"))


def feature_rows(rows: DataFrame) -> DataFrame:
    """(id, source, found, count, bins, meta, print, uid) of (id, text, source, lang, n_chars)."""
    schema = rows.select("id", "source").schema
    for c in ("found", "count", "bins", "meta"):
        schema = schema.add(c, "binary")
    return (rows.mapInArrow(_extract, schema)
            .withColumn("print", F.xxhash64("found", "count", "bins", "meta", "source"))
            .withColumn("uid", F.monotonically_increasing_id()))


def _learn(features: DataFrame, known: DataFrame, labelled_rows: int, taught_rows: int, rounds: int,
           confident: float) -> Model | float:
    """Co-training on written features; the driver holds the bounded training sets."""
    found = ("found", "count", "bins")
    chosen = (known.join(features.select("id"), "id", "left_semi")
              .orderBy(F.xxhash64(F.lit("sample"), "id"), "id").limit(labelled_rows))
    one_each = F.min(F.struct("print", "uid", "label", *found, "meta")).alias("row")
    labelled = features.join(F.broadcast(chosen), "id").groupBy("id").agg(one_each).select("row.*").collect()
    labelled.sort(key=lambda r: (r.print, r.uid))
    used = []

    def draw(views: list[View]) -> list[tuple[int, Row, int]]:
        taught = taught_documents(features, known, views, np.array(used, np.int64), taught_rows, confident)
        got = features.join(F.broadcast(taught), "uid").select("view", "label", "print", *found, "meta").collect()
        got.sort(key=lambda r: (r.print, r.view))
        used.extend({r.print for r in got})
        return [(r.view, _meta_row(r.meta) if r.view else _text_row(*(r[c] for c in found)), r.label) for r in got]

    return co_train([_text_row(*(r[c] for c in found)) for r in labelled], [_meta_row(r.meta) for r in labelled],
                    np.array([r.label for r in labelled], int), draw, rounds)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: id, quality_score."""
    scored = score_rows(docs, labels, id_col, **options)
    return scored.select(F.col(f"row.{id_col}").alias(id_col), "quality_score")
