"""Fill-in-middle against a plain loop over code points, and back."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firmdyn.llm import fim_arrow
from firmdyn.llm.fim_arrow import cut_texts, fill_in_middle, restored_text, split_units

SCHEMA = "doc_id long, text string, output string, form string, h1 int"


def brute(doc_id, text, seed="1", plain=90, spm=20, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n, (p, s, m) = len(text), markers
    if not text or any(x in text for x in markers) or h3 % 100 >= plain:
        return (doc_id, n, "plain", None, None, text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < spm:
        return (doc_id, n, "spm", low, high - low, s + text[high:] + p + text[:low] + m + text[low:high])
    return (doc_id, n, "psm", low, high - low, p + text[:low] + s + text[high:] + m + text[low:high])


def rows():
    texts = [None, "", "a", "é", "日本語のテキスト", "a😀b" * 40, "no <P> here", "x<M>", "<S", "P><", "<<S", "\n \t\x00z",
             "plain words and more words\n" * 30, "long é😀 " * 20_000]
    out = [(i, t) for i in range(30) for t in texts[:13]] + [(77, texts[13]), (78, texts[13]), (None, "no id"), (None, None)]
    return [(i, t, "x", "y", 5) for i, t in out]


@pytest.mark.parametrize("most", [4, 61, 1 << 19])
def test_against_a_loop(spark, monkeypatch, most):
    monkeypatch.setattr(fim_arrow, "SLICE_BYTES", most)
    data = rows() if most > 100 else rows()[:200]
    run = fim_arrow._rearrange(10, 20, ("<P>", "<S>", "<M>"))

    def draw(i, nth):
        return int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * nth:8 * nth + 8], 16)

    batch = pa.RecordBatch.from_pydict({
        "id": pa.array([r[0] for r in data], pa.int64()), "text": pa.array([r[1] or "" for r in data]),
        "h1": [draw(r[0], 0) for r in data], "h2": [draw(r[0], 1) for r in data],
        "h3": [draw(r[0], 2) % 100 for r in data], "h4": [draw(r[0], 3) % 100 for r in data]})
    got = [tuple(r.values()) for b in run([batch]) for r in b.to_pylist()]
    assert got == [brute(r[0], r[1]) for r in data]


def test_in_spark_and_back(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    out = fill_in_middle(docs)
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(map(tuple, out.collect()), key=key) == sorted((brute(r[0], r[1]) for r in data), key=key)
    back = out.select("doc_id", restored_text(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((r[0], r[1] or "")) for r in data)


def test_other_parameters(spark):
    data = [(i, f"text number {i} of some") for i in range(60)] + [(99, "with [M] inside")]
    docs = spark.createDataFrame(data, "key long, body string")
    marks = ("[P]", "[S]", "[M]")
    out = fill_in_middle(docs, "key", "body", seed="other", plain_percent=40, spm_percent=70, markers=marks)
    want = [brute(i, t, "other", 60, 70, marks) for i, t in data]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    back = out.select("key", restored_text(F.col("output"), F.col("form"), marks)).collect()
    assert sorted(map(tuple, back)) == sorted(data)


def test_units():
    units = split_units(pa.array(["aé😀", "", "日"], pa.large_string()))
    assert units.to_pylist() == [["a", "é", "😀"], [], ["日"]]
    assert split_units(pa.array([], pa.large_string())).to_pylist() == []


def test_a_text_in_parts_is_cut_as_a_whole():
    text = "é😀a日" * 500
    for most in (4, 7, 100, 10_000):
        n, low, high, (a, b, c) = cut_texts(pa.array([text, "", "xy"], pa.large_string()), pa.array([700, 1, 5]),
                                            pa.array([2001 * 3 + 300, 2, 1]), most)
        assert n.to_pylist() == [2000, 0, 2] and low.to_pylist() == [300, 0, 1] and high.to_pylist() == [700, 0, 2]
        assert a.to_pylist() == [text[:300], "", "x"] and b.to_pylist() == [text[300:700], "", "y"]
        assert c.to_pylist() == [text[700:], "", ""]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fill_in_middle(docs).collect() == []
