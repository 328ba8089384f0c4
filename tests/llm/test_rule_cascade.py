"""The cascade against plain Python, in any order of the rules."""

import random
import re
from collections import Counter

import pytest

from firmdyn.llm.rule_cascade import MEASURES, RULES, in_order, rule_cascade

SCHEMA = "doc_id long, text string, kept string, id string, n_words int"


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = Counter(grams)
    covered = {p for i, g in enumerate(grams) if many[g] > 1 for p in range(i, i + 8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "alpha_words": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words),
            "echo_words": sum(a == b for a, b in zip(words, words[1:])),
            "upper_words": sum(bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words)}


def texts():
    rng = random.Random(9)
    vocab = ["the", "of", "Haus", "été", "CAPS", "12", "a*b", "#", "漢字", "x" * 30]
    out = [None, "", " \n\t", "word", "\n\na\n a\na\n", "one two three four five six seven eight " * 2,
           "same " * 40, "long words " * 20_000]
    for _ in range(150):
        weights = [rng.random() ** 3 for _ in vocab]
        out.append("".join(rng.choices(vocab, weights)[0] + rng.choice([" ", " ", "  ", "\n", "\r\n"])
                           for _ in range(rng.randrange(0, 120))))
    return out + out[-3:]


@pytest.mark.parametrize("rules", [RULES, RULES[::-1]])
def test_against_plain_python(spark, rules):
    data = [(i, t, "x", "y", 0) for i, t in enumerate(texts())] + [(None, "null id", "x", "y", 0)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    out = rule_cascade(docs, rules=rules, always=tuple(MEASURES), sample_rows=50).collect()
    assert len(out) == len(data)
    of = {i: t for i, t, *_ in data}
    for row in out:
        m = measures(of[row.doc_id])
        assert {k: row[k] for k in MEASURES} == m
        assert row.kept == (not any(r.test(*(m[k] for k in r.needs)) for r in RULES))
    lazy = rule_cascade(docs, rules=rules, sample_rows=50).collect()
    assert sorted((str(r.doc_id), r.kept) for r in lazy) == sorted((str(r.doc_id), r.kept) for r in out)


def test_order_is_by_rejection_per_second():
    found = {r.name: (1.0 + i, 10.0) for i, r in enumerate(RULES)} | {"letters": (100.0, 5000.0)}
    names = [r.name for r in in_order(RULES, found)]
    assert names[:2] == ["letters", "few_words"] and names[-1] == "capitals"


def test_empty_table(spark):
    assert rule_cascade(spark.createDataFrame([], SCHEMA), always=("n_words",)).collect() == []
