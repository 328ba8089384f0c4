"""Pfair schedules: deadlines, deviation, and the distributed order against a plain loop."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from firmdyn.llm import pfair_mix as module
from firmdyn.llm.pfair_mix import exact_shares, mixed_rows, pfair_mix, schedule, turns, whole_weights

SCHEMA = "doc_id long, text string, source string, slot int, n string"


@pytest.mark.parametrize("seed", range(8))
def test_schedule_stays_within_one_block(seed):
    rng = random.Random(seed)
    shares = whole_weights([rng.random() ** 3 + 1e-9 for _ in range(rng.randrange(1, 30))], 700)
    assert sum(shares) == 700 and min(shares) >= 1
    done = Counter()
    for slot, i in enumerate(schedule(shares), 1):
        k = done[i]
        assert k * 700 // shares[i] < slot <= -(-(k + 1) * 700 // shares[i])  # released, and due
        done[i] += 1
        assert all(abs(done[j] * 700 - slot * s) < 700 for j, s in enumerate(shares))


def rows():
    out = [(i, f"t{i}", f"s{i % 7 if i % 3 else 0}", 0, "x") for i in range(900)]
    return out + [(2000 + i, None, None, 0, "x") for i in range(13)] + [(None, "", "s1", 0, "x")]


def test_every_document_in_weighted_order(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    natural = Counter(r[2] for r in data)
    weights = {s: 1 + i for i, s in enumerate(sorted(natural, key=str))}
    out = pfair_mix(docs, weights, block_rows=10, period=300).collect()
    assert {r.doc_id for r in out} == {r[0] for r in data}
    blocks = defaultdict(set)
    for r in out:
        blocks[r.slot].add((r.source, r.block, r.epoch))
        assert r.position // 10 == r.slot
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())
    # after any number of slots a source is less than a block from its whole weight
    shares = dict(zip(sorted(natural, key=lambda s: (s is not None, s)),
                      whole_weights([weights[s] for s in sorted(natural, key=lambda s: (s is not None, s))], 300)))
    done, order = Counter(), [next(iter(blocks[s])) for s in range(len(blocks))]
    for slot, (source, block, epoch) in enumerate(order, 1):
        size = -(-natural[source] // 10)
        assert done[source] == epoch * size + block  # a source's blocks run in order
        done[source] += 1
        assert all(abs(done[s] * 300 - slot * a) < 300 for s, a in shares.items())
    # it ends with the use of the last unused block
    assert max(r.slot for r in out if r.epoch == 0) == len(order) - 1
    uses = Counter((r.doc_id, r.epoch) for r in out)
    assert set(uses.values()) == {1}


def test_once_and_excluded_sources(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    weights = {s: 1.0 for s in [None, *(f"s{i}" for i in range(7))]} | {"s2": 0}
    out = pfair_mix(docs, weights, block_rows=5, size="once").collect()
    assert max(r.epoch for r in out) == 0 and "s2" not in {r.source for r in out}
    per_source = Counter((r.source, r.block) for r in out)
    assert max(Counter(s for s, _ in per_source).values()) <= 1 + min(Counter(s for s, _ in per_source).values())


def test_rows_of_the_mix(spark):
    data = rows() + [(1, "t1", "s1", 0, "x")]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    mix = {(r.doc_id, r.source): r.n for r in
           pfair_mix(docs).groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    got = Counter((r.doc_id, r.text, r.source) for r in mixed_rows(docs).collect())
    want = Counter()
    for i, t, s, *_ in data:  # the repeated row shares the uses of its id and source
        want[i, t, s] += mix[i, s] / (2 if (i, s) == (1, "s1") else 1)
    assert {k[0] for k in got} == {k[0] for k in want} and mixed_rows(docs).columns == docs.columns
    assert all(abs(got[k] - want[k]) < 1 for k in want) and sum(got.values()) == sum(mix.values())


@pytest.mark.parametrize("at_once", [module.COPIES_AT_ONCE, 64])
def test_rows_without_an_id_of_their_own(spark, monkeypatch, at_once):
    """A thousand rows without an id, and a thousand with one id, are a thousand documents each."""
    monkeypatch.setattr(module, "COPIES_AT_ONCE", at_once)
    data = [(i, f"a{i}", "a", 0, "x") for i in range(1000)]
    data += [(None, f"b{i}", "b", 0, "x") for i in range(1000)] + [(7, f"c{i % 500}", "c", 0, "x") for i in range(1000)]
    data += [(i % 20, f"d{i}", None, 0, "x") for i in range(1000)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    weights = {"a": 1.0, "b": 1.0, "c": 2.0, None: 1.0}
    out = pfair_mix(docs, weights, block_rows=50).collect()
    assert len({r.position for r in out}) == len(out) and max(Counter(r.slot for r in out).values()) == 50
    done = Counter()
    for nth, r in enumerate(sorted(out, key=lambda r: r.position), 1):
        done[r.source] += 1
        assert all(abs(done[s] - nth * w / 5) < 101 for s, w in weights.items())
    got = Counter((r.source, r.text) for r in mixed_rows(docs, weights, block_rows=50).collect())
    rows_of = Counter((s, t) for _, t, s, *_ in data)
    uses = {s: n / 1000 for s, n in done.items()}
    assert set(got) == set(rows_of)
    for (s, t), n in got.items():
        assert n >= rows_of[s, t] and abs(n - rows_of[s, t] * uses[s]) <= rows_of[s, t]


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pfair_mix(empty).collect() == [] and mixed_rows(empty).collect() == []
    docs = spark.createDataFrame(rows(), SCHEMA)
    with pytest.raises(ValueError):
        pfair_mix(docs, {"s1": 1.0})
    with pytest.raises(ValueError):
        pfair_mix(docs, size="all")


def test_whole_weights_keep_exact_ones():
    assert whole_weights([0.9, 0.1], 1000) == [900, 100]
    assert whole_weights([1.0, 1e-9, 1e-9], 30) == [28, 1, 1]


@pytest.mark.parametrize("given", [[0.9, 0.1], [0.5] + [0.5 / 119] * 119, [0.9999, 0.0001], [3, 1e-3, 2.7, 1e-6]])
def test_long_runs_stay_at_the_given_weights(given):
    shares = exact_shares(given, [1000] * len(given), [10] * len(given))
    total, done = sum(given), Counter()
    for slot, (i, k) in zip(range(1, 30_001), turns(shares)):
        assert k == done[i]
        done[i] += 1
        assert abs(done[i] - slot * given[i] / total) < 1 + 1e-6
    assert all(abs(done[i] - slot * w / total) < 1 + 1e-6 for i, w in enumerate(given))


@pytest.mark.parametrize("broadcast", [module.BROADCAST_SLOTS, 0])
def test_documents_at_the_given_weights(spark, monkeypatch, broadcast):
    """After any number of slots, also for sources that do not fill a block."""
    monkeypatch.setattr(module, "BROADCAST_SLOTS", broadcast)
    natural = {"big": 3000, "rest": 1010, "tiny": 3} | {f"s{i:03}": 11 for i in range(100)}
    weights = {"big": 0.5, "rest": 0.2, "tiny": 0.01} | {f"s{i:03}": 0.0029 for i in range(100)}
    docs = spark.createDataFrame([(i, "", s, 0, "x") for s, n in natural.items() for i in range(n)], SCHEMA)
    out = pfair_mix(docs, weights, block_rows=20).collect()
    assert {(r.source, r.doc_id) for r in out if r.epoch == 0} == {(s, i) for s, n in natural.items() for i in range(n)}
    assert len({r.position for r in out}) == len(out) and all(r.position // 20 == r.slot for r in out)
    uses, size = Counter((r.source, r.doc_id) for r in out), Counter((r.slot, r.source) for r in out)
    for s, n in natural.items():  # no document is used twice more than another of its source
        assert max(uses[s, i] for i in range(n)) <= 1 + min(uses[s, i] for i in range(n))
    mean = {s: n / -(-n // 20) for s, n in natural.items()}
    need = {s: weights[s] / mean[s] for s in natural}
    per_slot = {s: x / sum(need.values()) for s, x in need.items()}
    done = Counter()
    for slot, source in sorted(size):
        done[source] += size[slot, source]
        assert abs(done[source] - (slot + 1) * per_slot[source] * mean[source]) < mean[source] + 1.001
    for s in ("big", "rest", "tiny"):
        assert done[s] / len(out) == pytest.approx(weights[s], rel=0.05)
