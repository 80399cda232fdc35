import random
import re

import pytest

from dealscope.llm import mixing
from dealscope.llm.queries import op4_source_mixing

from .helpers import SF2, edge_docs, no_docs, ordered, plain, table


def brute_targets(sizes):
    """Share by weight, cut, and share the excess again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, cut = {}, set(order), set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in cut)
        total = sum(weight[s] for s in free)
        target = {s: 2 * sizes[s] if s in cut else left * weight[s] / total for s in order}
        above = {s for s in free if target[s] > 2 * sizes[s]}
        if not above:
            return target
        cut |= above
        free -= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice((0, 5, 100, 1000, rng.randrange(10000))) for k in range(9)} | {None: 77, "é": 500}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = dict(plain(mixing.targets(rows), "source", "target"))
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes)


def check(rows, size_of):
    totals = {}
    for r in rows:
        assert r.size == size_of(r) and 0 <= r.taken <= 2 * r.size
        totals.setdefault(r.source, []).append(r)
    want = brute_targets({s: sum(r.size for r in x) for s, x in totals.items()})
    for s, x in totals.items():
        assert {r.source_size for r in x} == {sum(r.size for r in x)}
        assert all(abs(r.target - want[s]) <= 1e-6 * max(1, want[s]) for r in x)
    return {s: (sum(r.taken for r in x), want[s], max(r.size for r in x)) for s, x in totals.items()}


def test_taken_meets_targets(spark):
    texts = dict(plain(table(spark, SF2, "documents"), "doc_id", "text"))
    rows = mixing.mix(table(spark, SF2, "documents")).collect()
    for taken, want, _ in check(rows, lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))).values():
        assert abs(taken - want) <= 0.01 * want
    again = op4_source_mixing(spark, SF2)
    assert ordered((r.doc_id, r.taken) for r in rows) == ordered(plain(again, "doc_id", "taken"))


def test_targets_are_met_without_newton_steps(spark, monkeypatch):
    docs = table(spark, SF2, "documents")
    newton = {r.source: r.rate for r in mixing.mix(docs).where("size = 20").collect()}
    monkeypatch.setattr(mixing, "NEWTON_STEPS", 0)
    halved = {r.source: r.rate for r in mixing.mix(docs).where("size = 20").collect()}
    assert newton.keys() == halved.keys() and all(abs(newton[s] - halved[s]) < 1e-4 for s in newton)


def test_a_mix_that_misses_its_targets_fails(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="entropy balancing"):
        mixing.mix(table(spark, SF2, "documents"))


def test_tilt_is_exponential_and_capped(spark):
    rows = mixing.mix(table(spark, SF2, "documents")).where("size > 0 AND target < 2 * source_size").collect()
    import math
    by = {}
    for r in rows:
        assert 0 < r.rate <= 2
        if r.rate < 2:
            by.setdefault(r.source, set()).add(round(math.log(r.rate) / r.size, 9))
    assert all(len(x) == 1 for x in by.values())


def test_buckets_of_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    docs = spark.createDataFrame([(i, "a b c", "s" if i % 3 else "t", i) for i in range(600)], "doc_id int, text string, source string, n bigint")
    rows = mixing.mix(docs).collect()
    for taken, want, _ in check(rows, lambda r: 3).values():
        assert abs(taken - want) <= 0.05 * want


def test_edges(spark):
    docs = edge_docs(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    found = check(rows, lambda r: r.size)
    assert None in found
    assert all(r.copies == 1 and r.taken == 0 for r in rows if r.size == 0)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixing.mix(no_docs(spark)).collect() == [] and mixing.mixed(no_docs(spark)).collect() == []


def test_mixed_repeats_documents(spark):
    docs = table(spark, SF2, "documents").where("doc_id < 200")
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    rows = mixing.mixed(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in rows} == {d: c for d, c in copies.items() if c}
