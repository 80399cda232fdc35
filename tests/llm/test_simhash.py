import random
import re
from itertools import product

import numpy as np
import pytest
import xxhash

from dealscope.llm import simhash
from dealscope.llm.queries import op5_simhash

from .helpers import SF, SF2, edge_docs, no_docs, plain, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius=3):
    """Smallest fingerprint reachable from each."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[i + 1:]:
            if (x ^ y).bit_count() <= radius:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {f: find(f) for f in fps}


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def planted(seed, groups=12, size=25, far=300):
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(far)}
    for _ in range(groups):
        x = rng.getrandbits(64)
        for _ in range(size):
            out.add(x)
            for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 5))):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
def test_components_against_brute_force(spark, block):
    fps = planted(1)
    df = spark.createDataFrame([(as_signed(f),) for f in fps], "fp bigint")
    roots = dict(plain(simhash.components(simhash.links(df, block=block)), "node", "root"))
    want = brute_groups(fps)
    groups = {}
    for f, r in want.items():
        groups.setdefault(r, set()).add(as_signed(f))
    for members in groups.values():
        assert {roots.get(m, m) for m in members} == {min(members)}


def test_dense_group_emits_a_forest(spark):
    base = 0x0123456789ABCDEF
    fps = [base ^ 1 << a ^ 1 << b for a in range(40) for b in range(a)]
    df = spark.createDataFrame([(as_signed(f),) for f in fps], "fp bigint")
    edges = simhash.links(df)
    assert edges.count() < 8 * len(fps)
    assert {r for _, r in plain(simhash.components(edges), "node", "root")} == {min(map(as_signed, fps))}


@pytest.mark.parametrize("thresholds", [[0, 0, 0, 0], [1, 0, 0], [1, 1], [2, 0], [3], [-1, 1, 0, 0]])
def test_every_allocation_finds_every_link(spark, thresholds, monkeypatch):
    m = len(thresholds)
    parts = [list(range(k, 64, m)) for k in range(m)]
    if m == 1 or 2 in thresholds:
        parts = parts if m > 1 else [list(range(64))]
        fps = planted(2, groups=2, size=6, far=10)
    else:
        fps = planted(2)
    monkeypatch.setattr(simhash, "plan_search", lambda *a: (parts, thresholds))
    df = spark.createDataFrame([(as_signed(f),) for f in fps], "fp bigint")
    roots = dict(plain(simhash.components(simhash.links(df)), "node", "root"))
    got, want = {}, {}
    for f, r in brute_groups(fps).items():
        want.setdefault(r, set()).add(f)
        got.setdefault(roots.get(as_signed(f), as_signed(f)), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(0)
    for m in (2, 3, 4):
        shares = [sorted(rng.random(4) / 1000) for _ in range(m)]
        sizes = [64 // m] * m
        cost, best = simhash.allocate(shares, sizes, 10 ** 6, 3)
        assert sum(best) == 3 - m + 1

        def price(ts):
            return sum(simhash.PROBE_COST * sum(simhash._choose(s, k) for k in range(t + 1)) + 10 ** 6 * sh[t]
                       for t, s, sh in zip(ts, sizes, shares) if t >= 0)

        assert np.isclose(cost, min(price(ts) for ts in product(range(-1, 4), repeat=m) if sum(ts) == 3 - m + 1))


def test_candidate_estimates_are_close():
    rng = np.random.default_rng(4)
    bits = rng.random((3000, 64)) < rng.random(64)
    shared = bits.T.astype(float) @ bits
    part = simhash.group_bits(len(bits), shared, 4)[0]
    got = simhash.candidate_shares(part, len(bits), shared, 3)
    d = (bits[:1500, None, part] != bits[None, 1500:, part]).sum(axis=2)
    for t in range(4):
        assert np.isclose(got[t], (d <= t).mean(), rtol=0.25, atol=2e-4)


def test_query_against_brute_force(spark):
    texts = plain(table(spark, SF, "documents"), "doc_id", "text")
    fps = {d: brute_fp(t) for d, t in texts}
    roots = brute_groups(fps.values())
    first = {}
    for d, f in fps.items():
        first[roots[f]] = min(first.get(roots[f], d), d)
    want = sorted((d, f"{f:016x}", first[roots[f]]) for d, f in fps.items())
    assert sorted(plain(op5_simhash(spark, SF), "doc_id", "fingerprint", "component_id")) == want


def test_edges(spark):
    docs = edge_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert {r.component_id for r in rows if r.fp == 0} == {4}
    assert {r.component_id for r in rows if r.doc_id in (1, 3)} == {1}
    kept = simhash.keep_first(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(ids) == len({r.root for r in rows})
    assert ids.count(2) == 1 and 3 not in ids and 5 not in ids
    assert simhash.near_duplicates(no_docs(spark)).collect() == [] and simhash.keep_first(no_docs(spark)).collect() == []


def test_keep_first_on_documents(spark):
    docs = table(spark, SF2, "documents")
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == sorted(groups)


def test_buckets_of_probes_alone_are_not_compared(spark, monkeypatch):
    near, compared = simhash._near, []
    monkeypatch.setattr(simhash, "_near", lambda x, y, radius: compared.append(np.broadcast(x, y).size) or near(x, y, radius))
    key = np.array([1] * 200 + [2] * 3 + [3] * 30)
    fp = np.arange(len(key), dtype=np.uint64)
    data = np.isin(np.arange(len(key)), (201, 202))
    a, b = simhash._bucket_links(key, fp, data, 64)
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())} == {(200, 201), (200, 202), (201, 202)} and sum(compared) <= 3
    rows = [(0, 7, i, False) for i in range(50)] + [(0, 8, i, i == 0) for i in range(50)] + [(1, 7, i, i == 0) for i in range(5)]
    left = simhash.cut_buckets(spark.createDataFrame(rows, "part int, value bigint, fp bigint, data boolean"), 8).collect()
    assert {(r.fp, r.data) for r in left} == {(i, i == 0) for i in range(50)}
    # Of 50 rows in 7 blocks each stands with every block, the small bucket is whole, the bucket of probes alone is gone.
    assert len(left) == 50 * 7 + 5


def test_a_hot_empty_neighbour_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "plan_search", lambda *a: ([list(range(0, 32)), list(range(32, 64))], [1, 1]))
    rng = random.Random(9)
    fps = sorted({rng.getrandbits(32) << 32 | 1 for _ in range(300)} | {(0xABCDEF << 32 | 1) ^ x for x in (0, 2, 4 << 40)})
    df = spark.createDataFrame([(as_signed(f),) for f in fps], "fp bigint")
    roots = dict(plain(simhash.components(simhash.links(df, block=8)), "node", "root"))
    want, got = {}, {}
    for f, r in brute_groups(fps).items():
        want.setdefault(r, set()).add(f)
        got.setdefault(roots.get(as_signed(f), as_signed(f)), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
