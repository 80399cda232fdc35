import hashlib
import pickle
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import decontaminate as dc
from dealscope.llm.queries import ORACLE, op7_benchmark_decontamination

from .helpers import SF, edge_docs, no_docs, ordered, plain

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, window=13):
    w, hit, found = split(text), set(), set()
    for item, t in items:
        p = split(t)
        m = min(window, len(p))
        for k in range(len(p) - m + 1 if m else 0):
            for i in range(len(w) - m + 1):
                if w[i:i + m] == p[k:k + m]:
                    hit |= set(range(i, i + m))
                    found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab B-"), max_size=14), max_size=4), st.text(st.sampled_from("abAB. é"), max_size=40), st.integers(1, 4))
def test_matcher(items, text, window):
    items = list(enumerate(items))
    spans, found = dc.Matcher([(str(i), t.encode()) for i, t in items], window).search(dc.words_of(text.encode()))
    n, hit, n_items, _, _ = brute(text, items, window)
    assert (sum(b - a for a, b in dc._merged(spans)), len(found)) == (hit, n_items)


@pytest.mark.parametrize("chunk_bytes", [dc.CHUNK_BYTES, 300])
def test_chunks_of_the_benchmark(spark, chunk_bytes):
    rng = random.Random(1)
    items = [(k, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice((0, 1, 5, 13, 20, 30))))) for k in range(25)] + [(None, "w1 zz w3"), (3, "w2 zz w3")]
    docs = []
    for d in range(40):
        t = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split()
            at = rng.randrange(len(t) + 1)
            t[at:at] = part[rng.randrange(3):]
        docs.append((d, " ".join(t)))
    found = dc.find_contamination(spark.createDataFrame(docs, "doc_id int, text string"),
                                  spark.createDataFrame(items, "item_id int, text string"), chunk_bytes=chunk_bytes)
    got = {r.doc_id: tuple(r.contamination)[:5] for r in found.collect()}
    assert got == {d: brute(t, items) for d, t in docs}


def test_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLE["op7_benchmark_decontamination"])
    names = [c[0] for c in found.description]
    ours = op7_benchmark_decontamination(spark, SF)
    assert sorted(ours.columns) == sorted(names) and ordered(plain(ours, *names)) == ordered(found.fetchall())


def test_edges(spark):
    docs = edge_docs(spark)
    rows = plain(docs, "doc_id", "text")
    items = [(1, rows[0][1]), (1, rows[0][1]), (2, None), (3, ""), (4, "...")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = dc.find_contamination(docs, bench)
    assert ordered((r.doc_id, *tuple(r.contamination)[:5]) for r in found.collect()) == ordered((d, *brute(t, items)) for d, t in rows)
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not brute(t, items)[4] for _, t in rows)
    assert dc.find_contamination(no_docs(spark), bench).collect() == []
    clean = dc.find_contamination(docs, bench.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contamination.contaminated for r in clean)


def test_default_chunk_bounds_what_is_broadcast(spark):
    """A benchmark above one chunk: several bounded tables, each far below what a worker has."""
    rows = [(f"i{k}", " ".join(f"w{(k * 7919 + j * 31) % 50_000}" for j in range(4000))) for k in range(250)]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    chunks = list(dc._chunks(benchmark, "item_id", "text", dc.CHUNK_BYTES))
    assert len(chunks) >= 3 and sum(map(len, chunks)) == 250
    largest = max(chunks, key=lambda c: sum(len(t) for _, t in c))
    assert len(pickle.dumps(dc.Matcher(largest))) < 60 << 20
    docs = spark.createDataFrame([(1, rows[7][1]), (2, rows[200][1] + " tail"), (3, "clean words only")], "doc_id bigint, text string")
    found = dc.find_contamination(docs, benchmark)
    assert {r.doc_id: r.contamination.contaminated for r in found.collect()} == {1: True, 2: True, 3: False}
