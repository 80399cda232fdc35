import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import fim
from dealscope.llm.queries import op11_fill_in_middle

from .helpers import SF2, edge_docs, edge_rows, no_docs, ordered, plain, table

COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def brute(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    pre, mid, suf = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, sha(text), sha(text)
    spm = h[3] % 100 < 50
    out = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, len(lines), "spm" if spm else "psm", len(pre), len(mid), sha(out), sha(text)


def test_equals_brute_force(spark):
    rows = plain(table(spark, SF2, "documents"), "doc_id", "text")
    found = plain(op11_fill_in_middle(spark, SF2), *COLUMNS)
    assert ordered(found) == ordered([brute(*r) for r in rows])
    assert {r[2] for r in found} >= {"psm", "spm"}


def test_edges(spark):
    docs = edge_docs(spark).unionByName(spark.createDataFrame(
        [(20 + k, t, "en", "s", 1, "x", 1, 2, "y", None) for k, t in enumerate(("\n", "\n\n\n", "a<P>b\nc", "<S", "a\r\nb\n", "ß\n日本\n" * 50, "x\n<M>"))],
        edge_docs(spark).schema))
    found = fim.fill_in_middle(docs)
    assert ordered(plain(found, *COLUMNS)) == ordered([brute(*r) for r in plain(docs, "doc_id", "text")])
    for r in found.collect():
        assert hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256
    assert len(edge_rows()) + 7 == found.count()
    assert fim.fill_in_middle(no_docs(spark)).collect() == []
    assert set(plain(fim.fill_in_middle(docs, rate=0), "form")) == {("plain",)}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab<PSM>\né", max_size=60), st.integers(0, 10**6))
def test_round_trip(text, doc_id):
    form, n, prefix, middle, output = fim.transform(doc_id, text.encode())
    assert fim.restore(output, form) == text.encode()
    assert (form, n, prefix, middle) == (brute(doc_id, text)[2], *brute(doc_id, text)[1:2], *brute(doc_id, text)[3:5])


@pytest.mark.parametrize("error", [0, 1, 8, 64])
def test_rank_index_is_exact_within_its_bound(error):
    rng = np.random.default_rng(2)
    arrays = [np.array([0]), np.array([0, 5]), np.arange(0, 9000, 9), np.concatenate(([0], np.cumsum(rng.integers(1, 90, 5000)))),
              np.concatenate(([0], np.cumsum(rng.pareto(0.8, 3000).astype(np.int64) + 1))), np.arange(300) ** 3]
    for offsets in arrays:
        index = fim.RankIndex(offsets, error)
        assert [index.select(k) for k in range(len(offsets))] == offsets.tolist()
        assert np.abs(index.residuals).max() <= error + 1
        with pytest.raises(IndexError):
            index.select(len(offsets))
    assert len(fim.RankIndex(arrays[2], error).starts) == 1         # evenly spaced: one segment
    assert fim.RankIndex(arrays[3], 64).residuals.dtype == np.int8
    assert len(fim.RankIndex(arrays[3], 64).starts) < 300           # far fewer segments than boundaries
