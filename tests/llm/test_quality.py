import zlib

import numpy as np

from dealscope.llm import quality
from dealscope.llm.linear import Ftrl, NgramHasher, sigmoid
from dealscope.llm.queries import op1_quality_classifier

from .helpers import SF2, edge_docs, no_docs, ordered, plain, table


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op1_quality_classifier(spark, SF2).collect()}
    assert len(rows) == table(spark, SF2, "documents").count()
    held = [r for r in table(spark, SF2, "labels").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(rows[r.doc_id].held_out for r in held) and len(held) > 50
    right = sum(rows[r.doc_id].predicted == r.quality for r in held) / len(held)
    assert right >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_dot_equals_row():
    hasher, rng = NgramHasher(bits=10), np.random.default_rng(1)
    w = rng.normal(size=1025)
    for text in (b"", b"a", b"a b a b", b"The THE the*** 12 \xc3\xa9t\xc3\xa9"):
        index, value = hasher.row(text)
        assert np.isclose(hasher.dot(w, text), w[index] @ value + w[-1])


def test_long_words_are_hashed_whole_and_not_kept():
    """Words of 10 KB, as in text without spaces: same columns as their own hashes give, small cache."""
    hasher, plain_hasher = NgramHasher(bits=10), NgramHasher(bits=10)
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, 10_000, dtype=np.uint8)) for _ in range(40)]
    for k in range(0, 40, 4):
        text = b" ".join([b"short", *words[k:k + 4], b"A-1"])
        own = np.array([plain_hasher._words._hashes(w) for w in text.split()], np.uint64)
        assert (hasher._words.lookup(text.split()) == own).all()
        assert (hasher.grams(text) == NgramHasher(bits=10).grams(text)).all()
    assert sum(map(len, hasher._words)) < 2_000


def test_replicas_are_dealt_by_bytes_too(spark, monkeypatch):
    """Long training texts: more replicas, and a model that still tells the labels apart."""
    docs = spark.createDataFrame([(i, ("good fine " if i % 2 else "bad poor ") * 2_000 + str(i)) for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "BYTES_PER_REPLICA", 300_000)
    found = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert min(v for k, v in found.items() if k % 2) > max(v for k, v in found.items() if k % 2 == 0)


def test_ftrl_learns_and_l1_keeps_weights_sparse():
    rows = [(np.array([k % 2, 2 + k % 5, 8]), np.ones(3), k % 2) for k in range(200)]
    w = Ftrl(8, alpha=0.5, l1=1.0, l2=0.1).fit(rows, 5)
    assert sigmoid(w[1] + w[8]) > 0.8 > 0.2 > sigmoid(w[0] + w[8])
    assert w[7] == 0


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 0), (9, 0), (10, 1)], "doc_id bigint, quality int")
    docs = edge_docs(spark)
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    blank = {r.score for r in rows if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1 and 0 < blank.pop() < 1
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert quality.classify(no_docs(spark), labels).collect() == []
    none = quality.classify(docs, labels.where("doc_id < 0"))
    assert set(plain(none, "score", "predicted")) == {(0.5, 0)}


def test_same_scores_again(spark):
    docs, labels = table(spark, SF2, "documents").limit(200), table(spark, SF2, "labels")
    assert ordered(plain(quality.classify(docs, labels), "doc_id", "score")) == ordered(plain(quality.classify(docs.repartition(5), labels), "doc_id", "score"))
