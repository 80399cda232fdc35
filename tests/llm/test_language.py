import zlib

import numpy as np

from dealscope.llm import language
from dealscope.llm.queries import op12_language_id

from .helpers import SF2, edge_docs, no_docs, ordered, plain, table


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def letter(code, dim=language.DIM, seed=language.SEED):
    bits = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dim, dtype=np.int8)
    return bits.astype(np.int64) * 2 - 1


def brute_vector(text, dim=language.DIM):
    """Bundle of the n-grams one by one, from whole vectors."""
    c = [ord(x) if x.isalpha() else 0 for x in f" {text.lower()} "]
    out = np.zeros(dim, np.int64)
    for a, b, d in zip(c, c[1:], c[2:]):
        if b:
            out += np.roll(letter(a, dim), 2) * np.roll(letter(b, dim), 1) * letter(d, dim)
    return out


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, SF2, "documents").collect()}
    rows = op12_language_id(spark, SF2).collect()
    assert len(rows) == len(docs) and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang is not None and any(x.isalpha() for x in docs[r.doc_id].text or "")]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    assert len(held) > 100 and right >= 0.97, right


def test_predictions_equal_brute_force(spark):
    """Prototypes and cosines recomputed n-gram by n-gram for a small table."""
    docs = table(spark, SF2, "documents").where("length(text) < 400").limit(60)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = docs.collect()
    sums = {}
    for r in rows:
        if not held_out(r.doc_id) and r.lang is not None:
            sums[r.lang] = sums.get(r.lang, 0) + brute_vector(r.text or "")
    langs, vectors = language.prototypes(docs)
    assert langs == sorted(sums) and all((vectors[i] == sums[x]).all() for i, x in enumerate(langs))
    for r in language.identify(docs).collect():
        v = brute_vector(next(x.text for x in rows if x.doc_id == r.doc_id) or "")
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {x: float(s @ v / np.linalg.norm(s) / np.linalg.norm(v)) for x, s in sums.items()}
        assert abs(max(cosines.values()) - cosines[r.lang_pred]) < 1e-5 and abs(r.score - max(cosines[r.lang_pred], 0)) < 1e-5


def test_pieces_and_slices_change_nothing(monkeypatch):
    text = "Straße über Brücke 12 αβγ δε日本語 İstanbul! " * 30
    whole = language.Space(256).bundle(*language.ngrams(text))
    assert (whole == brute_vector(text, 256)).all()
    monkeypatch.setattr(language, "_PIECE", 7)
    monkeypatch.setattr(language, "_SLICE", 5)
    assert (language.Space(256).bundle(*language.ngrams(text)) == whole).all()


def test_edges(spark):
    docs = edge_docs(spark)
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(by_id[k][0].lang_pred == "und" and by_id[k][0].score == 0 for k in (4, 5, 6))
    assert {r.held_out for r in by_id[None]} == {False}
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "und"}
    assert language.identify(no_docs(spark)).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert set(plain(language.identify(unlabelled), "lang_pred", "score")) == {("und", 0.0)}


def test_ties_and_order_of_rows(spark):
    docs = spark.createDataFrame([(1, "abc abc", "b"), (2, "abc abc", "a"), (3, "abc", None)], "doc_id bigint, text string, lang string")
    assert not held_out(1) and not held_out(2)
    assert {r.doc_id: r.lang_pred for r in language.identify(docs).collect()} == {1: "a", 2: "a", 3: "a"}
    some = table(spark, SF2, "documents")
    a, b = (plain(language.identify(d), "doc_id", "lang_pred", "score") for d in (some, some.repartition(7)))
    assert ordered(a) == ordered(b)
