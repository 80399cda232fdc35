import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dealscope.llm import suffixes
from dealscope.llm.queries import op6_suffix_dedup

from .helpers import SF, edge_docs, no_docs, ordered, plain, table


def brute(texts, length):
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcd é") for _ in range(rng.choice((15, 22, 30, 60)))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(shared)[rng.randrange(5):] if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))
                 for _ in range(rng.randrange(8))]
        texts.append("".join(parts))
    return texts + [texts[0], "a" * 90, "ab" * 30, "", "x"]


@pytest.mark.parametrize("seed, batches, hot", [(1, 1, 10 ** 6), (2, 2, 10 ** 6), (3, 5, 10 ** 6), (6, 8, 10 ** 6), (4, 2, 0), (5, 3, 4)])
def test_against_brute_force(spark, seed, batches, hot):
    texts = passages(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = suffixes.remove_repeats(docs, length=20, reach=9, batches=batches, hot=hot).orderBy("doc_id").collect()
    want = brute([t.encode() for t in texts], 20)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)


def test_levels_merge_like_a_binary_counter(spark):
    docs = spark.createDataFrame([(i, t.encode(), i) for i, t in enumerate(passages(7))], "doc_id bigint, data binary, body bigint")
    family, sizes = suffixes.IndexFamily(spark), []
    for k in range(5):
        family.add(suffixes.suffixes(docs.where(f"doc_id % 5 = {k}"), 20, 9))
        sizes.append(sorted(family.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
    whole = suffixes.suffixes(docs, 20, 9).groupBy("key").count().where("count > 1")
    assert {r.key for r in family.matched().collect()} == {r.key for r in whole.collect()}


def test_anchors_cover_every_start_once():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(80))) for _ in range(40)]
    ends = np.cumsum([len(t) for t in texts])
    seen = Counter()
    for d, a, s, e in zip(*suffixes.anchors(b"".join(texts), ends, 20, 9)):
        assert s <= a < e + 9 and a - s < 9
        seen.update((int(d), p) for p in range(s, e + 1))
    assert set(seen.values()) == {1}
    assert len(seen) == sum(max(0, len(t) - 19) for t in texts)


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 50)
    texts = [b"x" * 19, b"", bytes(range(200)), b"y" * 20]
    starts = Counter()
    for rows, offsets, parts in suffixes._pieces(iter(texts), 20):
        for row, at, part in zip(rows, offsets, parts):
            assert texts[row][at:at + len(part)] == part
            starts.update((row, at + i) for i in range(len(part) - 19))
    assert set(starts.values()) == {1} and len(starts) == 181 + 1


def test_query_against_brute_force(spark):
    texts = plain(table(spark, SF, "documents").orderBy("doc_id"), "doc_id", "text")
    want = [(d, *x) for (d, _), x in zip(texts, brute([t.encode() for _, t in texts], 400))]
    assert ordered(plain(op6_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(want)


def test_query_goes_by_bytes_not_words(spark, tmp_path):
    rng = random.Random(12)
    short, long = (" ".join(f"{rng.randrange(10 ** 5):05}" for _ in range(70))[:n] for n in (399, 400))
    assert min(len(short.split()), len(long.split())) > 50
    rows = [(1, f"a{short}b"), (2, f"c{short}d"), (3, f"e{long}f"), (4, f"g{long}h")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = plain(op6_suffix_dedup(spark, str(tmp_path)), "doc_id", "n_bytes", "n_removed", "n_spans", "has_repeats")
    assert ordered(got) == [(1, 401, 0, 0, False), (2, 401, 0, 0, False), (3, 402, 400, 1, True), (4, 402, 400, 1, True)]


def test_edges(spark):
    rows = plain(edge_docs(spark).select("doc_id", "text"), "doc_id", "text")
    want = [(d, *x) for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows], 40))]
    got = suffixes.remove_repeats(edge_docs(spark), length=40, reach=20)
    assert ordered(plain(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(want)
    assert suffixes.remove_repeats(no_docs(spark)).collect() == []


def test_repeated_rows_give_their_runs_once(spark, monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(None, text)] * 60 + [(1, "x" * 9 + text[100:190] + "yz")]
    opened = []
    partial = suffixes._partial_spans
    monkeypatch.setattr(suffixes, "_partial_spans", lambda df, *a: opened.append(df.count()) or partial(df, *a))
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length=20, reach=9)
    want = [(d, *x) for (d, _), x in zip(rows, brute([t.encode() for _, t in rows], 20))]
    assert ordered(plain(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == ordered(want)
    assert 0 < opened[0] < 60


def test_stored_family_takes_later_batches(spark, tmp_path):
    texts = passages(9)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    folder = str(tmp_path / "family")
    for low, high in ((0, 30), (30, 45), (45, len(rows))):
        have = docs.where(f"doc_id < {high}")
        added = docs.where(f"doc_id >= {low} AND doc_id < {high}")
        family = suffixes.IndexFamily.open(spark, folder) if low else suffixes.IndexFamily(spark, 20, 9, folder)
        got = suffixes.remove_repeats(have, batches=1, family=family, added=added).orderBy("doc_id").collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute([t.encode() for _, t in rows[:high]], 20)
    family = suffixes.IndexFamily.open(spark, folder)
    assert sorted(family.levels) == [0, 1] and len(family.matches) == 3
    assert len(list((tmp_path / "family").glob("run-*"))) == 2       # replaced runs are gone


def test_failed_batch_leaves_the_stored_family(spark, tmp_path, monkeypatch):
    texts = passages(10)
    docs = spark.createDataFrame([(i, t.encode(), i) for i, t in enumerate(texts)], "doc_id bigint, data binary, body bigint")
    folder = str(tmp_path / "family")
    family = suffixes.IndexFamily(spark, 20, 9, folder)
    family.add(suffixes.suffixes(docs.where("doc_id < 30"), 20, 9))
    family.commit()
    before = {r.key for r in family.matched().collect()}
    written = family._written

    def broken(rows, label):
        if label == "match":
            raise RuntimeError("lost")
        return written(rows, label)

    monkeypatch.setattr(family, "_written", broken)
    with pytest.raises(RuntimeError):
        family.add(suffixes.suffixes(docs.where("doc_id >= 30"), 20, 9))
    suffixes.IndexFamily.open(spark, folder).add(suffixes.suffixes(docs.where("doc_id >= 30"), 20, 9))      # not committed
    again = suffixes.IndexFamily.open(spark, folder)
    assert {r.key for r in again.matched().collect()} == before
    again.add(suffixes.suffixes(docs.where("doc_id >= 30"), 20, 9))
    whole = suffixes.suffixes(docs, 20, 9).groupBy("key").count().where("count > 1")
    assert {r.key for r in again.matched().collect()} == {r.key for r in whole.collect()}


def test_batches_follow_the_bytes(spark, monkeypatch):
    texts = passages(11)
    monkeypatch.setattr(suffixes, "BATCH_BYTES", sum(len(t.encode()) for t in texts) // 4)
    added = []
    add = suffixes.IndexFamily.add
    monkeypatch.setattr(suffixes.IndexFamily, "add", lambda self, runs: added.append(1) or add(self, runs))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = suffixes.remove_repeats(docs, length=20, reach=9).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == brute([t.encode() for t in texts], 20)
    assert len(added) in (4, 5)
