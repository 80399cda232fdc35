import re
import struct
import zlib

import numpy as np
import xxhash

import corpus_pipeline as pipeline
from dealscope.llm import decontaminate, mixing, quality, simhash
from dealscope.llm.common import stored
from dealscope.llm.linear import Ftrl, NgramHasher, sigmoid

from .helpers import SF2, edge_docs, no_docs, plain, table
from .test_decontaminate import brute as contaminated
from .test_mixing import check
from .test_simhash import brute_fp, brute_groups
from .test_tokens import expected


def test_stages_against_their_operators(spark):
    docs = table(spark, SF2, "documents")
    columns = docs.columns
    kept = {d: t for d, t in plain(docs, "doc_id", "text")}
    for name, stage in pipeline.STAGES[:-1]:
        result = stored(stage(spark, docs, SF2), name)
        assert result.columns == columns
        ids = [r.doc_id for r in result.select("doc_id").collect()]
        assert set(ids) <= set(kept)
        if name == "quality_classifier":
            scored = quality.score(docs, quality.fit(docs, table(spark, SF2, "labels")))
            want = [r.doc_id for r in scored.where("score >= 0.7").collect()]
        elif name == "simhash_near_dedup":
            want = list({r.component_id for r in simhash.near_duplicates(docs).collect()})
        elif name == "benchmark_decontamination":
            found = decontaminate.find_contamination(docs, table(spark, SF2, "benchmark"))
            want = [r.doc_id for r in found.where("NOT contamination.contaminated").collect()]
        else:
            want = [r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.copies)]
        assert sorted(ids) == sorted(want) and len(want) > 100
        docs = result
    final = pipeline.token_output(spark, docs, SF2)
    rows = plain(docs.orderBy("doc_id"), "doc_id", "text")
    assert sorted(plain(final, "doc_id", "start", "n_tokens", "ids_crc32")) == sorted(expected(rows))


def test_edges(spark):
    for docs in (edge_docs(spark), no_docs(spark)):
        for name, stage in pipeline.STAGES:
            result = stored(stage(spark, docs, SF2), name)
            assert result.count() <= 2 * max(docs.count(), 1)
            if name != "token_output":
                assert result.columns == docs.columns
                docs = result


def spark_hash(doc_id, body):
    """xxhash64 of an id and a body as Spark gives it, signed."""
    h = xxhash.xxh64_intdigest(body, xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42))
    return h - (1 << 64) if h >> 63 else h


def plain_quality(texts, labels):
    """Ids that the classifier accepts, learned and scored row by row."""
    marks = {}
    for d, q in labels:
        if d is not None and q is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            marks.setdefault(d, []).append(q)
    known = sorted((spark_hash(d, t.encode()), d) for d, t in texts.items() if d in marks)
    hasher, data = NgramHasher(18), []
    for _, d in known:
        index, value = hasher.row(texts[d].encode())
        data.append((np.append(index, 1 << 18), np.append(value, 1.0), int(sum(marks[d]) >= 0.5 * len(marks[d]))))
    w = Ftrl(1 << 18, alpha=1.0, l1=0.05, l2=0.1).fit(data, 5).astype(np.float32)
    scores = {}
    for d, t in texts.items():
        index, value = hasher.row(t.encode())
        scores[d] = sigmoid(float(w[index].astype(np.float64) @ value) + float(w[-1]))
    assert min(abs(s - 0.7) for s in scores.values()) > 1e-5
    return {d for d, s in scores.items() if s >= 0.7}


def test_run_against_a_plain_chain(spark, tmp_path):
    docs = table(spark, SF2, "documents").where("doc_id < 240").coalesce(2)
    sample = [r for r in docs.orderBy("doc_id").collect() if r.text]
    items = plain(table(spark, SF2, "benchmark").orderBy("item_id").limit(15), "item_id", "text")
    # Planted into good documents: a passage of the benchmark, and near copies.
    good = sorted({r.doc_id for r in table(spark, SF2, "labels").where("quality = 1").collect()} & {r.doc_id for r in sample})
    rows = {r.doc_id: r.asDict() for r in sample}
    whole = next(t for _, t in items if len(t.split()) >= 20)
    for d in good[:6]:
        rows[d]["text"] += "\n" + " ".join([whole] * 3)
    for k, d in enumerate(good[6:16]):
        rows[9000 + k] = {**rows[d], "doc_id": 9000 + k}
    folder = str(tmp_path)
    spark.createDataFrame(list(rows.values()), docs.schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, table(spark, SF2, "benchmark").select("item_id", "text").schema).write.parquet(f"{folder}/benchmark.parquet")
    table(spark, SF2, "labels").write.parquet(f"{folder}/labels.parquet")

    texts = {d: r["text"] for d, r in rows.items()}
    kept = plain_quality(texts, plain(table(spark, SF2, "labels"), "doc_id", "quality"))
    roots, first = {d: brute_fp(texts[d]) for d in kept}, {}
    group = brute_groups(roots.values())
    for d in sorted(kept):
        first.setdefault(group[roots[d]], d)
    alone = set(first.values())
    clean = {d for d in alone if not contaminated(texts[d], items)[4]}
    assert len(rows) > len(kept) > len(alone) > len(clean) > 30

    mixed = mixing.mix(spark.createDataFrame([rows[d] for d in sorted(clean)], docs.schema)).collect()
    for taken, want, most in check(mixed, lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]))).values():
        assert abs(taken - want) <= most
    ids = sorted(r.doc_id for r in mixed for _ in range(r.copies))
    got = plain(pipeline.run(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(got) == sorted(expected([(d, texts[d]) for d in ids]))


def test_scratch_goes_when_the_result_is_consumed(spark):
    """What the operators store is gone at the end of the block in which their result is read."""
    import os

    from dealscope.llm.queries import op6_suffix_dedup, op8_token_output
    from dealscope.session import ensure_checkpoint_dir, scratch
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    with scratch(spark):
        for query in (op6_suffix_dedup, op8_token_output):
            assert query(spark, SF2).count() > 0
        assert len(set(os.listdir(base)) - before) >= 3
    left = set(os.listdir(base)) - before
    assert not [name for name in left if name.startswith(("suffix", "tokens"))]
