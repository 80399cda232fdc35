import math
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from dealscope.llm import toxicity
from dealscope.llm.quality import training_labels

from .helpers import SF, edge_docs, no_docs, table


def corpus(spark, n=900):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(("en", "de"))
        text = [f"{lang}{rng.randrange(300)}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(("idiotes", "scumish")) if lang == "en" else "blödheit" + rng.choice("abcdef")
        docs.append((i, " ".join(text), lang))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_chain_finds_held_out_toxic_documents(spark):
    docs, labels = corpus(spark)
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert all(r.predicted == r.toxic for r in rows if r.toxic == 0)
    assert sum(r.predicted for r in rows if r.toxic) >= 0.95 * sum(r.toxic for r in rows)
    assert '"toxic_de"' in rows[0].categories and '"toxic_en"' in rows[0].categories


def test_scores_chain_earlier_categories():
    n = 2
    w = np.zeros((n, (1 << toxicity.BITS) + n + 1))
    w[0, -1], w[1, 1 << toxicity.BITS] = 1.0, 4.0
    p = toxicity.Chain(["a", "b"], w).scores(np.array([0.5, -1.0]))
    first = 1 / (1 + np.exp(-1.5))
    assert np.allclose(p, [first, 1 / (1 + np.exp(-(4 * first - 1)))])


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (9, 1), (10, 0)], "doc_id bigint, toxic int")
    docs = edge_docs(spark)
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.classify(no_docs(spark), labels).collect() == []
    none = toxicity.classify(docs, labels.where("toxic = 0"))
    assert all(r.predicted == 0 for r in none.collect())


class PlainFtrl:
    """The update rule feature by feature, over dictionaries; ``free``: inputs without penalties."""

    def __init__(self, free, alpha=1.0, beta=1.0, l1=10.0, l2=0.1):
        self.free, self.alpha, self.beta, self.l1, self.l2 = free, alpha, beta, l1, l2
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, i):
        l1, l2 = (0.0, 0.0) if i in self.free else (self.l1, self.l2)
        z = self.z[i]
        if abs(z) <= l1:
            return 0.0
        return -(z - math.copysign(l1, z)) / ((self.beta + math.sqrt(self.n[i])) / self.alpha + l2)

    def predict(self, row):
        return 1 / (1 + math.exp(-sum(self.weight(i) * v for i, v in row.items())))

    def fit(self, rows, epochs):
        rng = np.random.default_rng(7)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                row, y = rows[k]
                error = self.predict(row) - y
                for i, v in row.items():
                    w, g = self.weight(i), error * v
                    self.z[i] += g - (math.sqrt(self.n[i] + g * g) - math.sqrt(self.n[i])) / self.alpha * w
                    self.n[i] += g * g
        return self


def test_chain_equals_a_plain_chain_on_the_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    chain = toxicity.fit(docs, labels)
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    fold = F.pmod(F.shiftright(F.xxhash64(body), 20), F.lit(3))
    found = docs.join(training_labels(labels, "toxic", toxicity.MAX_ROWS), "doc_id").select(
        F.xxhash64("doc_id", body).alias("at"), fold.alias("fold"), body.alias("body"), "lang", "label").orderBy("at").collect()
    langs = sorted({r.lang for r in found if r.label == 1 and r.lang is not None})
    assert chain.names == [*(f"toxic_{x}" for x in langs), "toxic"] and len(langs) >= 1
    rows = []
    for r in found:
        row = defaultdict(float)
        for w in toxicity.words_of(bytes(r.body)):
            for c in toxicity.columns_of(w):
                row[c] += 1.0
        rows.append(dict(row) | {"bias": 1.0})
    for j, lang in enumerate([*langs, None]):
        y = [int(r.label == 1 and (lang is None or r.lang == lang)) for r in found]
        free = {"bias", *(f"p{k}" for k in range(j))}
        outside = [None] * len(rows)
        for k in range(3):
            model = PlainFtrl(free).fit([(x, t) for x, t, r in zip(rows, y, found) if r.fold != k], toxicity.EPOCHS)
            for i, r in enumerate(found):
                if r.fold == k:
                    outside[i] = model.predict(rows[i])
        model = PlainFtrl(free).fit(list(zip(rows, y)), toxicity.EPOCHS)
        got, hashed = chain.weights[j], 1 << toxicity.BITS
        place = {"bias": len(got) - 1} | {f"p{k}": hashed + k for k in range(j)}
        want = np.zeros(len(got))
        for i in list(model.z):
            want[place.get(i, i)] = model.weight(i)
        assert np.allclose(got, want, atol=1e-4)
        for row, p in zip(rows, outside):
            row[f"p{j}"] = p


def test_equal_texts_share_a_fold_and_rare_languages_a_category(spark, monkeypatch):
    docs, labels = corpus(spark, 300)
    twins = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    labels = labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 1000))
    folds = []
    inner = toxicity._fit_round
    monkeypatch.setattr(toxicity, "_fit_round", lambda rows, j, n: folds.append(rows) or inner(rows, j, n))
    monkeypatch.setattr(toxicity, "MAX_GROUPS", 1)
    chain = toxicity.fit(twins, labels)
    assert len(chain.names) == 3 and chain.names[1:] == ["toxic_(rest)", "toxic"]
    per_text = folds[0].groupBy("columns").agg(F.countDistinct("fold").alias("folds"), F.count("*").alias("n")).collect()
    assert {r.folds for r in per_text} == {1} and max(r.n for r in per_text) == 2
    assert folds[0].select("fold").distinct().count() == 3
    both = folds[0].selectExpr("labels[0] + labels[1] = labels[2] AS ok").distinct().collect()
    assert [r.ok for r in both] == [True]
