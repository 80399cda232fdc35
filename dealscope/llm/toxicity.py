"""Toxicity (operator 3): a classifier chain over hashed word and word-prefix features.

The chain predicts its categories one after the other; each linear model also gets the
probabilities of all earlier categories.  For training these are out-of-fold predictions: every
training row's probability comes from a model that did not see the row.  The labels hold one
toxicity flag; its categories are the flag within each language of the training documents (in
name order) and, last, the flag itself, which is the verdict.  Beyond ``MAX_GROUPS`` languages those
with fewer positive rows share one category, so that the model's size has a bound.  Folds go by a hash
of the text alone, so equal texts under different ids are never on both sides.

Training takes labelled documents whose crc32(doc_id) mod 4 is not 2 and of these a hash
sample of about ``max_rows`` (a documented bound; only the fit is sampled).  Each round of the
chain fits its folds and its final model as parallel tasks over the sample's features.
Every document is scored over its whole text.

Edge cases: NULL and empty texts score by the bias; documents without an id are scored but never
trained on; NULL labels are ignored, contradicting labels of one id count by their mean; without
positive labels nothing is toxic; repeated rows train once and are scored each; an empty table
gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, stored, utf8
from dealscope.llm.linear import Ftrl, sigmoid
from dealscope.llm.quality import is_held_out, training_labels

MAX_ROWS = 10_000
BITS = 19
FOLDS = 3
EPOCHS = 6
MAX_GROUPS = 12         # categories beside the rest and the flag itself; each has a row of weights
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
_CACHE_WORDS = 300_000
_PARAMS = dict(alpha=1.0, l1=10.0, l2=0.1)
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def words_of(text: bytes) -> set[bytes]:
    """Distinct words of a text: runs of ASCII letters and non-ASCII characters, A-Z lowered."""
    return set(_WORD.findall(text.lower()))


def columns_of(word: bytes) -> list[int]:
    """Hashed columns of a word: itself and its prefixes of 4 to 6 characters."""
    chars = word.decode("utf-8", "replace")
    keys = [b"w" + word, *(b"%d" % k + chars[:k].encode() for k in PREFIXES if len(chars) > k)]
    return [xxhash.xxh64_intdigest(k) >> (64 - BITS) for k in keys]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Columns of a text and how many of its distinct words have each."""
    found = [c for w in words_of(text) for c in columns_of(w)]
    return np.unique(np.array(found, np.int64), return_counts=True)


@dataclass
class Chain:
    """Category names and their weights: per category the hashed columns, one input for each
    category of the chain (only earlier ones are used), the bias."""
    names: list[str]
    weights: np.ndarray

    def scores(self, hashed: np.ndarray) -> np.ndarray:
        """Probabilities from the sums of the hashed columns' weights (category by category)."""
        n = len(self.names)
        p = np.zeros(n)
        for j in range(n):
            w = self.weights[j]
            p[j] = sigmoid(hashed[j] + w[1 << BITS:(1 << BITS) + j] @ p[:j] + w[-1])
        return p


def _fit_round(rows: DataFrame, j: int, n: int) -> DataFrame:
    """Models of category j: per fold the predictions (at, p) of its rows by a model of the other
    folds, and the weights (columns, weights) of the model of all rows."""
    size = 1 << BITS

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        fold = int(pdf["task"].iloc[0])
        data = []
        for columns, counts, earlier in zip(pdf["columns"], pdf["counts"], pdf["earlier"]):
            dense = np.asarray(earlier, float)
            data.append((np.concatenate((columns, size + np.arange(len(dense)), [size + n])).astype(np.int64),
                         np.concatenate((counts, dense, [1.0])).astype(float)))
        label, outside = np.array([y[j] for y in pdf["labels"]]), pdf["fold"].to_numpy() != fold
        model = Ftrl(size, n, **_PARAMS)
        chosen = [(*data[k], label[k]) for k in np.flatnonzero(outside)]
        w = model.fit(chosen, EPOCHS)
        if fold == FOLDS:
            used = np.flatnonzero(w)
            return pd.DataFrame({"at": pd.array([pd.NA], "Int64"), "p": [0.0], "columns": pd.Series([used], dtype="object"),
                                 "weights": pd.Series([w[used]], dtype="object")})
        inside = np.flatnonzero(~outside)
        return pd.DataFrame({"at": pd.array(pdf["at"].to_numpy()[inside], "Int64"),
                             "p": [float(sigmoid(w[data[k][0]] @ data[k][1])) for k in inside],
                             "columns": pd.Series([None] * len(inside), dtype="object"),
                             "weights": pd.Series([None] * len(inside), dtype="object")})

    tasks = rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
    return tasks.groupBy("task").applyInPandas(fit, "at bigint, p double, columns array<bigint>, weights array<double>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", group_col: str = "lang", max_rows: int = MAX_ROWS) -> Chain:
    """The chain for ``label_col`` within each value of ``group_col`` (values with a positive
    training label; beyond ``MAX_GROUPS`` the rest together) and overall."""
    session_of(docs)
    known = training_labels(labels, label_col, max_rows)
    # About max_rows pairs of numbers at most: a bounded broadcast.
    rows = docs.select("doc_id", utf8("text").alias("body"), F.col(group_col).alias("grp")).join(F.broadcast(known), "doc_id")

    def hashed(bodies: pd.Series) -> pd.DataFrame:
        found = [features(b) for b in bodies]
        return pd.DataFrame({"columns": pd.Series([c for c, _ in found], dtype="object"),
                             "counts": pd.Series([n for _, n in found], dtype="object")})

    fold = F.pmod(F.shiftright(F.xxhash64("body"), 20), F.lit(FOLDS)).cast("int")
    rows = rows.select(F.xxhash64("doc_id", "body").alias("at"), fold.alias("fold"), "grp", "label",
                       F.pandas_udf(hashed, "columns array<bigint>, counts array<bigint>")("body").alias("f"))
    rows = stored(rows.select("at", "fold", "grp", "label", "f.*").dropDuplicates(["at"]), "toxicity-rows")
    positives = rows.where("label = 1 AND grp IS NOT NULL").groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()
    ranked = [r.grp for r in sorted(positives, key=lambda r: (-r.n, r.grp))]
    groups = sorted(ranked[:MAX_GROUPS])
    names = [f"{label_col}_{g}" for g in groups]
    flags = [(F.col("label") == 1) & F.col("grp").eqNullSafe(g) for g in groups]
    if len(ranked) > MAX_GROUPS:
        rest = f"{label_col}_(rest)"
        while rest in names:
            rest += "_"
        names.append(rest)
        flags.append(F.coalesce((F.col("label") == 1) & ~F.col("grp").isin(groups), F.lit(False)))
    names.append(label_col)
    flags.append(F.col("label") == 1)
    rows = rows.select("at", "columns", "counts", F.array(*[f.cast("int") for f in flags]).alias("labels"),
                       "fold", F.array().cast("array<double>").alias("earlier"))
    weights = np.zeros((len(names), (1 << BITS) + len(names) + 1), np.float32)
    for j in range(len(names)):
        round_ = stored(_fit_round(rows, j, len(names)), "toxicity-round")
        for r in round_.where("at IS NULL").collect():
            weights[j, r["columns"]] = r["weights"]
        if j + 1 < len(names):
            rows = rows.join(round_.where("at IS NOT NULL").select("at", "p"), "at") \
                       .withColumn("earlier", F.array_append("earlier", F.col("p"))).drop("p")
    return Chain(names, weights)


def score(docs: DataFrame, chain: Chain, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with column ``out``: the probabilities in the chain's order."""
    shared = session_of(docs).sparkContext.broadcast(chain)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, cache = shared.value, {}
        for bodies in batches:
            found = []
            for body in bodies:
                total = np.zeros(len(model.names))
                for w in words_of(body):
                    share = cache.get(w)
                    if share is None:
                        if len(cache) > _CACHE_WORDS:
                            cache.clear()
                        share = model.weights[:, columns_of(w)].sum(axis=1, dtype=float)
                        share = cache[w] = share if share.any() else False
                    if share is not False:
                        total += share
                found.append(model.scores(total).tolist())
            yield pd.Series(found, dtype="object")

    return docs.withColumn(out, F.pandas_udf(scored, "array<double>")(utf8(text_col)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (toxic), predicted, and the probabilities of all categories."""
    chain = fit(docs, labels)
    rows = score(docs.select("doc_id", "text"), chain)
    verdict = F.element_at("toxicity", -1)
    categories = F.map_from_arrays(F.array(*map(F.lit, chain.names)), F.col("toxicity"))
    return rows.select("doc_id", is_held_out().alias("held_out"), verdict.alias("score"),
                       (verdict >= THRESHOLD).cast("int").alias("predicted"), F.to_json(categories).alias("categories"))
