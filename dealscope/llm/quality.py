"""Quality classifier (operator 1): hashed word n-gram logistic regression trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Training takes the labelled documents whose crc32(doc_id) mod 4 is not 2 and of these a hash
sample of about ``max_rows`` (a documented bound; only the fit is sampled).  The sample's texts become hashed
features where they are read, and these are dealt over replicas of about ``ROWS_PER_REPLICA`` rows and
``BYTES_PER_REPLICA`` of text at most; each runs FTRL over its rows in hash order, and the weights are averaged.  Only non-zero weights reach the driver.
Every document is scored over its whole text.

Edge cases: NULL and empty texts score the sigmoid of the bias; a document without an id is
scored but never trained on; NULL labels are ignored and contradicting labels of one id
count by their mean (>= 0.5: good); without usable labels every score is 0.5; an empty table
gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import fresh, session_of, utf8
from dealscope.llm.linear import Ftrl, NgramHasher, sigmoid

MAX_ROWS = 20_000
ROWS_PER_REPLICA = 5_000
BYTES_PER_REPLICA = 32 << 20        # of text; its features take some ten times that in the task
EPOCHS = 5
THRESHOLD = 0.7
_PARAMS = dict(alpha=1.0, l1=0.05, l2=0.1)
_HASH_SPAN = float(1 << 63)


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text leaves remainder 2 by 4 (false for a NULL id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, label_col: str, max_rows: int) -> DataFrame:
    """doc_id, label of a hash sample of the labelled ids outside the held-out fold."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~is_held_out())
           .groupBy("doc_id").agg(F.avg(label_col).alias("mean"))
           .select("doc_id", (F.col("mean") >= 0.5).cast("int").alias("label")))
    share = max_rows / max(ids.count(), 1)
    if share >= 1:
        return ids
    return ids.where(F.abs(F.xxhash64("doc_id") / F.lit(_HASH_SPAN)) < share)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text",
        max_rows: int = MAX_ROWS, bits: int = 18) -> np.ndarray:
    """Averaged FTRL weights (float32, bias last) over ``2 ** bits`` hashed columns."""
    session_of(docs)
    known = training_labels(labels, label_col, max_rows)
    # known holds about max_rows pairs of numbers at most: a bounded broadcast.
    rows = docs.select("doc_id", utf8(text_col).alias("body")).join(F.broadcast(known), "doc_id")
    n_rows, n_bytes = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("body"))).first()
    replicas = max(1, -(-n_rows // ROWS_PER_REPLICA), -(-(n_bytes or 0) // BYTES_PER_REPLICA))

    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = NgramHasher(bits)
        for bodies in batches:
            yield pd.DataFrame([hasher.row(body) for body in bodies], columns=["index", "value"])

    at = F.xxhash64("doc_id", "body")
    rows = rows.select("doc_id", "label", at.alias("at"), F.pmod(at, F.lit(replicas)).cast("int").alias("replica"),
                       F.pandas_udf(hashed, "index array<int>, value array<double>")("body").alias("row"))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "doc_id"], kind="stable")
        model, bias = Ftrl(1 << bits, **_PARAMS), 1 << bits
        data = [(np.append(index, bias), np.append(value, 1.0), label)
                for index, value, label in zip(pdf["index"], pdf["value"], pdf["label"])]
        weights = model.fit(data, EPOCHS)
        used = np.flatnonzero(weights)
        return pd.DataFrame({"n": [len(data)], "index": [used.astype(np.int32)], "weight": [weights[used]]})

    total, n = np.zeros((1 << bits) + 1), 0
    for r in rows.select("replica", "at", "doc_id", "label", "row.index", "row.value").groupBy("replica") \
                 .applyInPandas(train, "n bigint, index array<int>, weight array<double>").collect():
        total[r["index"]] += r["n"] * np.array(r["weight"])
        n += r["n"]
    return (total / max(n, 1)).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with column ``out``: probability of label 1."""
    shared = session_of(docs).sparkContext.broadcast(weights)
    bits = (len(weights) - 1).bit_length() - 1

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = NgramHasher(bits)
        for bodies in batches:
            yield pd.Series([sigmoid(hasher.dot(shared.value, body)) for body in bodies], dtype="float64")

    return docs.withColumn(out, F.pandas_udf(scored, "double")(utf8(text_col)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = score(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", is_held_out().alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns."""
    out = fresh(docs, "_quality")
    return score(docs, fit(docs, labels), out=out).where(F.col(out) >= THRESHOLD).select(*docs.columns)
