"""Mixing sources to target weights (operator 4) by entropy balancing.

Every document i gets a rate r_i, its expected copies, closest to 1 in relative entropy
(minimising the sum of r log r - r) subject to the words of each source meeting its target
and r_i <= CAP.  The optimum is an exponential tilt r_i = min(CAP, exp(lambda_s * size_i /
scale_s)); the dual variables lambda come from distributed Newton iterations over the
(source, size) histogram, kept inside a bracket.  Steps that have not met a target after
``NEWTON_STEPS`` halve the bracket instead, which meets any target; a mix that is still open after
``MAX_STEPS`` fails rather than being rounded.  A source whose target is CAP times its size
takes CAP copies of everything.  Rates are then rounded into whole copies: cells of equal
source and size are visited from the largest size down and each takes the whole number of
extra copies that leaves the smallest error in words, which the next cell carries on; within
a cell a hash order chooses the documents, so that reruns agree.

Nothing of corpus size meets in one task: all work is on aggregates per (source, size); a
source has at most sqrt(2 * words) different sizes.  Cells of many documents are split into
hash buckets of about ``BUCKET_ROWS``, each rounding its own share.

Edge cases: a NULL or empty text has size 0 and is taken once at rate 1, adding no words; a
NULL source is a source of its own, ordered last; sources without words get target 0; repeated
rows count each; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm.common import fresh, session_of, stored, utf8
from dealscope.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5             # words of the mix per word of the input
CAP = 2                 # copies of a document, and target per word of a source
TOLERANCE = 1e-6
NEWTON_STEPS = 40
MAX_STEPS = 160
BUCKET_ROWS = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(_WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, target from (source, source_size): weights by the sources' code
    point order, ``share`` of all words in proportion, cut at ``cap`` times a source's size
    and the excess shared again by weight until nothing is above.

    A source is cut once the level (words per unit of weight) passes cap * size / weight, so
    the level is found by one pass over the sources in that order.
    """
    # One row per source from here on; Spark's string order is code point order.
    name = (F.col("source").isNull(), F.col("source"))
    by_name = Window.orderBy(*name)
    k = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    s = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (k + 1).cast("int")).cast("double"))
    s = s.withColumn("bend", cap * F.col("source_size") / F.col("weight"))
    up_to = Window.orderBy("bend", *name).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    s = s.withColumn("cut_words", F.sum(cap * F.col("source_size")).over(up_to)) \
         .withColumn("free_weight", F.sum("weight").over(everything) - F.sum("weight").over(up_to)) \
         .withColumn("all", F.sum("source_size").over(everything) * share)
    # The words shared grow with the level along a concave broken line; the line through each
    # of its pieces meets the goal at or before the true level, and the true piece meets it there.
    s = s.withColumn("level", F.when(F.col("free_weight") > 0, (F.col("all") - F.col("cut_words")) / F.col("free_weight")))
    start = F.col("all") / F.sum("weight").over(everything)
    s = s.withColumn("water", F.greatest(start, F.max("level").over(everything)))
    return s.select("source", "source_size", F.least(cap * F.col("source_size").cast("double"), F.col("water") * F.col("weight")).alias("target"))


def balance(cells: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """source, source_size, target, scale, lam: the dual variable of each source by Newton
    steps, all sources at once; each step is one aggregation over the (source, size, n) cells."""
    stats = cells.groupBy("source").agg(
        F.try_divide(F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")), F.sum(F.col("n") * F.col("size"))).alias("scale"))
    full = F.col("target") >= cap * F.col("source_size")
    state = goals.join(stats.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    state = state.select("source", "source_size", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"),
                         F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
                         F.lit(None).cast("double").alias("high"),
                         (full | (F.col("source_size") == 0)).alias("done"))
    state = materialize(state)
    z = F.col("size") / F.col("scale")
    tilt = F.exp(F.least(F.col("lam") * z, F.lit(50.0)))
    for step in range(MAX_STEPS):
        open_ = state.where(~F.col("done")).withColumnRenamed("source", "_s")
        sums = (cells.join(open_, F.col("source").eqNullSafe(F.col("_s")))
                .groupBy("source").agg(
                    F.sum(F.col("n") * F.col("size") * F.least(tilt, F.lit(float(cap)))).alias("have"),
                    F.sum(F.when(tilt < cap, F.col("n") * F.col("size") * z * tilt).otherwise(0.0)).alias("slope"))
                .withColumnRenamed("source", "_s"))
        gap = F.col("have") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        inside = F.lit(step < NEWTON_STEPS) & (F.col("slope") > 0) & (F.col("low").isNull() | (newton > F.col("low"))) \
            & (F.col("high").isNull() | (newton < F.col("high")))
        middle = F.when(F.col("low").isNull(), F.col("high") * 2 - 1).when(F.col("high").isNull(), F.col("low") * 2 + 1) \
                  .otherwise((F.col("low") + F.col("high")) / 2)
        met = F.abs(gap) <= TOLERANCE * F.col("target")
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
        moved = moved.withColumn("low", low).withColumn("high", high).withColumn("met", F.coalesce(met, F.lit(False)))
        moved = moved.withColumn("lam", F.when(F.col("done") | F.col("met"), F.col("lam")).otherwise(F.when(inside, newton).otherwise(middle)))
        state = materialize(moved.withColumn("done", F.col("done") | F.col("met")).select(*state.columns))
        if state.where(~F.col("done")).isEmpty():
            return state.select("source", "source_size", "target", "scale", "lam")
    raise RuntimeError(f"entropy balancing has not met every target after {MAX_STEPS} steps")


def rates(cells: DataFrame, duals: DataFrame, cap: int = CAP) -> DataFrame:
    """The cells with their source's size and target and the rate of their documents."""
    d = duals.withColumnRenamed("source", "_s")
    tilt = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(50.0))))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("target") >= cap * F.col("source_size"), float(cap)).otherwise(tilt)
    return cells.join(d, F.col("source").eqNullSafe(F.col("_s"))) \
                .select("source", "size", "n", "source_size", "target", rate.alias("rate"))


def _carried(pdf: pd.DataFrame) -> pd.DataFrame:
    """Extra copies per cell of one source, largest size first, the error in words carried on."""
    pdf = pdf.sort_values("size", ascending=False)
    whole, extra, error = np.floor(pdf["rate"].to_numpy()), np.zeros(len(pdf), np.int64), 0.0
    part = pdf["rate"].to_numpy() - whole
    for i, (size, n, f) in enumerate(zip(pdf["size"], pdf["n"], part)):
        if size and f > 0:
            want = error + size * n * f
            extra[i] = min(n, max(0, round(want / size)))
            error = want - size * int(extra[i])
    return pdf.assign(whole=whole.astype(np.int64), extra=extra)


def rounded(cells: DataFrame) -> DataFrame:
    """The cells with ``whole`` copies of every document and ``extra`` documents with one more."""
    schema = ", ".join(f"{n} {t}" for n, t in cells.dtypes) + ", whole bigint, extra bigint"
    return cells.groupBy("source").applyInPandas(_carried, schema)


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, rate, copies, taken, and
    ``body_hash``, a hash of the text that tells documents of one id apart."""
    session_of(docs)
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               word_count(text_col).alias("size"), F.xxhash64(utf8(text_col)).alias("body_hash")), "mixing")
    cells = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = rounded(rates(cells, balance(cells, materialize(targets(sources)))))
    plan = materialize(plan).withColumnRenamed("source", "_s").withColumnRenamed("size", "_size")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_size")), "left")
    order = F.xxhash64("doc_id", "body_hash", "size")
    buckets = F.ceil(F.col("n") / BUCKET_ROWS)
    rows = rows.withColumn("order", order).withColumn("bucket", F.pmod(F.shiftright("order", 8), buckets))
    # Documents of a cell or one of its buckets in hash order; whole cells take exactly ``extra``.
    inside = Window.partitionBy("source", "size", "bucket")
    share = F.col("extra") * F.count(F.lit(1)).over(inside) / F.col("n")
    dither = F.when(F.col("extra") == F.col("n"), 0.0).when(buckets == 1, 0.5) \
              .otherwise(F.pmod(F.xxhash64("source", "size", "bucket"), F.lit(1 << 20)) / float(1 << 20))
    rank = F.row_number().over(inside.orderBy("order", "doc_id", "body_hash"))
    copies = F.col("whole") + F.when(rank <= F.floor(share + dither), 1).otherwise(0)
    return rows.withColumn("copies", copies.cast("int")).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), "body_hash")


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The documents repeated as often as the mix takes them, with their own columns.  Rows
    equal in id, source and text share one decision."""
    names = [fresh(docs, f"_mix_{n}") for n in ("id", "source", "hash", "copies", "body")]
    doc, source, text_hash, copies, body = names
    plan = mix(docs, text_col, source_col, id_col).groupBy(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("body_hash").alias(text_hash)) \
        .agg(F.max("copies").alias(copies))
    rows = docs.withColumn(body, F.xxhash64(utf8(text_col)))
    rows = rows.join(plan, F.col(id_col).eqNullSafe(F.col(doc)) & F.col(source_col).eqNullSafe(F.col(source))
                     & (F.col(body) == F.col(text_hash)), "left")
    return rows.where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
