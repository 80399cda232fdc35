"""SimHash near-duplicates (operator 5) by the generalised pigeonhole principle.

Fingerprints: 64 bits over word shingles; a bit is 1 if set in more than half of the shingle
hashes.  Two fingerprints at ``radius`` differing bits or fewer are linked; documents in one
connected component form a group.

Search, over the distinct fingerprints:

1. Bit statistics (ones, and ones shared by each pair of bits) are summed over all
   fingerprints.  Correlated bits go into the same of ``m`` partitions.
2. Per partition and threshold t the expected number of candidates is estimated: chance that
   two random fingerprints differ in at most t bits of the partition, along a chain of its bits.
3. Dynamic programming allocates thresholds t_1 .. t_m >= -1 with sum radius - m + 1 (the
   general pigeonhole principle: two fingerprints within the radius agree up to t_i bits in
   some partition i) at the least estimated cost, for every m; the cheapest m wins.
4. Each fingerprint goes to the bucket of its own value in each partition, and to those of
   its neighbours within t_i as a probe; buckets compare and verify on all 64 bits.  A bucket
   emits a spanning forest of its links, never all its pairs.  Buckets of over
   ``BLOCK`` members are cut into blocks, every pair of blocks compared in a task of its own.
5. Connected components of the links, by alternating star contractions.

Edge cases: NULL and empty texts have fingerprint 0 and are linked like any other; exact copies
share a fingerprint and cost one; NULL ids belong to their group but never name it (a group of
NULL ids only has a NULL component); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm.common import fresh, session_of, stored, utf8, width
from dealscope.session import materialize

RADIUS = 3
SHINGLE = 3
BLOCK = 4096            # members of a bucket compared in one go
PAIR_COST, PROBE_COST = 1.0, 64.0      # a compared pair of numbers, a shuffled and sorted row
_U64 = (1 << 64) - 1
_BIT = np.uint64(1) << np.arange(64, dtype=np.uint64)


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text (UTF-8), A-Z in lower case, words joined by one space."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-shingle].tolist()]
        h = xxhash.xxh64_intdigest
        hashes = [h(line[a:b], 42) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at:at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BIT[2 * ones > len(hashes)].sum())


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit column."""

    session_of(docs)

    def hashed(bodies: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(b, shingle) for b in bodies], np.uint64).view(np.int64))

    return docs.withColumn(out, F.pandas_udf(hashed, "bigint")(utf8(text_col)))


# ---------------------------------------------------------------- plan of the search

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 matrix of ones shared by each pair of bits."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared, n = np.zeros((64, 64)), 0
        for pdf in batches:
            bits = np.unpackbits(pdf["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            for at in range(0, len(bits), 1 << 14):     # exact in float32
                shared += bits[at:at + (1 << 14)].T @ bits[at:at + (1 << 14)]
            n += len(bits)
        if n:
            yield pd.DataFrame({"cell": np.arange(4096), "both": shared.ravel(), "n": n})

    rows = fps.select("fp").mapInPandas(counts, "cell int, both double, n bigint") \
              .groupBy("cell").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect()
    shared, n = np.zeros(4096), 0
    for r in rows:
        shared[r.cell], n = r.both, r.n
    return n, shared.reshape(64, 64)


def _agreement(n: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance that two random fingerprints agree on bit i; that they agree on both of i, j;
    that they differ on both."""
    p = shared.diagonal() / n
    p11 = shared / n
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    return p * p + (1 - p) ** 2, p11 ** 2 + p10 ** 2 + p01 ** 2 + p00 ** 2, 2 * (p11 * p00 + p10 * p01)


def group_bits(n: int, shared: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in ``m`` partitions of nearly equal size, correlated bits together: each
    partition starts at the bit left with the strongest correlation and grows by the bit most
    correlated with its members, which also gives the order of its chain."""
    p = shared.diagonal() / n
    dev = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(shared / n - np.outer(p, p)) / np.outer(dev, dev)
    np.fill_diagonal(corr, 0)
    left, parts = list(range(64)), []
    for k in range(m):
        size = 64 // m + (k < 64 % m)
        start = max(left, key=lambda b: (corr[b, left].max(), -b))
        part = [start]
        left.remove(start)
        while len(part) < size:
            nxt = max(left, key=lambda b: (corr[b, part].max(), -b))
            part.append(nxt)
            left.remove(nxt)
        parts.append(part)
    return parts


def candidate_shares(part: list[int], n: int, shared: np.ndarray, radius: int) -> list[float]:
    """Estimated chance, for t = 0 .. radius, that two random fingerprints differ in at most t
    bits of the partition: a Markov chain of agreement along its bits."""
    same, both_same, both_differ = _agreement(n, shared)
    agree, differ = np.zeros(radius + 1), np.zeros(radius + 1)   # by the bits that differ so far
    agree[0], differ[1 if radius else 0] = same[part[0]], 1 - same[part[0]] if radius else 0
    for a, b in zip(part, part[1:]):
        stay = both_same[a, b] / max(same[a], 1e-300)
        cross = 1 - stay
        flip_stay = both_differ[a, b] / max(1 - same[a], 1e-300) if same[a] < 1 else 0.0
        agree, was = agree * stay + differ * (1 - flip_stay), agree
        gone = np.zeros(radius + 1)
        gone[1:] = (was * cross + differ * flip_stay)[:-1]
        differ = gone
    return list(np.cumsum(agree + differ))


def allocate(shares: list[list[float]], sizes: list[int], n: int, radius: int) -> tuple[float, list[int]]:
    """Thresholds (>= -1, sum radius - m + 1) of least estimated cost per fingerprint: probes
    sent plus candidates met, by dynamic programming over partitions and the sum so far."""
    m = len(shares)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for share, size in zip(shares, sizes):
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                extra = 0.0
                if t >= 0:
                    extra = PROBE_COST * sum(_choose(size, k) for k in range(t + 1)) + PAIR_COST * n * share[t]
                if total + t not in step or cost + extra < step[total + t][0]:
                    step[total + t] = (cost + extra, [*chosen, t])
        best = step
    return best[radius - m + 1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def plan_search(n: int, shared: np.ndarray, radius: int = RADIUS) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds of the cheapest m from 1 to radius + 1."""
    options = []
    for m in range(1, radius + 2):
        parts = group_bits(n, shared, m)
        cost, thresholds = allocate([candidate_shares(p, n, shared, radius) for p in parts], [len(p) for p in parts], n, radius)
        options.append((cost, -m, parts, thresholds))
    _, _, parts, thresholds = min(options, key=lambda o: o[:2])
    return parts, thresholds


# ---------------------------------------------------------------- probe and verify

def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest member) of each of n nodes under links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a - b between positions of ``fp`` as member - representative pairs of values."""
    nodes, at = np.unique(np.concatenate((fp[a], fp[b])), return_inverse=True)
    root = _roots(len(nodes), at[:len(a)], at[len(a):])
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= radius


def _bucket_links(key: np.ndarray, fp: np.ndarray, data: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal key (rows sorted by key): all pairs of data rows, and each
    data row with each probe.  Runs that are small are compared by shifting all rows at once,
    large ones row by row against the rest of the run.  Runs of probes alone are left out."""
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    live = np.repeat(np.logical_or.reduceat(data, starts), np.diff(starts, append=len(key)))
    if not live.all():
        at = np.flatnonzero(live)
        a, b = _bucket_links(key[at], fp[at], data[at], radius)
        return at[a], at[b]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    length = np.diff(edge)
    end = np.repeat(edge[1:], length)
    outs_a, outs_b = [], []
    small = np.repeat(length <= 64, length)
    at = np.flatnonzero(small)
    lag = 1
    while True:
        at = at[at + lag < end[at]]
        if not len(at):
            break
        other = at + lag
        hit = _near(fp[at], fp[other], radius) & (data[at] | data[other])
        outs_a.append(at[hit])
        outs_b.append(other[hit])
        lag += 1
    for s, e in zip(edge[:-1][length > 64], edge[1:][length > 64]):
        found_a, found_b, size = [], [], 0
        for i in range(s, e - 1):
            j = np.flatnonzero(_near(fp[i], fp[i + 1:e], radius) & (data[i] | data[i + 1:e])) + i + 1
            if len(j):
                found_a.append(np.full(len(j), i))
                found_b.append(j)
                size += len(j)
            if size > 1 << 20:              # keep a forest of what was found so far
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                root = _roots(e - s, a - s, b - s)
                keep = np.flatnonzero(root != np.arange(e - s))
                found_a, found_b, size = [keep + s], [root[keep] + s], len(keep)
        if found_a:
            outs_a += found_a
            outs_b += found_b
    if not outs_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(outs_a), np.concatenate(outs_b)


def _packed(fp: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(part):
        out |= (fp >> np.uint64(b) & np.uint64(1)) << np.uint64(k)
    return out


def cut_buckets(rows: DataFrame, block: int) -> DataFrame:
    """key, fp, data: the rows of each bucket (part, value), of large buckets once for each pair of
    blocks; large buckets without a data row, which have no links, are dropped."""
    sizes = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("members"), F.max("data").alias("any")) \
                .where(F.col("members") > block)
    # At most rows / block keys; a shuffle join all the same, it needs no bound.
    rows = rows.join(sizes, ["part", "value"], "left").where(F.coalesce("any", F.lit(True)))
    blocks = F.ceil(F.coalesce("members", F.lit(1)) / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = rows.select("part", "value", "fp", "data", own.alias("own"), other.alias("other")) \
               .select("part", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp", "data")
    return rows.select(F.xxhash64("part", "value", "low", "high").alias("key"), "fp", "data")


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links a, b (a > b) that connect every two distinct fingerprints within the radius:
    spanning forests of the links found in each bucket."""
    spark = session_of(fps)
    n, shared = bit_statistics(fps)
    if n < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    parts, thresholds = plan_search(n, shared, radius)

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1 << 13):
                fp = pdf["fp"].to_numpy()[at:at + (1 << 13)].astype(np.int64).view(np.uint64)
                for k, (part, t) in enumerate(zip(parts, thresholds)):
                    if t < 0:
                        continue
                    value = _packed(fp, part)
                    tag = np.full(len(fp), k, np.int32)
                    yield pd.DataFrame({"part": tag, "value": value.view(np.int64), "fp": fp.view(np.int64), "data": True})
                    for d in range(1, t + 1):
                        for bits in combinations(range(len(part)), d):
                            flip = np.uint64(sum(1 << b for b in bits))
                            # Of two that differ in these bits one has the first of them set: it probes.
                            sent = value >> np.uint64(bits[0]) & np.uint64(1) == 1
                            yield pd.DataFrame({"part": tag[sent], "value": (value[sent] ^ flip).view(np.int64),
                                                "fp": fp[sent].view(np.int64), "data": False})

    rows = stored(fps.select("fp").mapInPandas(probes, "part int, value bigint, fp bigint, data boolean"), "simhash-probes")
    rows = cut_buckets(rows, block).repartition(width(spark), "key").sortWithinPartitions("key")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf if rest is None else pd.concat((rest, pdf), ignore_index=True)
            key = pdf["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            rest, done = pdf.iloc[cut:], pdf.iloc[:cut]
            yield linked(done)
        if rest is not None:
            yield linked(rest)

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().astype(np.int64).view(np.uint64)
        a, b = _bucket_links(pdf["key"].to_numpy(), fp, pdf["data"].to_numpy().astype(bool), radius) if len(fp) else ([], [])
        if not len(a):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        x, y = _forest(fp.view(np.int64), a, b)
        return pd.DataFrame({"a": np.maximum(x, y), "b": np.minimum(x, y)})

    return rows.select("key", "fp", "data").mapInPandas(compare, "a bigint, b bigint").distinct()


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of the links (a > b), by
    alternating large-star and small-star steps until nothing changes."""
    edges = materialize(edges)
    state = None
    while True:
        # Large star: each node links its larger neighbours to its smallest one.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: each node links its smaller neighbours and itself to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = materialize(small.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
                            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fp, body_hash (a hash of the text, to tell documents of one
    id apart), component_id (smallest doc_id of its group) and root (the group's own key)."""
    rows = fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle=shingle)
    rows = stored(rows.select("doc_id", "fp", F.xxhash64(utf8("text")).alias("body_hash")), "simhash")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(fps, radius))
    named = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    first = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(first, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return rows.join(named, F.col("fp") == F.col("_fp"), "left").drop("_fp")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with its own columns: the smallest id (NULL last), of equal
    ids the smallest text hash."""
    groups = stored(near_duplicates(docs, id_col, text_col), "simhash-groups")
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body_hash")).alias("best"))
    doc, text_hash, body, rank = (fresh(docs, n) for n in ("_sim_id", "_sim_hash", "_sim_body", "_sim_rank"))
    best = best.select(F.col("best.doc_id").alias(doc), F.col("best.body_hash").alias(text_hash))
    kept = docs.withColumn(body, F.xxhash64(utf8(text_col)))
    kept = kept.join(best, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(body) == F.col(text_hash)), "left_semi")
    if not groups.groupBy("doc_id", "body_hash").count().where("count > 1").isEmpty():    # repeated rows: one of them
        kept = kept.withColumn(rank, F.row_number().over(Window.partitionBy(id_col, body).orderBy(body))).where(F.col(rank) == 1)
    return kept.select(*docs.columns)
