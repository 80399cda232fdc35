"""Line dedup (operator 10) over content-defined chunks of lines.

A rolling hash over the hashes of the last ``WINDOW`` lines ends a chunk wherever it is 0 modulo
``MODULUS``, so equal passages fall into equal chunks wherever they stand.  Chunks with at
least two lines that are not blank count.  Those whose hash occurs more than once in all
documents are fetched, compared byte by byte with the first of them (smallest document
id, text hash, position), and removed if equal; the first one stays.  That is ``kept``.

Chunks leave the ends of a repeated passage and passages without two boundaries.  ``rest`` is what
is left by the finest boundaries, every line: each two neighbouring lines that are not blank, with the
blank lines between them, are looked up and compared in the same way.  Every run of two or
more equal lines consists of such pairs, so it goes whole, wherever it begins and ends.  Of a
pair that overlaps its own first occurrence only the second line goes.

Edge cases: NULL is the empty text, one blank line; chunks of one line and single repeated lines
stay; blank lines around a run stay; rows equal in id and text share their fate; NULL ids come last in the order; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, stored, utf8

WINDOW = 2
MODULUS = 4
_MASK = (1 << 64) - 1
_PAIRS = -(1 << 31)         # number of a text's first pair of lines; chunks count from 0
_RESULT = ("n_lines bigint, n_removed_lines bigint, n_removed_chunks bigint, kept_sha256 string, kept binary, "
           "n_repeat_lines bigint, rest_sha256 string, rest binary")


def chunks(lines: list[bytes], window: int = WINDOW, modulus: int = MODULUS) -> Iterator[tuple[int, int]]:
    """Line ranges of the chunks of a text."""
    hashes = [xxhash.xxh3_64_intdigest(x) for x in lines]
    rolling = start = 0
    for i, h in enumerate(hashes):
        rolling = (rolling << 1 | rolling >> 63) & _MASK ^ h
        if i >= window:
            old, turn = hashes[i - window], window % 64
            rolling ^= (old << turn | old >> (64 - turn)) & _MASK
        if (rolling * 0x9E3779B97F4A7C15 & _MASK) >> 32 & 0xFFFF < 0x10000 // modulus:
            yield start, i + 1
            start = i + 1
    if start < len(lines):
        yield start, len(lines)


def _several(lines: list[bytes]) -> bool:
    return sum(1 for x in lines if x.strip()) >= 2


def _pairs(lines: list[bytes]) -> list[tuple[int, int]]:
    """Line ranges from each line that is not blank to the next one."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    return [(a, b + 1) for a, b in zip(full, full[1:])]


def _digests(lines: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Number, 128-bit hash (two signed numbers) of each chunk of several lines and each pair of lines."""
    found = [(k, a, b, 0) for k, (a, b) in enumerate(chunks(lines)) if _several(lines[a:b])]
    found += [(_PAIRS + k, a, b, 1) for k, (a, b) in enumerate(_pairs(lines))]
    for k, a, b, seed in found:
        d = xxhash.xxh3_128_digest(b"\n".join(lines[a:b]), seed)
        yield k, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _without_pairs(lines: list[bytes], removed: set[int]) -> list[bytes]:
    pairs, gone = _pairs(lines), set()
    for k in removed:
        a, b = pairs[k]
        if k and lines[slice(*pairs[k - 1])] == lines[a:b]:     # the pair before, if removed, takes line a itself
            a += 1
        gone.update(range(a, b))
    return [x for i, x in enumerate(lines) if i not in gone]


def _finish(data: bytes, removed: set[int], keep_text: bool) -> tuple:
    lines = data.split(b"\n")
    in_chunks, in_pairs = {k for k in removed if k >= 0}, {k - _PAIRS for k in removed if k < 0}
    left = [x for k, (a, b) in enumerate(chunks(lines)) if k not in in_chunks for x in lines[a:b]] if in_chunks else lines
    rest = _without_pairs(lines, in_pairs) if in_pairs else lines
    kept, whole = (data if x is lines else b"\n".join(x) for x in (left, rest))
    return (len(lines), len(lines) - len(left), len(in_chunks), hashlib.sha256(kept).hexdigest(), kept if keep_text else None,
            len(lines) - len(rest), hashlib.sha256(whole).hexdigest(), whole if keep_text else None)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed_lines, n_removed_chunks, kept_sha256, and
    ``kept``, the bytes that are left (NULL without ``keep_text``); n_repeat_lines, rest_sha256 and ``rest``,
    the same with every repeated run of lines removed whole."""
    session_of(docs)
    names = [c.split()[0] for c in _RESULT.split(", ")]
    rows = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("data")).withColumn("body", F.xxhash64("data"))

    def hashed(bodies: pd.Series) -> pd.Series:
        return pd.Series([[{"k": k, "h1": a, "h2": b} for k, a, b in _digests(x.split(b"\n"))] for x in bodies])

    found = F.explode(F.pandas_udf(hashed, "array<struct<k: int, h1: bigint, h2: bigint>>")("data"))
    found = stored(rows.select("doc_id", "body", found.alias("c")).select("doc_id", "body", "c.*"), "line-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body", "k")
    known = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    again = found.join(known, ["h1", "h2"])
    per_doc = again.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(
        F.collect_set(F.struct("k", "h1", "h2", (place == F.col("first")).alias("is_first"))).alias("repeats"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))

    def packed(bodies: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=3).compress
        return pd.Series([pack(b) for b in bodies])

    texts = rows.select("doc_id", "body", F.pandas_udf(packed, "binary")("data").alias("packed"))
    state = texts.join(per_doc, on, "left")

    def settle(blobs: pd.Series, repeats: pd.Series) -> pd.DataFrame:
        unpack, out = zstandard.ZstdDecompressor().decompress, []
        for blob, found in zip(blobs, repeats):
            data = unpack(blob)
            found = [] if found is None else list(found)
            pending = any(not r["is_first"] for r in found)
            contents = []
            if found:
                lines = data.split(b"\n")
                ranges, pairs = list(chunks(lines)), _pairs(lines)
                for r in found:
                    a, b = ranges[r["k"]] if r["k"] >= 0 else pairs[r["k"] - _PAIRS]
                    contents.append({"k": r["k"], "h1": r["h1"], "h2": r["h2"], "is_first": bool(r["is_first"]),
                                     "content": b"\n".join(lines[a:b])})
            result = None if pending else dict(zip(names, _finish(data, set(), keep_text)))
            out.append((result, blob if pending else None, contents))
        return pd.DataFrame(out, columns=["result", "packed", "contents"], dtype="object")

    result_type = "struct<" + ", ".join(c.replace(" ", ": ") for c in _RESULT.split(", ")) + ">"
    settled = F.pandas_udf(settle, f"result {result_type}, packed binary, contents array<struct<k: int, h1: bigint, "
                                   "h2: bigint, is_first: boolean, content: binary>>")("packed", "repeats")
    state = stored(state.select("doc_id", "body", settled.alias("s")).select("doc_id", "body", "s.*"), "line-state")
    contents = state.select("doc_id", "body", F.explode("contents").alias("c")).select("doc_id", "body", "c.*")
    # Rows equal in id and text give the same first chunk: one of them.
    firsts = contents.where("is_first").select("h1", "h2", F.col("content").alias("first_content")).dropDuplicates(["h1", "h2"])
    equal = contents.where("NOT is_first").join(firsts, ["h1", "h2"]).where(F.col("content") == F.col("first_content"))
    removed = equal.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(F.collect_set("k").alias("removed"))

    def complete(blobs: pd.Series, removed: pd.Series) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        return pd.DataFrame([_finish(unpack(b), set() if r is None else set(r), keep_text) for b, r in zip(blobs, removed)], columns=names)

    pending = state.where("result IS NULL").select("doc_id", "body", "packed").join(removed, on, "left")
    pending = pending.select("doc_id", F.pandas_udf(complete, _RESULT)("packed", "removed").alias("result"))
    done = state.where("result IS NOT NULL").select("doc_id", "result")
    return done.unionByName(pending).select("doc_id", "result.*")
