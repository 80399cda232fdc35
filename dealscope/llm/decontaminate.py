"""Benchmark decontamination (operator 7): Wu-Manber multi-pattern search over words.

Patterns are the 13-word windows of the benchmark items (an item of fewer words is one
pattern).  For each pattern length there are a shift table over blocks of two words, which
lets the scan jump over positions where no pattern can end, and buckets of patterns by
their last block; a direct comparison of the words confirms each occurrence.

The benchmark is cut into chunks of at most ``CHUNK_BYTES`` expected text.  A chunk's tables take some 106
times its text in Python (measured on 3.9 MB), so about 220 MB on the driver and in each worker at a
time; the documents are scanned once per chunk, and a chunk's broadcast goes once its scan is written.

Edge cases: NULL and empty texts have no words and are never contaminated; items without
words match nothing; items with equal text each count; repeated rows of one item count
once (by item_id; a NULL item_id counts as the id ''); an empty benchmark leaves every
document clean; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import fresh, session_of, stored, utf8

WINDOW = 13
CHUNK_BYTES = 2 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_RESULT = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
           "starts array<int>, stops array<int>, items array<string>")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of non-ASCII characters."""
    return _WORD.findall(text.lower())


class _Table:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[list[int], set[str]]]] = {}

    def add(self, pattern: list[int], item: str) -> None:
        m, b = self.length, self.block
        for end in range(b, m + 1):
            block = tuple(pattern[end - b:end])
            self.shift[block] = min(self.shift.get(block, self.default), m - end)
        bucket = self.buckets.setdefault(tuple(pattern[m - b:]), [])
        for known, items in bucket:
            if known == pattern:
                items.add(item)
                return
        bucket.append((pattern, {item}))

    def scan(self, ids: list[int], spans: list[tuple[int, int]], items: set[str]) -> None:
        m, b, n = self.length, self.block, len(ids)
        shift, default, buckets = self.shift.get, self.default, self.buckets
        end = m
        while end <= n:
            if not ids[end - 1]:        # a word of no pattern: none can cover it
                end += m
                continue
            block = tuple(ids[end - b:end])
            jump = shift(block, default)
            if jump:
                end += jump
                continue
            window = ids[end - m:end]
            for pattern, owners in buckets[block]:
                if pattern == window:
                    spans.append((end - m, end))
                    items |= owners
            end += 1


class Matcher:
    """All patterns of a set of (item_id, text) rows."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.tables: dict[int, _Table] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            for at in range(len(ids) - m + 1 if m else 0):
                self.tables.setdefault(m, _Table(m)).add(ids[at:at + m], item)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        ids = [self.vocabulary.get(w, 0) for w in words]
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for t in self.tables.values():
            t.scan(ids, spans, found)
        return spans, found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _chunks(benchmark: DataFrame, item_col: str, text_col: str, chunk_bytes: int):
    """Lists of (item id, text), each of bounded expected size, one after the other."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                            utf8(text_col).alias("body")).distinct()
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = total // chunk_bytes + 1
    part = F.pmod(F.xxhash64("item", "body"), F.lit(n))
    for k in range(n):
        yield [(r.item, bytes(r.body)) for r in rows.where(part == k).collect()]


def _scanners(shared):
    """The scan of one benchmark chunk as a UDF body: for the first chunk, and for a later
    one that adds to what earlier chunks found."""

    def scan(bodies, before) -> pd.DataFrame:
        rows = []
        for body, old in zip(bodies, before):
            words = words_of(body)
            spans, items = shared.value.search(words)
            if old is not None:
                spans += zip(old.starts, old.stops)
                items |= set(old.items)
            spans = _merged(spans)
            n_hit = sum(b - a for a, b in spans)
            digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
            rows.append((len(words), n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= len(words),
                         [a for a, _ in spans], [b for _, b in spans], sorted(items)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _RESULT.split(", ")])

    def first(bodies: pd.Series) -> pd.DataFrame:
        return scan(bodies, itertools.repeat(None))

    def more(bodies: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        return scan(bodies, before[["starts", "stops", "items"]].itertuples(index=False))

    return first, more


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                       out: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit (words inside an occurrence),
    n_items, items_sha256, contaminated (at least 5 % of the words hit), and the hit word
    spans (starts, stops) and item ids."""
    sc = session_of(docs).sparkContext
    result, shared = docs, None
    for k, chunk in enumerate(_chunks(benchmark, item_col, item_text_col, chunk_bytes)):
        if k:
            result = stored(result, "decontaminate")
            shared.destroy()
        shared = sc.broadcast(Matcher(chunk, window))
        first, more = _scanners(shared)
        scan = F.pandas_udf(more, _RESULT)(utf8(text_col), F.col(out)) if k else F.pandas_udf(first, _RESULT)(utf8(text_col))
        result = result.withColumn(out, scan)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    out = fresh(docs, "_contamination")
    found = find_contamination(docs, benchmark, text_col, out=out)
    return found.where(~F.col(f"{out}.contaminated")).select(*docs.columns)
