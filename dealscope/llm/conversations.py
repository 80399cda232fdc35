"""Conversation structure repair (operator 13): cheapest edits by a run-length min-plus DP.

A conversation is the sequence of its rows by turn (NULL first; ties by role, then by the text's SHA-256).
Its role initials should read ``(s?(ua)+)?``: a state machine with the states start, s, u, a.  The
first fault of a row counts: blank, duplicate (role and text seen earlier), truncated.

Edits, one letter each: K keeps a row (0), R gives it the role that the state asks for (3),
D deletes it (4; required for blank and duplicate rows), I inserts a row of that role before the next one
or at the end (3).  A truncated row that stays costs 3 more.  Of the cheapest edit lists the ASCII-least is taken.
A state and a letter give the next role, so the walk that takes the least letter on a cheapest path is exact.

Run-length DP.  A row is a symbol (class of its initial, fault); equal consecutive symbols
are a run.  A symbol's costs from state to state form a min-plus matrix; a run of n rows takes
the matrix's cached binary powers.  Costs to go run backwards over the runs, then the walk
unrolls each run's letters, halving long runs with the same powers.  Both steps are remembered by
(symbol, length, costs to go less their least, state), of which there are few.

Scale.  Identical rows are counted before they are dealt out, duplicates are found by an aggregation
and a join that AQE can split, and only digests (no texts) are range-partitioned by (conversation, turn, role,
text hash), so that a hot conversation spreads over many tasks.  A conversation inside one range is
solved there.  One that crosses ranges (at most one per border) leaves a segment per range:
its 4 x 4 matrix and its runs.  The matrices give each segment its costs to go, each segment is walked from all
four states on its own, and the walks are strung together.  What one task holds of a conversation is never more than its
symbols in run-length form and its audit, the value that the result's row must hold anyway.  The
repaired hash needs a conversation's bytes in order: texts are streamed, sorted, through one
SHA-256 per conversation without being held.

Edge cases: NULL role or text is one space, a NULL conv_id is a conversation of its own; a role whose first character is not s, u or a (or
that is empty) can only be given another role or deleted; conversations without rows keep a row of zeros; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, stored, width

CLASSES = "sua"                     # initials the state machine knows; 3 stands for all others
OTHER = 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_ROLE = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}     # what R and I give
_NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
_KEEP = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_FAR = 1 << 50
_END = (0, _FAR, _FAR, 0)           # a conversation may end empty or after an assistant
_SHORT = 32                         # runs up to here are walked row by row
_RUN = "<BI"
_BLANKS = r"\x20\x09-\x0D"

Matrix = tuple[tuple[int, ...], ...]


# ---------------------------------------------------------------- the min-plus machine

def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(_FAR, min(row[k] + b[k][j] for k in range(4))) for j in range(4)) for row in a)


UNIT: Matrix = tuple(tuple(0 if i == j else _FAR for j in range(4)) for i in range(4))


def _insertions() -> Matrix:
    once = tuple(tuple(0 if i == j else INSERT if _NEXT[i] == j else _FAR for j in range(4)) for i in range(4))
    return times(times(once, once), times(once, once))


INSERTIONS = _insertions()


def moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, next state, cost) of the edits of a row, in the order of the letters."""
    kind, fault = symbol // 4, symbol % 4
    out = [("D", state, DELETE)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT if fault == TRUNCATED else 0
    if (state, kind) in _KEEP:
        out.append(("K", _KEEP[state, kind], extra))
    return [*out, ("R", _NEXT[state], RENAME + extra)]


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """Costs of 2 ** k rows of one symbol with insertions before each."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    row = [[_FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, to, cost in moves(symbol, state):
            row[state][to] = min(row[state][to], cost)
    return times(INSERTIONS, tuple(map(tuple, row)))


@lru_cache(1 << 16)
def _back(symbol: int, n: int, end: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a run from those after it, through the powers in ``n``."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            m = power(symbol, k)
            end = tuple(min(_FAR, min(m[i][j] + end[j] for j in range(4))) for i in range(4))
    return end


def back(symbol: int, n: int, end: tuple[int, ...]) -> tuple[int, ...]:
    least = min(end)
    return tuple(x + least for x in _back(symbol, n, tuple(min(_FAR, x - least) for x in end)))


@lru_cache(1 << 16)
def _walk(symbol: int, n: int, state: int, end: tuple[int, ...]) -> tuple[str, int]:
    """Least letters of a cheapest walk over a short run and the state after it."""
    to_go = [end]
    for _ in range(n):
        to_go.append(back(symbol, 1, to_go[-1]))
    letters = []
    while n:
        options = [(c, to, cost + to_go[n - 1][to], 1) for c, to, cost in moves(symbol, state)]
        options.append(("I", _NEXT[state], INSERT + to_go[n][_NEXT[state]], 0))
        letter, state, _, row = min(o for o in options if o[2] == to_go[n][state])
        letters.append(letter)
        n -= row
    return "".join(letters), state


def walk(symbol: int, n: int, state: int, end: tuple[int, ...]) -> tuple[str, int]:
    """As :func:`_walk` for a run of any length and any costs to go after it."""
    if symbol % 4 in (BLANK, DUPLICATE):
        return "D" * n, state               # the least letter, and insertions can always wait
    if n > _SHORT:
        half = n // 2
        first, state = walk(symbol, n - half, state, back(symbol, half, end))
        second, state = walk(symbol, half, state, end)
        return first + second, state
    least = min(end)
    return _walk(symbol, n, state, tuple(min(_FAR, x - least) for x in end))


def closing(state: int) -> str:
    """Insertions after the last row."""
    letters = ""
    while _END[state]:
        state, letters = _NEXT[state], letters + "I"
    return letters


#: Costs to go after the last row, insertions included.
FINAL = tuple(min(INSERTIONS[i][j] + _END[j] for j in range(4)) for i in range(4))


def matrix_of(runs: Iterable[tuple[int, int]]) -> Matrix:
    out = UNIT
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = times(out, power(symbol, k))
    return out


def unroll(runs: list[tuple[int, int]], state: int, end: tuple[int, ...]) -> tuple[str, int]:
    """Audit of a sequence of runs from ``state``, given the costs to go after it, and the last state."""
    ends = [end]
    for symbol, n in reversed(runs):
        ends.append(back(symbol, n, ends[-1]))
    letters = []
    for (symbol, n), after in zip(runs, reversed(ends[:-1])):
        piece, state = walk(symbol, n, state, after)
        letters.append(piece)
    return "".join(letters), state


def solve(runs: list[tuple[int, int]]) -> str:
    audit, state = unroll(runs, START, FINAL)
    return audit + closing(state)


def cost_of(audit: str, truncated_kept: int) -> int:
    n = Counter(audit)
    return RENAME * n["R"] + DELETE * n["D"] + INSERT * n["I"] + CUT * truncated_kept


def _truncated_kept(runs: list[tuple[int, int]], audit: str) -> int:
    """Truncated rows that an audit does not delete (trailing insertions may be there or not)."""
    rows, at, kept = audit.replace("I", ""), 0, 0
    for symbol, n in runs:
        if symbol % 4 == TRUNCATED:
            kept += n - rows.count("D", at, at + n)
        at += n
    return kept


# ---------------------------------------------------------------- damage and digests

def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows faulted by a hash of (conversation, turn); ``copies`` is 0 for a
    dropped and 2 for a repeated row."""
    space = F.lit(" ")
    conv, turn = F.col(id_col).cast("bigint"), F.col(turn_col).cast("bigint")
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in (role_col, text_col))
    name = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    hit = F.crc32(name.cast("binary")) % 20
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def _sha(column: str):
    return F.unhex(F.sha2(F.col(column).cast("binary"), 256))


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, sha, symbol, n: the rows of each conversation, identical ones counted.  The copies after
    the first are duplicates; ``symbol`` tells whether the first one is."""
    last = F.regexp_extract("text", rf"([^{_BLANKS}])[{_BLANKS}]*\z", 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    kind = F.position(F.substring("role", 1, 1), F.lit(CLASSES)) - 1
    kind = F.when((F.col("role") == "") | (kind < 0), OTHER).otherwise(kind)
    seen = rows.where("copies > 0").select(
        "conv_id", "turn", "role", _sha("text").alias("sha"), (kind * 4 + fault).alias("symbol"), "copies")
    texts = (seen.where(F.col("symbol") % 4 != BLANK).groupBy("conv_id", "role", "sha")
             .agg(F.sum("copies").alias("copies"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
             .where("copies > 1").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("sha").alias("_sha"),
                                         F.col("first.turn").alias("_turn"), F.lit(True).alias("_again")))
    on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("sha") == F.col("_sha"))
    later = F.coalesce(F.col("_again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("symbol") % 4 != BLANK)
    symbol = F.when(later, F.floor(F.col("symbol") / 4) * 4 + DUPLICATE).otherwise(F.col("symbol")).cast("int")
    return (seen.join(texts, on, "left").select("conv_id", "turn", "role", "sha", symbol.alias("symbol"), "copies")
            .groupBy("conv_id", "turn", "role", "sha", "symbol").agg(F.sum("copies").alias("n")))


# ---------------------------------------------------------------- segments

_SEGMENT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("open", pa.bool_()), ("runs", pa.binary()),
                      ("matrix", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())),
                      ("counts", pa.list_(pa.int64())), ("cost", pa.int64()), ("audit", pa.string())])
_SEGMENT_DDL = ("conv_id bigint, part int, open boolean, runs binary, matrix array<bigint>, turns array<bigint>, ends array<int>, "
                "counts array<bigint>, cost bigint, audit string")


class _Segment:
    """Rows of one conversation inside one range: runs, turns, faults and illegal neighbours."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.runs = conv_id, []
        self.low = self.high = self.last_turn = None
        self.distinct = self.illegal = 0
        self.first = self.last = None
        self.faults = [0] * 4

    def add(self, turn: int | None, symbol: int, n: int) -> None:
        if turn is not None:
            if turn != self.last_turn:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        kind, fault = divmod(symbol, 4)
        copies = fault in (BLANK, DUPLICATE) or n == 1
        for s, k in ((symbol, n),) if copies else ((symbol, 1), (kind * 4 + DUPLICATE, n - 1)):
            self.faults[s % 4] += k
            if self.runs and self.runs[-1][0] == s:
                self.runs[-1] = (s, self.runs[-1][1] + k)
            else:
                self.runs.append((s, k))
        if self.last is None:
            self.first = kind
        else:
            self.illegal += (self.last, kind) not in _LEGAL
        self.illegal += (n - 1) * ((kind, kind) not in _LEGAL)
        self.last = kind

    def row(self, part: int, open_: bool) -> tuple:
        turns = None if self.low is None else [self.low, self.high, self.distinct]
        counts = [self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal]
        if open_:
            matrix = [x for line in matrix_of(self.runs) for x in line]
            return (self.conv_id, part, True, _packed(self.runs), matrix, turns, [self.first, self.last], counts, None, None)
        audit = solve(self.runs)
        cost = cost_of(audit, _truncated_kept(self.runs, audit))
        return self.conv_id, part, False, None, None, turns, [self.first, self.last], counts, cost, audit


def _packed(runs: list[tuple[int, int]]) -> bytes:
    most = (1 << 32) - 1
    return b"".join(struct.pack(_RUN, s, min(most, n - at)) for s, n in runs for at in range(0, n, most))


def _unpacked(blob: bytes) -> list[tuple[int, int]]:
    return list(struct.iter_unpack(_RUN, blob))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema.names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema)


def segments(rows: DataFrame) -> DataFrame:
    """Conversations solved, or open segments of those that touch the border of a range."""
    spark = session_of(rows)
    dealt = rows.repartitionByRange(max(2, width(spark)), "conv_id", "turn", "role", "sha") \
                .sortWithinPartitions("conv_id", "turn", "role", "sha") \
                .select(F.spark_partition_id().alias("part"), "conv_id", "turn", "symbol", "n")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, part, out = None, True, 0, []
        for batch in batches:
            for part, conv_id, turn, symbol, n in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.row(part, first))
                        first = False
                    now = _Segment(conv_id)
                now.add(turn, symbol, n)
            if out:
                yield _batch(out, _SEGMENT)
                out = []
        if now is not None:
            yield _batch([now.row(part, True)], _SEGMENT)

    return dealt.mapInArrow(cut, _SEGMENT_DDL)


def _joined_open(open_: DataFrame) -> DataFrame:
    """conv_id, turns, counts, cost, audit of the conversations of open segments (two per range at most)."""

    def suffix_costs(parts: pd.Series) -> pd.Series:
        """For each segment of a conversation the costs to go after it."""
        out = []
        for found in parts:
            end, ends = FINAL, []
            for p in sorted(found, key=lambda p: -p["part"]):
                ends.append({"part": p["part"], "end": list(end)})
                m = p["matrix"]
                end = tuple(min(_FAR, min(int(m[4 * i + j]) + end[j] for j in range(4))) for i in range(4))
            out.append(ends)
        return pd.Series(out)

    costs = open_.groupBy("conv_id").agg(F.collect_list(F.struct("part", "matrix")).alias("parts"))
    costs = costs.select(F.col("conv_id").alias("_conv"), F.explode(
        F.pandas_udf(suffix_costs, "array<struct<part: int, end: array<bigint>>>")("parts")).alias("p")).select(
        "_conv", F.col("p.part").alias("_part"), F.col("p.end").alias("end"))
    walked = open_.join(costs, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))

    def walks(blobs: pd.Series, ends: pd.Series) -> pd.Series:
        """From each of the four states: audit, state after it, truncated rows that stay."""
        out = []
        for blob, end in zip(blobs, ends):
            runs, end = _unpacked(blob), tuple(int(x) for x in end)
            found = [unroll(runs, state, end) for state in range(4)]
            out.append([{"audit": a, "state": s, "kept": _truncated_kept(runs, a)} for a, s in found])
        return pd.Series(out)

    walked = walked.withColumn("walks", F.pandas_udf(walks, "array<struct<audit: string, state: int, kept: bigint>>")("runs", "end"))
    pieces = walked.groupBy("conv_id").agg(F.collect_list(F.struct("part", "turns", "ends", "counts", "walks")).alias("pieces"))

    def strung(groups: pd.Series) -> pd.DataFrame:
        out = []
        for found in groups:
            state, audit, kept, counts = START, [], 0, np.zeros(4, np.int64)
            low = high = before = None
            distinct = 0
            for p in sorted(found, key=lambda p: p["part"]):
                step = p["walks"][state]
                audit.append(step["audit"])
                kept, state = kept + step["kept"], step["state"]
                counts += np.array(p["counts"])
                if before is not None:
                    counts[3] += (before, p["ends"][0]) not in _LEGAL
                before = p["ends"][1]
                if p["turns"] is not None:
                    distinct += p["turns"][2] - (high is not None and p["turns"][0] == high)
                    low, high = p["turns"][0] if low is None else low, p["turns"][1]
            text = "".join(audit) + closing(state)
            out.append((None if low is None else [low, high, distinct], counts.tolist(), cost_of(text, kept), text))
        return pd.DataFrame(out, columns=["turns", "counts", "cost", "audit"])

    joined = F.pandas_udf(strung, "turns array<bigint>, counts array<bigint>, cost bigint, audit string")("pieces")
    return pieces.select("conv_id", joined.alias("r")).select("conv_id", "r.*")


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, turns (least, greatest, distinct), counts (blank, duplicate, truncated, illegal), cost, audit of every
    conversation that has rows after the damage."""
    found = stored(segments(digests(rows)), "conversation-segments")
    columns = ["conv_id", "turns", "counts", "cost", "audit"]
    return found.where("NOT open").select(*columns).unionByName(_joined_open(found.where("open")).select(*columns))


# ---------------------------------------------------------------- repaired texts

_RESULT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                     ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                     ("repaired_sha256", pa.string())])


class _Repair:
    """Applies an audit to the rows of a conversation as they come; ``lines`` are the repaired rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _insert(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield _ROLE[self.state], ""
            self.state, self.at = _NEXT[self.state], self.at + 1

    def lines(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str]]:
        for _ in range(copies):
            yield from self._insert()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = _KEEP[self.state, CLASSES.index(role[0])]
                yield role, text
            elif letter == "R":
                yield _ROLE[self.state], text
                self.state = _NEXT[self.state]

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._insert()


def _sorted_with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation in one task: first its audit (tag 0), then its rows in order (tag 1); dropped
    rows (tag 2) only name their conversation."""
    said = found.select("conv_id", F.lit(0).alias("tag"), "turns", "counts", "cost", "audit",
                        F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("sha"), F.lit(0).alias("copies"))
    gone = F.col("copies") == 0
    body = rows.select(
        "conv_id", F.when(gone, 2).otherwise(1).alias("tag"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("turns", "array<bigint>"), ("counts", "array<bigint>"), ("cost", "bigint"), ("audit", "string"))],
        *[F.when(~gone, c).alias(n) for n, c in (("turn", F.col("turn")), ("role", F.col("role")), ("text", F.col("text")), ("sha", _sha("text")))],
        "copies")
    return (said.unionByName(body).repartition(width(session_of(rows)), "conv_id")
            .sortWithinPartitions("conv_id", "tag", "turn", "role", "sha")
            .select("conv_id", "tag", "turns", "counts", "cost", "audit", "role", "text", "copies"))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Events of sorted rows: "open" with a conversation's audit columns, "line" with (role, text) of each
    repaired row, "close"."""
    now, repair, started = None, None, False
    for batch in batches:
        for conv_id, tag, turns, counts, cost, audit, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or conv_id != now:
                if started:
                    yield from (("line", x) for x in repair.rest())
                    yield "close", None
                now, started = conv_id, True
                yield "open", (conv_id, turns, counts or [0] * 4, cost or 0, audit or "")
                repair = _Repair(audit or "")
            if tag == 1:
                yield from (("line", x) for x in repair.lines(role, text, copies))
    if started:
        yield from (("line", x) for x in repair.rest())
        yield "close", None


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    rows = damage(conversations)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, digest, lines = [], None, None, 0
        for kind, value in _stream(batches):
            if kind == "open":
                head, digest, lines = value, hashlib.sha256(), 0
            elif kind == "line":
                digest.update(("\n" if lines else "").encode() + f"{value[0]}:{value[1]}".encode("utf-8", "replace"))
                lines += 1
            else:
                conv_id, turns, counts, cost, audit = head
                gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
                out.append((conv_id, gaps, *counts, cost, audit, digest.hexdigest()))
            if len(out) >= 2000:
                yield _batch(out, _RESULT)
                out = []
        if out:
            yield _batch(out, _RESULT)

    return _sorted_with_audits(rows, audits(rows)).mapInArrow(
        hashed, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                "audit string, repaired_sha256 string")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the repaired conversations themselves."""
    rows = damage(conversations)
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv_id, at = [], None, 0
        for kind, value in _stream(batches):
            if kind == "open":
                conv_id, at = value[0], 0
            elif kind == "line":
                out.append((conv_id, at, *value))
                at += 1
            if len(out) >= 2000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return _sorted_with_audits(rows, audits(rows)).mapInArrow(lines, "conv_id bigint, position bigint, role string, text string")
