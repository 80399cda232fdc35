"""Fill-in-the-middle transformation (operator 11), cuts through a learned rank index.

A text is cut into lines; two hashes of the document id choose two of the n + 1 boundaries.
The offsets of all boundaries are not kept as an array: :class:`RankIndex` fits line segments to
rank -> offset such that every prediction is off by at most ``error`` (segments end where no line
through their first point stays within the bound), and keeps the residuals in as few
bytes as they need.  ``select(k)`` predicts the offset of boundary k and adds its residual.

One pass over the table, no shuffle: a task holds one Arrow batch and one text's boundaries.

Edge cases: NULL is the empty text; an empty text has no lines and stays plain; a text that
holds a sentinel stays plain; a NULL id hashes as the empty string; repeated ids and rows give a row
each, equal (id, text) the same cuts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
RATE = 100              # of 100 texts so many are transformed
SPM_SHARE = 50          # of 100 transformed texts so many put the suffix first
ERROR = 64              # bound of the prediction error in bytes
_FIRST = 64             # boundaries looked at first when a segment is fitted
_NEWLINE = 10


class RankIndex:
    """Piecewise-linear map from rank to offset over an increasing array that starts at 0.

    ``starts``, ``bases``, ``slopes``: first rank, offset there and slope of each segment;
    ``residuals``: offset minus prediction of every rank, within ``error`` of 0.
    """

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        offsets = np.asarray(offsets, np.int64)
        starts, slopes, at = [], [], 0
        while at < len(offsets):
            length, slope = self._segment(offsets, at, error)
            starts.append(at)
            slopes.append(slope)
            at += length
        self.n = len(offsets)
        self.starts = np.array(starts, np.int64)
        self.bases = offsets[self.starts]
        self.slopes = np.array(slopes, np.float64)
        ranks = np.arange(self.n)
        segment = np.repeat(np.arange(len(starts)), np.diff(np.append(self.starts, self.n)))
        residuals = offsets - self._predict(ranks, segment)
        worst = int(np.abs(residuals).max(initial=0))
        if worst > error + 1:                          # one more for rounding down
            raise AssertionError("a segment left its error bound")
        self.residuals = residuals.astype(np.int8 if worst < 128 else np.int16 if worst < 32768 else np.int64)

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """Length and slope of the longest segment from ``at``: the cone of slopes that keep
        every point within the bound shrinks from point to point until it is empty."""
        low, high, done, size = -np.inf, np.inf, 1, _FIRST
        while at + done < len(offsets):
            steps = np.arange(done, min(done + size, len(offsets) - at))
            rise = offsets[at + steps] - offsets[at]
            lows = np.maximum(np.maximum.accumulate((rise - error) / steps), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / steps), high)
            good = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(steps)
            if good:
                low, high = float(lows[good - 1]), float(highs[good - 1])
            done += good
            if good < len(steps):
                break
            size *= 2
        return done, (low + high) / 2 if done > 1 else 0.0

    def _predict(self, rank, segment):
        return self.bases[segment] + np.floor(self.slopes[segment] * (rank - self.starts[segment])).astype(np.int64)

    def select(self, rank: int) -> int:
        """Offset of boundary ``rank``: prediction of its segment plus stored residual."""
        if not 0 <= rank < self.n:
            raise IndexError(rank)
        segment = int(np.searchsorted(self.starts, rank, side="right")) - 1
        return int(self._predict(rank, segment)) + int(self.residuals[rank])


def boundaries(text: bytes) -> np.ndarray:
    """Offsets of the line boundaries, 0 and the end included: a line ends after its newline."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == _NEWLINE) + 1
    if text and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    return np.concatenate(([0], ends))


def _chars(text: bytes) -> int:
    return len(text.decode("utf-8", "replace"))


def choices(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def transform(doc_id: int | None, text: bytes, rate: int = RATE, spm_share: int = SPM_SHARE, seed: int = SEED,
              error: int = ERROR) -> tuple[str, int, int | None, int | None, bytes]:
    """form, number of lines, prefix and middle length (code points), output of one text."""
    offsets = boundaries(text)
    n = len(offsets) - 1
    h1, h2, h3, h4 = choices(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", n, None, None, text
    index = RankIndex(offsets, error)
    first, second = (index.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_share:
        form, output = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, output = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return form, n, _chars(prefix), _chars(middle), b"".join(output)


def restore(output: bytes, form: str) -> bytes:
    """The exact text from a transformed output: its parts stand between sentinels that no part holds."""
    if form == "plain":
        return output
    outer, inner = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if not output.startswith(outer):
        raise ValueError(f"not a {form} text")
    first, _, rest = output[len(outer):].partition(inner)
    second, _, middle = rest.partition(MIDDLE)
    return second + middle + first if form == "spm" else first + middle + second


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE,
                   spm_share: int = SPM_SHARE, seed: int = SEED, error: int = ERROR, keep_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256 and ``output``, the transformed text (NULL without ``keep_text``)."""
    session_of(docs)

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in schema.names]
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                form, n, prefix, middle, output = transform(doc_id, body.as_py(), rate, spm_share, seed, error)
                row = (doc_id, n, form, prefix, middle, hashlib.sha256(output).hexdigest(),
                       hashlib.sha256(restore(output, form)).hexdigest(), output.decode("utf-8", "replace") if keep_text else None)
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
                        ("output", pa.string())])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("body"))
    return rows.mapInArrow(transformed, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                                        "output_sha256 string, restored_sha256 string, output string")
