"""Language ID (operator 12) by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (``dim`` components, drawn from its code point).
The vector of a letter n-gram binds its letters: their vectors, permuted (rotated) once for
each place before the last, are multiplied.  A text's vector bundles (adds) the vectors of
all its n-grams; a language's prototype bundles those of all its training texts.  A text gets
the language whose prototype has the largest cosine with its vector.

Texts are read in lower case.  There is one 3-gram around every letter; whatever is no letter, and
both ends of the text, count as one blank, which has a vector as well.

Scale.  Training adds whole numbers: a task bundles per language what it reads, and
Spark sums (language, component) over the tasks, so the prototypes do not depend on how rows are
dealt.  They have languages x ``dim`` numbers, which is what reaches the driver and every task.
A task further holds the vectors of the letters it met (at most the letters of Unicode)
and one slice of ``_SLICE`` n-gram vectors.

Edge cases: NULL texts and texts without letters are ``und`` with score 0, as is every text if nothing
could be learned; NULL languages and rows without an id are not learned from; equal cosines
go to the language that sorts first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, utf8

DIM = 1024
SEED = 11
UNDETERMINED = "und"
_SLICE = 2048               # n-gram vectors at once
_PIECE = 1 << 20            # code points counted at once
_BITS = np.int64(21)        # of a code point
_LETTER: np.ndarray | None = None


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text is a multiple of 5 (false for a NULL id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 3-grams around each letter of a text, packed, and how often each occurs."""
    text = f" {text.lower()} "
    found = [np.empty(0, np.int64)]
    for at in range(1, len(text) - 1, _PIECE):
        points = np.frombuffer(text[at - 1:at + _PIECE + 1].encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        c = points * _letters()[points]
        grams = (c[:-2] << _BITS | c[1:-1]) << _BITS | c[2:]
        found.append(grams[c[1:-1] != 0])
    return np.unique(np.concatenate(found), return_counts=True)


class Space:
    """Letter vectors of one task, drawn when first needed; ``bundle`` adds n-gram vectors."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed = dim, seed
        self._row = np.full(0x110000, -1, np.int32)         # code point -> row of the tables
        self._turned = [np.empty((0, dim), np.int8) for _ in range(3)]
        self._cells = np.empty((_SLICE, dim), np.float32)

    def _draw(self, code: int) -> np.ndarray:
        bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(0, 2, self.dim, dtype=np.int8)
        return bits * np.int8(2) - np.int8(1)

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        rows = self._row[codes]
        if len(rows) and rows.min() < 0:
            new = np.unique(codes[rows < 0])
            drawn = np.stack([self._draw(int(c)) for c in new])
            self._row[new] = len(self._turned[0]) + np.arange(len(new))
            self._turned = [np.concatenate((old, np.roll(drawn, k, axis=1))) for k, old in enumerate(self._turned)]
            rows = self._row[codes]
        return rows

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of ``counts`` times the n-grams' vectors, exact."""
        total, mask = np.zeros(self.dim, np.int64), (np.int64(1) << _BITS) - 1
        for at in range(0, len(grams), _SLICE):
            g, n = grams[at:at + _SLICE], counts[at:at + _SLICE]
            rows = [self._rows(x) for x in (g & mask, g >> _BITS & mask, g >> 2 * _BITS)]
            bound = self._turned[2].take(rows[2], axis=0)
            bound *= self._turned[1].take(rows[1], axis=0)
            bound *= self._turned[0].take(rows[0], axis=0)
            if int(n.sum()) < 1 << 24:          # float32 adds whole numbers below 2**24 exactly
                cells = self._cells[:len(g)]
                cells[:] = bound
                total += (n.astype(np.float32) @ cells).astype(np.int64)
            else:
                total += n @ bound.astype(np.int64)
        return total


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
               dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes (one row each) from the documents that are not held out."""
    session_of(docs)
    rows = docs.where(F.col(id_col).isNotNull() & ~is_held_out(id_col) & F.col(lang_col).isNotNull()) \
               .select(F.col(lang_col).cast("string").alias("lang"), utf8(text_col).alias("body"))

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dim, seed), {}
        for batch in batches:
            for lang, text in _joined(zip(batch.column(0).to_pylist(), batch.column(1))):
                sums[lang] = sums.get(lang, 0) + space.bundle(*ngrams(text))
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(range(dim), pa.int32()), pa.array(total)],
                                             ["lang", "component", "value"])

    sums = rows.mapInArrow(bundled, "lang string, component int, value bigint") \
               .groupBy("lang", "component").agg(F.sum("value").alias("value"))
    table = sums.toPandas()                     # languages x dim whole numbers
    langs = sorted(table["lang"].unique())
    out = np.zeros((len(langs), dim))
    out[np.searchsorted(langs, table["lang"]), table["component"]] = table["value"]
    return langs, out


def _joined(rows: Iterable[tuple[str, pa.Scalar]]) -> Iterator[tuple[str, str]]:
    """Texts of one language together, in pieces of bounded size: words of two texts never touch."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for lang, scalar in rows:
        text = scalar.as_py().decode("utf-8", "replace")
        held.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] >= _PIECE:
            yield lang, "\n".join(held.pop(lang))
            del sizes[lang]
    for lang, texts in held.items():
        yield lang, "\n".join(texts)


def predict(docs: DataFrame, langs: list[str], vectors: np.ndarray, text_col: str = "text", dim: int = DIM, seed: int = SEED,
            out: str = "language") -> DataFrame:
    """``docs`` with column ``out``: struct of lang_pred and score (cosine, negative ones as 0)."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True) if len(langs) else np.empty((0, 1))
    used = norms[:, 0] > 0 if len(langs) else np.empty(0, bool)
    model = [x for x, u in zip(langs, used) if u], (vectors[used] / norms[used]).astype(np.float32) if len(langs) else None
    shared = session_of(docs).sparkContext.broadcast(model)

    def best(space: Space, body: bytes) -> tuple[str, float]:
        names, unit = shared.value
        grams, counts = ngrams(body.decode("utf-8", "replace"))
        if not names or not len(grams):
            return UNDETERMINED, 0.0
        vector = space.bundle(grams, counts)
        length = float(np.linalg.norm(vector))
        if not length:
            return UNDETERMINED, 0.0
        cosines = unit @ vector.astype(np.float32) / length
        top = int(np.argmax(cosines))
        return names[top], float(min(max(cosines[top], 0.0), 1.0))

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = Space(dim, seed)
        for bodies in batches:
            yield pd.DataFrame([best(space, x) for x in bodies], columns=["lang_pred", "score"])

    return docs.withColumn(out, F.pandas_udf(predicted, "lang_pred string, score double")(utf8(text_col)))


def identify(docs: DataFrame, dim: int = DIM, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from ``docs`` itself."""
    langs, vectors = prototypes(docs, dim=dim, seed=seed)
    rows = predict(docs.select("doc_id", "text"), langs, vectors, dim=dim, seed=seed)
    return rows.select("doc_id", is_held_out().alias("held_out"), "language.lang_pred", "language.score")
