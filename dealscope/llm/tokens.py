"""Token-ID output (operator 8): one concatenated id array per shard, document
boundaries in Elias-Fano form, offsets read back through a select structure.

File format.  A token table is a Parquet folder; each row is one shard:

=========  ==========================================================
part, seq  order of the shard (range partition, position inside it)
doc_ids    the shard's document ids, ascending
ids        all token ids, little endian, 2 bytes each (4 if the vocabulary needs it)
id_bytes   2 or 4
ends       Elias-Fano code of the documents' end offsets, see :func:`ef_encode`
=========  ==========================================================

Parquet carries the blobs so that Spark's commit protocol covers them: a lost
executor's half-written shard is never seen.

Edge cases: NULL and empty texts hold only the end id; NULL ids come first; repeated
ids stay separate documents, ordered by a hash of the text; an empty table gives an
empty token table; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealscope.llm.common import fresh, session_of, utf8, width
from dealscope.session import ensure_checkpoint_dir, keep_track

END_ID = 1
SHARD_BYTES = 16 << 20
CACHE_WORDS = 300_000
CACHE_BYTES = 64            # longer words are not kept: 300,000 x (64 bytes and their ids) bound the cache
_SAMPLE = 64
_HEAD = struct.Struct("<IIB")
_SHARD_SCHEMA = ("part int, seq int, doc_ids array<bigint>, n_tokens bigint, ids binary, "
                 "id_bytes int, ends binary")


# ---------------------------------------------------------------- Elias-Fano

def ef_encode(ends: np.ndarray) -> bytes:
    """Elias-Fano code of a non-decreasing array of offsets below 2**32.

    Header (count, last value, low bit count), the low bits packed, every 64th
    one-bit position of the upper part as a 32-bit select sample, the upper bits.
    """
    n = len(ends)
    last = int(ends[-1]) if n else 0
    if last >= 1 << 32:
        raise ValueError("a shard holds fewer than 2**32 tokens")
    low = max(0, (last // n).bit_length() - 1) if n else 0
    ends = ends.astype(np.uint64)
    ones = (ends >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    upper[ones] = 1
    lows = ((ends[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return b"".join((_HEAD.pack(n, last, low), np.packbits(lows.ravel(), bitorder="little").tobytes(),
                     ones[::_SAMPLE].astype("<u4").tobytes(), np.packbits(upper, bitorder="little").tobytes()))


class EliasFano:
    """Read side: ``select(i)`` gives the i-th offset from the samples and the upper
    bits after one sample; ``all()`` gives every offset."""

    def __init__(self, code: bytes):
        self.n, self.last, self.low = _HEAD.unpack_from(code)
        at = _HEAD.size
        size = (self.n * self.low + 7) // 8
        self._lows = np.frombuffer(code, np.uint8, size, at)
        at += size
        self._samples = np.frombuffer(code, "<u4", -(-self.n // _SAMPLE), at)
        at += self._samples.nbytes
        self._upper = np.frombuffer(code, np.uint8, -1, at)

    def _low_part(self, i: int, k: int) -> np.ndarray:
        if not self.low:
            return np.zeros(k, np.int64)
        first = i * self.low
        bits = np.unpackbits(self._lows[first // 8:((i + k) * self.low + 7) // 8], bitorder="little")
        bits = bits[first % 8:first % 8 + k * self.low].reshape(k, self.low).astype(np.int64)
        return bits @ (1 << np.arange(self.low, dtype=np.int64))

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        skip, at = i % _SAMPLE, int(self._samples[i // _SAMPLE])
        end = int(self._samples[i // _SAMPLE + 1]) + 1 if i // _SAMPLE + 1 < len(self._samples) else len(self._upper) * 8
        bits = np.unpackbits(self._upper[at // 8:(end + 7) // 8], bitorder="little")
        one = at + int(np.flatnonzero(bits[at % 8:])[skip])
        return (one - i << self.low) + int(self._low_part(i, 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._upper, bitorder="little"))[:self.n]
        return (ones - np.arange(self.n) << self.low) + self._low_part(0, self.n)


# ---------------------------------------------------------------- encoding

#: Byte-level alphabet: bytes that Latin-1 cannot show stand at 256 and on, in order.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class WordEncoder:
    """Whole-text encoding through the tokenizers library, word by word where that is exact.

    The text is encoded word by word if the tokenizer file declares the word pre-tokenizer
    below, which never joins characters across white space and cuts a letter or digit from
    punctuation after it, under a normalizer of NFC, white space folding and lower case.
    Then the ids of a text are those of its words one after the other, and each distinct
    word goes through the library once per cache filling (the cache is emptied when full).
    Under any other tokenizer each text goes through the library as a whole.
    """

    _WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    _TAIL = re.compile(rb"(.*(?:[0-9A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-/:-@\[-`{-~]+)", re.S)
    _LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")      # letters of Latin-1, composed already

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self.id_bytes = 2 if max(self._tok.get_vocab_size(with_added_tokens=True), END_ID + 1) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.id_bytes}")
        self._model = self._tok.model
        self._packs = [struct.Struct(f"<{n}{'H' if self.id_bytes == 2 else 'I'}").pack for n in range(4 * CACHE_BYTES)]
        self._cache = _Cache(self._word)
        spec = json.loads(self._tok.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self._by_word = (steps == ["NFC", "Replace", "Lowercase"]
                         and cuts[0].get("pattern") == {"Regex": self._WORD_SPLIT} and cuts[0].get("behavior") == "Removed"
                         and [c["type"] for c in cuts[1:]] == ["ByteLevel"] and not cuts[1]["add_prefix_space"])

    def _whole(self, text: bytes) -> bytes:
        found = self._tok.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype).tobytes()

    def _letters(self, word: str) -> bytes:
        """Packed ids of a word of lower-case letters, as the model sees it: one character a byte."""
        ids = [t.id for t in self._model.tokenize(word)]
        return self._packs[len(ids)](*ids) if len(ids) < len(self._packs) else np.array(ids, self.dtype).tobytes()

    def _word(self, word: bytes) -> bytes:
        """Packed ids of a word that the cache does not hold."""
        if word.isalpha() and word.islower():       # ASCII letters only: normalizing leaves them as they are
            return self._letters(word.decode())
        if b"\xc3" in word:
            text = word.decode("utf-8", "replace")
            if self._LATIN.fullmatch(text):
                return self._letters(text.lower().encode().decode("latin-1").translate(_BYTE_CHARS))
        tail = self._TAIL.fullmatch(word)
        if tail and b"<|" not in word:
            return self._cache[tail[1]] + self._cache[tail[2]]
        return self._whole(word)

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Packed ids of each text, end id included."""
        end, cache = np.array([END_ID], self.dtype).tobytes(), self._cache
        for text in texts:
            if not self._by_word:
                yield self._whole(text) + end
                continue
            # Lower case first only where no combining mark (U+0300 - U+036F) could compose
            # otherwise and no special token could appear.
            if b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text:
                text = text.lower()
            if len(cache) > CACHE_WORDS:
                cache.clear()
            yield b"".join([*map(cache.__getitem__, text.split()), end])


class _Cache(dict):
    def __init__(self, find):
        super().__init__()
        self._find = find

    def __missing__(self, word: bytes) -> bytes:
        found = self._find(word)
        if len(word) <= CACHE_BYTES:
            self[word] = found
        return found


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps its cache from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> None:
    """Encode every text and write the token table to ``path``, ascending by id.

    Documents are range-partitioned by (id, text hash) so that neither a hot id nor
    one task holds more than its range; each partition streams its shards.
    """
    tie = fresh(docs, "_tie")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("body"))
    rows = rows.withColumn(tie, F.xxhash64("body"))
    n = max(2, width(session_of(docs)))
    rows = rows.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    rows = rows.select(F.spark_partition_id().alias("part"), "doc_id", "body")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        part, seq, doc_ids, blobs, size = 0, 0, [], [], 0

        def close() -> pa.RecordBatch:
            ends = np.cumsum([len(b) // coder.id_bytes for b in blobs], dtype=np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([int(ends[-1])], pa.int64()), pa.array([b"".join(blobs)], pa.binary()),
                pa.array([coder.id_bytes], pa.int32()), pa.array([ef_encode(ends)], pa.binary())],
                ["part", "seq", "doc_ids", "n_tokens", "ids", "id_bytes", "ends"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            texts = (x.as_py() for x in batch.column(2))
            for doc_id, blob in zip(batch.column(1).to_pylist(), coder.encode(texts)):
                doc_ids.append(doc_id)
                blobs.append(blob)
                size += len(blob)
                if size >= shard_bytes:
                    yield close()
                    seq, doc_ids, blobs, size = seq + 1, [], [], 0
        if blobs:
            yield close()

    rows.mapInArrow(shards, _SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a token table: doc_id, start, n_tokens, ids_crc32.

    Offsets inside a shard come from the Elias-Fano code; the shard's own start is the
    sum of all earlier shards: a running sum over range partitions (one row each) and
    one inside each partition.
    """
    shards = spark.read.schema(_SHARD_SCHEMA).parquet(path)
    session_of(shards)
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("shard_start")))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seq, doc_ids, ids, id_bytes, code = (batch.column(c)[row].as_py() for c in range(6))
                ends = EliasFano(code).all()
                starts = np.concatenate(([0], ends[:-1]))
                flat = np.frombuffer(ids, f"<u{id_bytes}")
                crcs = [zlib.crc32(flat[a:b].astype("<u4")) for a, b in zip(starts, ends)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "seq", "doc_ids", "ids", "id_bytes", "ends").mapInArrow(
        documents, "part int, seq int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token table into the shared folder and read it back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    keep_track(spark, path)
    write_tokens(docs, tokenizer, path)
    return read_tokens(spark, path)
