import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dealscope.llm import tokens
from dealscope.llm.queries import op8_token_output

from .helpers import SF, edge_docs, no_docs, ordered, plain, table

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 129, 1000])
@pytest.mark.parametrize("step", [1, 3, 10000])
def test_elias_fano(n, step):
    ends = np.cumsum(np.random.default_rng(n).integers(0, step, n))
    code = tokens.EliasFano(tokens.ef_encode(ends))
    assert code.all().tolist() == ends.tolist() == [code.select(i) for i in range(n)]
    with pytest.raises(IndexError):
        code.select(n)


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(0, 2000, 10000))
    assert len(tokens.ef_encode(ends)) * 8 < 10000 * (2 + 10 + 1)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    path, rng = public_tokenizers.path(name), random.Random(3)
    parts = [*"abcTHK .,;:!?'\"-*&% \n\t", "é", "H̱", "é", "İ", "Σ", "ς", " ", " ", "\x1c", "\x85", "<|endoftext|>", "<|ENDOFTEXT|>",
             "'s", "'S", "1", "٣", "日本", "̸", "ſ", "K", "​", "🙂", "don't", "THE", "ß", "ﬁ", "ä", "È", "×", "÷", "***", "#", "$$$", "[", "`", "{~", "ÿ", "ñandú", "<", "|"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    coder, library = tokens.WordEncoder(path), Tokenizer.from_file(path)
    for text, blob in zip(texts, coder.encode(t.encode() for t in texts)):
        assert np.frombuffer(blob, coder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids + [1], text


def test_long_words_are_not_kept():
    coder = tokens.WordEncoder(WORDS)
    texts = [("".join(chr(0x4e00 + (i * 7919 + k) % 20000) for k in range(3000)) + f"{i}").encode() for i in range(50)]
    library = Tokenizer.from_file(WORDS)
    for text, blob in zip(texts, coder.encode(texts)):
        assert np.frombuffer(blob, coder.dtype).tolist() == library.encode(text.decode(), add_special_tokens=False).ids + [1]
    assert sum(map(len, coder._cache)) < 50 * tokens.CACHE_BYTES


def expected(rows):
    library, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark):
    rows = plain(table(spark, SF, "documents").orderBy("doc_id"), "doc_id", "text")
    assert ordered(plain(op8_token_output(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")) == ordered(expected(rows))


def test_many_shards_round_trip(spark, scratch):
    docs = table(spark, SF, "documents")
    tokens.write_tokens(docs, WORDS, f"{scratch}/t", shard_bytes=2000)
    assert spark.read.parquet(f"{scratch}/t").count() > 50
    rows = plain(docs.orderBy("doc_id"), "doc_id", "text")
    assert ordered(plain(tokens.read_tokens(spark, f"{scratch}/t"), "doc_id", "start", "n_tokens", "ids_crc32")) == ordered(expected(rows))


def test_edges(spark):
    docs = edge_docs(spark)
    rows = plain(docs, "doc_id", "text")
    got = sorted(plain(tokens.encode_documents(docs, WORDS), "start", "n_tokens", "doc_id", "ids_crc32"))
    assert len(got) == len(rows)
    ends = np.cumsum([n for _, n, _, _ in got])
    assert [s for s, *_ in got] == [0, *ends[:-1].tolist()]
    ids = [d for _, _, d, _ in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = ordered((d, n, c) for d, t in rows for _, _, n, c in expected([(d, t)]))
    assert ordered((d, n, c) for _, n, d, c in got) == want
    assert tokens.encode_documents(no_docs(spark), WORDS).collect() == []
