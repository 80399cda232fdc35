"""Small edge tables shared by the operator tests."""

import random

from dealscope.llm.common import table  # noqa: F401

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp int, body int, size string, copies int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """NULLs in every column, empty and blank texts, a very long text, repeated rows, one id with
    two texts, equal texts under several ids."""
    rng = random.Random(5)
    a, b = words(rng, 40), words(rng, 60)
    rows = [(1, a, "en", "s1"), (2, b, "en", "s1"), (3, a, "de", "s2"), (4, None, "en", "s2"), (5, "", None, None),
            (6, " \t\n ", "en", None), (7, "one", "en", "s3"), (8, "one two", "fr", "s3"), (None, b, "en", "s1"),
            (None, None, None, None), (2, b, "en", "s1"), (9, words(rng, 60), "en", "s2"), (9, words(rng, 70), "en", "s2"),
            (10, words(rng, 20000, 5000), "en", "s1"), (11, "Ünïcode ß\x1c日本 " * 9, "de", "s3"), (12, a + " tail", "en", "s1")]
    return [(*r, None if r[1] is None else len(r[1]), "x", 1, 2, "y", None) for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=repr)
