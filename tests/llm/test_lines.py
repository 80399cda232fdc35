import hashlib
import random

from dealscope.llm import lines
from dealscope.llm.queries import op10_line_dedup

from .helpers import SF, edge_docs, no_docs, ordered, plain, table


def brute(rows):
    """Remove a chunk if an earlier document (by id, NULL last) or place holds the same bytes."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    first, out = {}, []
    order = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0))
    for d, t in order:
        ls = t.split(b"\n")
        for k, (a, b) in enumerate(lines.chunks(ls)):
            first.setdefault(b"\n".join(ls[a:b]), (d, t, k))
    for d, t in texts:
        ls, left, n = t.split(b"\n"), [], 0
        for k, (a, b) in enumerate(lines.chunks(ls)):
            c = b"\n".join(ls[a:b])
            if lines._several(ls[a:b]) and first[c] != (d, t, k):
                n += 1
            else:
                left += ls[a:b]
        kept = b"\n".join(left) if n else t
        out.append((d, len(ls), len(ls) - len(left), n, hashlib.sha256(kept).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "kept_sha256")


def test_boundaries_resist_shifts():
    rng = random.Random(1)
    passage = [b"line %d" % rng.randrange(10 ** 6) for _ in range(40)]
    cut = {tuple(passage[a:b]) for a, b in lines.chunks(passage)}
    for shift in range(6):
        other = [b"x%d" % k for k in range(shift)] + passage
        assert len(cut & {tuple(other[a:b]) for a, b in lines.chunks(other)}) >= len(cut) - 1
    ranges = list(lines.chunks(passage))
    assert [x for a, b in ranges for x in range(a, b)] == list(range(40))


def test_random_passages(spark):
    rng = random.Random(2)
    shared = [[f"s{p}.{k}" for k in range(12)] for p in range(4)]
    rows = []
    for d in range(60):
        t = []
        for _ in range(rng.randrange(5)):
            t += rng.choice(shared)[rng.randrange(4):] if rng.random() < 0.6 else [f"own {rng.randrange(10 ** 6)}", ""]
        rows.append((d, "\n".join(t)))
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string"))
    assert ordered(plain(got, *COLUMNS)) == ordered(brute(rows))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())
    assert sum(r[3] for r in brute(rows)) > 20


def test_query(spark):
    rows = plain(table(spark, SF, "documents"), "doc_id", "text")
    assert ordered(plain(op10_line_dedup(spark, SF), *COLUMNS)) == ordered(brute(rows))


def test_edges(spark):
    long = "\n".join(f"row {k}" for k in range(3000))
    extra = [(20, long), (21, long), (20, long), (None, long), (22, "a\na\na\na\na\na"), (23, "\n\n\n")]
    rows = plain(edge_docs(spark), "doc_id", "text") + extra
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id bigint, text string, body int, k string")
    assert ordered(plain(lines.dedup_lines(docs), *COLUMNS)) == ordered(brute(rows))
    assert lines.dedup_lines(no_docs(spark)).collect() == []


def brute_runs(rows):
    """Line by line, without chunks(): two neighbouring lines (blank ones between them included) that an earlier
    document (by id, NULL last) or place holds go, but for a line of their own first occurrence."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    first, found = {}, []
    for d, t in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)):
        ls, gone = t.split(b"\n"), set()
        full = [i for i, x in enumerate(ls) if x.strip()]
        for a, b in zip(full, full[1:]):
            where = first.setdefault(tuple(ls[a:b + 1]), (d, t, a, b))
            if where != (d, t, a, b):
                gone |= set(range(a, b + 1)) - ({a} if where[:2] == (d, t) and where[3] == a else set())
        rest = b"\n".join(x for i, x in enumerate(ls) if i not in gone)
        found.append((d, len(gone), hashlib.sha256(rest).hexdigest()))
    return found


RUN_COLUMNS = ("doc_id", "n_repeat_lines", "rest_sha256")


def test_repeated_runs_go_whole(spark):
    rng = random.Random(3)
    shared = [[rng.choice(("", "x", f"s{p}.{k}", f"s{p}.{k}")) for k in range(20)] for p in range(4)]
    rows = []
    for d in range(60):
        t = []
        for _ in range(rng.randrange(5)):
            s = rng.choice(shared)
            a = rng.randrange(18)
            t += s[a:a + rng.randrange(1, 20)] if rng.random() < 0.6 else [f"own {rng.randrange(10 ** 6)}", ""]
        rows.append((d, "\n".join(t)))
    rows += [(60, "a\na\na\na\na"), (61, "b\nb"), (62, "c\n\nd\nc\n\nd"), (63, "c\nd"), (None, "b\nb"), (64, rows[1][1]), (64, rows[1][1])]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string"))
    assert ordered(plain(got, *RUN_COLUMNS)) == ordered(brute_runs(rows))
    assert all(hashlib.sha256(r.rest).hexdigest() == r.rest_sha256 for r in got.collect())
    left = {r.doc_id: bytes(r.rest) for r in got.where("doc_id >= 60").collect()}
    assert (left[60], left[61], left[62], left[63]) == (b"a\na", b"b\nb", b"c\n\nd", b"c\nd")


def test_passages_of_every_length(spark):
    rows = []
    for n in range(2, 42):
        passage = [f"p{n}.{k}" for k in range(n)]
        rows += [(2 * n + side, "\n".join([f"before {n}.{side}"] + passage + [f"after {n}.{side}"])) for side in (0, 1)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r.doc_id: r.n_repeat_lines for r in got} == {2 * n + side: n * side for n in range(2, 42) for side in (0, 1)}


def test_query_runs(spark):
    rows = plain(table(spark, SF, "documents"), "doc_id", "text")
    assert ordered(plain(op10_line_dedup(spark, SF), *RUN_COLUMNS)) == ordered(brute_runs(rows))
