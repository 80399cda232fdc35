import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from dealscope.llm import conversations as C
from dealscope.llm.queries import op13_conversation_repair

from .helpers import SF2, ordered, plain, table

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, n int"


# ---------------------------------------------------------------- brute force

def brute_damage(rows):
    """conv_id -> rows (turn, role, text) after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 1:
            text = ""
        elif h == 2:
            text = re.sub("[.!?]", "", text)
        elif h == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def brute_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None)
        seen.add((role, text))
    return faults


def brute_audit(roles, faults):
    """(cost, audit, repaired) by trying every edit from every prefix state, no runs and no powers."""
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    best = {q: (0, "", ()) if q in ("", "a") else None for q in grammar}

    def insert(best):
        for _ in range(4):
            for q in grammar:
                for letter, to in grammar[q].items():
                    if letter in names and best[to] is not None:
                        cost, audit, out = best[to]
                        new = (cost + 3, "I" + audit, ((names[letter], None), *out))
                        best[q] = new if best[q] is None else min(best[q], new, key=lambda x: x[:2])
        return best

    best = insert(best)
    for i in range(len(roles) - 1, -1, -1):
        now = {}
        for q in grammar:
            options = []
            if best[q]:
                options.append((best[q][0] + 4, "D" + best[q][1], best[q][2]))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                to = grammar[q].get(roles[i][:1])
                if to and best[to]:
                    options.append((best[to][0] + extra, "K" + best[to][1], ((roles[i], i), *best[to][2])))
                for letter, to in grammar[q].items():
                    if letter in names and best[to]:
                        options.append((best[to][0] + 3 + extra, "R" + best[to][1], ((names[letter], i), *best[to][2])))
            now[q] = min(options, key=lambda x: x[:2]) if options else None
        best = insert(now)
    return best[""]


def brute(rows):
    after, out = brute_damage(rows), []
    for conv in {r[0] for r in rows}:
        found = after.get(conv, [])
        faults, roles = brute_faults(found), [r[1] for r in found]
        turns = [r[0] for r in found if r[0] is not None]
        cost, audit, repaired = brute_audit(roles, faults)
        text = "\n".join(f"{role}:{'' if i is None else found[i][2]}" for role, i in repaired)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


# ---------------------------------------------------------------- tests

def test_equals_brute_force(spark):
    rows = plain(table(spark, SF2, "conversations"), "conv_id", "turn", "role", "text")
    assert ordered(plain(op13_conversation_repair(spark, SF2), *COLUMNS)) == ordered(brute(rows))


def test_solve_equals_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        runs = []
        for _ in range(rng.randrange(7)):
            runs.append((rng.randrange(16), rng.choice((1, 1, 1, 2, 3, 9))))
        roles = [(C.CLASSES + "x")[s // 4] for s, n in runs for _ in range(n)]
        faults = [(None, "blank", "duplicate", "truncated")[s % 4] for s, n in runs for _ in range(n)]
        cost, audit, _ = brute_audit(roles, faults)
        assert C.solve(runs) == audit
        assert C.cost_of(audit, C._truncated_kept(runs, audit)) == cost
        whole = C.matrix_of(runs)
        assert min(whole[C.START][j] + C.FINAL[j] for j in range(4)) == cost


@pytest.mark.parametrize("symbol", range(16))
def test_long_runs(symbol):
    """Halving by powers gives what row after row gives, and a million rows are no harder."""
    for n in (31, 32, 33, 70, 257):
        one_by_one = C.solve([(symbol, 1)] * n)
        assert C.solve([(symbol, n)]) == one_by_one
    audit = C.solve([(4, 1), (symbol, 1_000_000), (8, 1)])
    assert len(audit.replace("I", "")) == 1_000_002


def edge_rows():
    rng = random.Random(9)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "a."), (1, None, "user", "a."), (1, 0, None, "b"),
            (2, 5, "", "x."), (2, 9, "User", "y!"), (2, 7, "assistant", " \t\n"), (3, 1, "assistant", "long " * 20000 + "."),
            (4, 0, "system", "s."), (5, 0, "system", "s."), (5, 1, "user", "ü?"), (5, 2, "assistant", "日本.")]
    rows += [(6, t, rng.choice(("user", "assistant")), f"same {rng.randrange(3)}.") for t in range(40)]
    rows += [(7, 3, "user", "tie."), (7, 3, "assistant", "tie."), (7, 3, "user", "other")]
    return rows


def test_edges(spark):
    rows = edge_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert ordered(plain(C.repair(docs), *COLUMNS)) == ordered(brute(rows))
    dropped = next(i for i in range(100, 200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    gone = plain(C.repair(spark.createDataFrame([(dropped, 0, "user", "Hi.", None, 1)], SCHEMA)), *COLUMNS)
    assert gone == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def hot_rows():
    rng = random.Random(4)
    hot = [(1, t, ("user", "assistant")[(t + (rng.random() < 0.1)) % 2], f"t{rng.randrange(400)}{rng.choice(('.', '!', '', ' '))}") for t in range(3000)]
    same = [(2, 0, "user", "again and again.")] * 3000
    return hot + same + [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(3, 300) for t in range(4)]


def test_hot_conversation_spreads_over_ranges(spark):
    """Two conversations with most rows: one of different rows, cut at range borders, one of equal rows, counted."""
    rows = hot_rows()
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    found = C.segments(C.digests(C.damage(docs))).where("conv_id = 1 AND open")
    assert found.count() >= 3
    assert ordered(plain(C.repair(docs), *COLUMNS)) == ordered(brute(rows))


def test_repaired_rows_match_the_grammar(spark):
    out = defaultdict(list)
    for r in C.repaired_rows(table(spark, SF2, "conversations")).orderBy("conv_id", "position").collect():
        out[r.conv_id].append((r.role, r.text))
    hashes = {r.conv_id: r.repaired_sha256 for r in op13_conversation_repair(spark, SF2).collect()}
    for conv, rows in out.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in rows))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in rows).encode()).hexdigest() == hashes[conv]
