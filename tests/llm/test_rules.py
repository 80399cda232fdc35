import re
from collections import Counter

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import rules
from dealscope.llm.queries import ORACLE, op2_quality_rules

from .helpers import SF, edge_docs, no_docs, ordered, plain, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    hit = {i + j for i, x in enumerate(windows) if counts[x] > 1 for j in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(hit),
            len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text)))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab A#|\n\t\x0b\x1cé日😀"), max_size=60))
def test_measure(text):
    assert rules.measure(text.encode()) == brute(text)


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(ORACLE["op2_quality_rules"])
    names = [c[0] for c in found.description]
    ours = op2_quality_rules(spark, SF)
    assert sorted(ours.columns) == sorted(names)
    assert ordered(plain(ours, *names)) == ordered(found.fetchall())


def test_edges_policies_and_ablation(spark):
    book = rules.ledger(edge_docs(spark)).cache()
    rows = rules.apply_policy(book).collect()
    assert len(rows) == edge_docs(spark).count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (4, 5, 6))
    for policy, names in rules.POLICIES.items():
        judged = rules.apply_policy(book, policy).collect()
        failing = [{n for k, n in enumerate(rules.RULES) if r.fail_bits >> k & 1} for r in judged]
        assert [r.kept for r in judged] == [not (f & set(names)) for f in failing]
        for r in rules.ablation(book, policy).collect():
            rest = set(names) - {r.rule}
            assert r.n_failed == sum(r.rule in f for f in failing)
            assert r.n_alone == sum(f & set(names) == {r.rule} for f in failing)
            assert (r.n_kept, r.n_kept_without) == (sum(not f & set(names) for f in failing), sum(not f & rest for f in failing))
    assert rules.apply_policy(rules.ledger(no_docs(spark))).collect() == []


def test_ablation_query(spark):
    from dealscope.llm.queries import QUERIES

    def failing(text):
        words, chars, symbols, n_lines, dup, repeat, upper, letters = brute(text or "")
        found = {"few_words": words < 10, "repeated_windows": 100 * repeat > 20 * words, "short_words": chars < 2 * words,
                 "long_words": chars > 20 * words, "symbols": 4 * symbols > words, "repeated_lines": 2 * dup > n_lines,
                 "shouting": letters >= 100 and 10 * upper > 6 * letters}
        return {r for r, x in found.items() if x}

    fails = [failing(t) for t, in plain(table(spark, SF, "documents"), "text")]
    want = [(p, r, sum(r in f for f in fails), sum(f & set(names) == {r} for f in fails), sum(not f & set(names) for f in fails),
             sum(not f & (set(names) - {r}) for f in fails)) for p, names in rules.POLICIES.items() for r in names]
    got = plain(QUERIES["op2_rule_ablation"](spark, SF), "policy", "rule", "n_failed", "n_alone", "n_kept", "n_kept_without")
    assert sorted(got) == sorted(want)
    # The verdicts of both policies are columns of op2 already.
    for r in op2_quality_rules(spark, SF).collect():
        assert (not r.base_failed, r.kept) == tuple(not r.fail_bits & rules.mask(rules.POLICIES[p]) for p in ("base-1", "strict-1"))
