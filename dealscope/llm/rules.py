"""Quality rules (operator 2): a ledger of rule failure bits and measurements.

:func:`ledger` evaluates every rule once per document and stores one failure bit per rule
next to the measurements.  :func:`apply_policy` turns the stored bits into verdicts under a
named, versioned policy (a bit mask), and :func:`ablation` computes from the bits alone what
each rule of a policy removes, by itself and beside the others, in one aggregation
(:func:`ablations`: of all policies).

Edge cases: NULL and empty texts have no words, so they fail the base rule on the word
count; repeated rows are judged one by one; an empty table gives an empty ledger; other
columns are ignored by :func:`ledger`.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm.common import session_of, utf8

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_DROP = SPACE + bytes(range(0x80, 0xC0))           # leaves one byte per code point of a word
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LETTERS = _UPPER + _UPPER.lower()
_MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, "
             "n_repeat_words bigint, n_upper bigint, n_letters bigint")

#: Rule name -> condition (SQL over the measurements) under which a document fails.  The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "shouting": "n_letters >= 100 AND 10 * n_upper > 6 * n_letters",
}
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules whose failure drops a document.
POLICIES: dict[str, tuple[str, ...]] = {"base-1": BASE, "strict-1": tuple(RULES)}
DEFAULT_POLICY = "strict-1"


def mask(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of the ledger's columns."""
    words = text.split()
    seen: set[bytes] = set()
    n_lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip(SPACE):
            n_lines += 1
            dup += line in seen
            seen.add(line)
    repeat = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    counts = Counter(windows)
    if len(counts) < len(windows):
        covered = 0                                # words below this position are counted already
        for at, w in enumerate(windows):
            if counts[w] > 1:
                repeat += at + 5 - max(at, covered)
                covered = at + 5
    n = len(text)
    return (len(words), len(text.translate(None, _DROP)), n - len(text.translate(None, SYMBOLS)), n_lines, dup, repeat,
            n - len(text.translate(None, _UPPER)), n - len(text.translate(None, _LETTERS)))


def _measured(bodies: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(b) for b in bodies], columns=[c.split()[0] for c in _MEASURES.split(", ")])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and ``fail_bits``: bit k is set if rule k fails."""
    session_of(docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(_measured, _MEASURES)(utf8(text_col)).alias("m")).select("doc_id", "m.*")
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << k}L ELSE 0L END" for k, rule in enumerate(RULES.values()))
    return rows.withColumn("fail_bits", F.expr(bits))


def failed(bits: Column, rules: tuple[str, ...]) -> Column:
    return bits.bitwiseAND(F.lit(mask(rules))) != 0


def apply_policy(book: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a named policy."""
    bits = F.col("fail_bits")
    return book.withColumn("base_failed", failed(bits, BASE)) \
               .withColumn("kept", ~F.col("base_failed") & ~failed(bits, POLICIES[policy]))


def ablations(book: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """One row per policy and rule of it: documents failing it, failing it alone (which would stay
    without it), kept by the policy, and kept without the rule."""
    order = list(RULES)
    # Documents with equal bits are one row from here on: at most 2 ** len(RULES).
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(mask(POLICIES[p])).cast("bigint").alias("whole"),
                                         F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("bigint").alias("bit"))
                                for p in policies for r in POLICIES[p]]))
    p = patterns.select("n", "fail_bits", rules.alias("r")).select("n", "r.*", F.col("fail_bits").bitwiseAND(F.col("r.whole")).alias("bits"))
    hit, rest = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    return p.groupBy("policy", "rule").agg(total(hit).alias("n_failed"), total(F.col("bits") == F.col("bit")).alias("n_alone"),
                                           total(F.col("bits") == 0).alias("n_kept"), total(rest == 0).alias("n_kept_without"))


def ablation(book: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """:func:`ablations` of one policy, without its name."""
    return ablations(book, (policy,)).drop("policy")
