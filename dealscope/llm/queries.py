"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from dealscope.llm import conversations, decontaminate, fim, language, lines, mixing, pages, quality, rules, simhash, suffixes, tokens, toxicity
from dealscope.llm.common import table


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))


def op2_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ablations(rules.ledger(table(spark, sf_dir, "documents")))


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")
    return found.withColumn("has_repeats", F.col("n_removed") > 0)      # the verdict on the document, stated


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                             table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[f"contamination.{c}" for c in
                                    ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(table(spark, sf_dir, "documents"), _tokenizer())


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"), keep_text=False).drop("kept", "rest")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(table(spark, sf_dir, "documents"), keep_text=False).drop("output")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_quality_rules, op3_toxicity_chain, op4_source_mixing,
    op5_simhash, op6_suffix_dedup, op7_benchmark_decontamination, op8_token_output, op9_html_extraction, op10_line_dedup,
    op11_fill_in_middle, op12_language_id, op13_conversation_repair, op2_rule_ablation)}
QUERIES["pipeline"] = corpus_pipeline.run

_WORDS = r"[^\x20\x09-\x0D]+"

_OP2_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
lines AS (
  SELECT k, line, count(*) AS n FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_WORDS}') GROUP BY ALL),
line_sums AS (SELECT k, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM lines GROUP BY k),
win AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, five) AS n
  FROM (SELECT k, i, list_slice(w, i, i + 4) AS five FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d))),
rep AS (
  SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS j FROM win WHERE n > 1) GROUP BY k),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         (length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')))::BIGINT AS n_letters
  FROM d LEFT JOIN line_sums USING (k) LEFT JOIN rep USING (k)),
f AS (
  SELECT *, ({' + '.join(f'CASE WHEN {c} THEN {1 << k} ELSE 0 END' for k, c in enumerate(rules.RULES.values()))})::BIGINT AS fail_bits
  FROM m)
SELECT *, fail_bits & {rules.mask(rules.BASE)} <> 0 AS base_failed,
       fail_bits & {rules.mask(rules.POLICIES[rules.DEFAULT_POLICY])} = 0 AS kept FROM f
"""

_OP7_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OP7_SQL = rf"""
WITH low AS (
  SELECT 'd' AS side, row_number() OVER () AS k, NULL AS item,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, doc_id FROM documents
  UNION ALL
  SELECT 'b', 0, item_id::VARCHAR, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), NULL FROM benchmark),
w AS (SELECT *, regexp_extract_all(coalesce(t, ''), '{_OP7_WORD}') AS ws FROM low),
pat AS (
  SELECT DISTINCT item, list_slice(ws, i, i + m - 1) AS p, m FROM (
    SELECT item, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM w WHERE side = 'b' AND len(ws) > 0)),
win AS (
  SELECT k, i, m, list_slice(ws, i, i + m - 1) AS p FROM (
    SELECT k, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
    FROM w CROSS JOIN (SELECT DISTINCT m FROM pat) WHERE side = 'd' AND len(ws) >= m)),
hit AS (SELECT k, i, m, item FROM win JOIN pat USING (m, p)),
pos AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + m)) AS j FROM hit) GROUP BY k),
its AS (SELECT k, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT k, item FROM hit) GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256,
       coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN pos USING (k) LEFT JOIN its USING (k) WHERE side = 'd'
"""


# Lines, cuts and texts by string functions; the restored text is parsed from the output alone.
_OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls FROM documents),
c AS (
  SELECT *, len(ls)::BIGINT AS n, [('0x' || h[i:i + 7])::BIGINT FOR i IN [1, 9, 17, 25]] AS hs FROM d),
k AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS x, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR hs[3] % 100 >= 100 THEN 'plain'
              WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (
  SELECT *, array_to_string(ls[1:x], '') AS pre, array_to_string(ls[x + 1:y], '') AS mid, array_to_string(ls[y + 1:], '') AS suf FROM k),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM p),
b AS (
  SELECT *, CASE form WHEN 'psm' THEN regexp_extract(output, '(?s)^<P>(.*?)<S>(.*?)<M>(.*)$', ['one', 'two', 'mid'])
                      WHEN 'spm' THEN regexp_extract(output, '(?s)^<S>(.*?)<P>(.*?)<M>(.*)$', ['two', 'one', 'mid'])
                      END AS back FROM o)
SELECT doc_id, n, form, if(form = 'plain', NULL, length(pre)) AS prefix_chars, if(form = 'plain', NULL, length(mid)) AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output ELSE back.one || back.mid || back.two END) AS restored_sha256
FROM b
"""


def _op13_sql() -> str:
    """The edits row by row from the last one: per state the least (cost, audit) with its repaired rows."""
    none, nothing = ("{c: 1000000, a: 'Z', r: []::VARCHAR[]}", "{c: 0, a: '', r: []::VARCHAR[]}")
    ends = {"": nothing, "s": none, "u": none, "a": nothing}
    give = {"": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    keep = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}

    def edit(letter: str, cost: str, value: str, line: str | None) -> str:
        rows = f"list_prepend({line}, {value}.r)" if line else f"{value}.r"
        return f"{{c: {value}.c + {cost}, a: '{letter}' || {value}.a, r: {rows}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def inserted(value: dict[str, str]) -> dict[str, str]:
        once = {q: edit("I", "3", value[give[q][0]], f"'{give[q][1]}:'") for q in value}
        out = {q: [value[q], once[q]] for q in value}
        for q in ("", "s"):                                # a user and an assistant
            out[q].append(f"{{c: {value['a']}.c + 6, a: 'II' || {value['a']}.a, "
                          f"r: list_prepend('user:', list_prepend('assistant:', {value['a']}.r))}}")
        return {q: least(*o) for q, o in out.items()}

    names = {"": "v0", "s": "v1", "u": "v2", "a": "v3"}
    after = {q: f"w.{v}" for q, v in names.items()}
    step = {}
    for q in names:
        options = [edit("D", "4", after[q], None)]
        for to in keep[q]:
            kept = edit("K", "extra", after[to], "role || ':' || text")
            options.append(f"if(NOT forced AND initial = '{to}', {kept}, {none})")
        to, role = give[q]
        given = edit("R", "3 + extra", after[to], f"'{role}:' || text")
        options.append(f"if(NOT forced, {given}, {none})")
        step[q] = least(*options)
    first = inserted(ends)
    return rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten([[(ord(ch)::UBIGINT >> b) & 1 FOR b IN range(8)] FOR ch IN string_split(name, '')])),
                lambda crc, bit: if(xor(crc & 1, bit) = 1, xor(crc >> 1, 3988292384::UBIGINT), crc >> 1)), 4294967295::UBIGINT) % 20 AS h FROM raw),
worn AS (
  SELECT conv_id, turn, if(h = 4, 'user', role) AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(if(h = 3, 2, 1))) AS copy FROM hit WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM worn),
again AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice FROM placed),
fault AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN twice THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS f,
         role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM again),
ready AS (
  SELECT *, f IN ('blank', 'duplicate') AS forced, if(f = 'truncated', 3, 0) AS extra,
         count(*) OVER (PARTITION BY conv_id) - i AS left_after FROM fault),
walk AS (
  SELECT conv_id, -1::BIGINT AS done, {', '.join(f'{first[q]} AS {v}' for q, v in names.items())}
  FROM (SELECT DISTINCT conv_id FROM ready)
  UNION ALL
  SELECT conv_id, done, {', '.join(f'{x} AS {v}' for v, x in zip(names.values(), inserted({q: f'w.{v}' for q, v in names.items()}).values()))}
  FROM (SELECT w.conv_id, ready.left_after AS done, {', '.join(f'{step[q]} AS {v}' for q, v in names.items())}
        FROM walk w JOIN ready ON ready.conv_id IS NOT DISTINCT FROM w.conv_id AND ready.left_after = w.done + 1) w),
solved AS (SELECT conv_id, arg_max(v0, done) AS v FROM walk GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(f = 'blank') AS blank,
         count_if(f = 'duplicate') AS duplicate, count_if(f = 'truncated') AS truncated,
         count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.c, 0)::BIGINT AS cost,
       coalesce(v.a, '') AS audit, sha256(coalesce(array_to_string(v.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
"""


ORACLE = {"op2_quality_rules": _OP2_SQL, "op7_benchmark_decontamination": _OP7_SQL, "op11_fill_in_middle": _OP11_SQL,
          "op13_conversation_repair": _op13_sql()}
