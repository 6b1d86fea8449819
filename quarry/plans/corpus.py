"""Corpus preparation queries (clean, length filter, dedup, split, stats)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import (
    CONTROL_CHARS_RE,
    HTML_TAG_RE,
    NEWLINE_RUN_RE,
    PY_WHITESPACE,
    SPACE_RUN_RE,
    compress_whitespace,
    parse_replacement_rules,
    py_strip,
    remove_html_tags,
)
from quarry.operators.clean import annotate_corpus, clean_report, dedup_exact, split_stats, with_text
from quarry.operators.stats import length_stats
from quarry.plans.oracle_views import DIRTY_DOCS
from quarry.sources.adapters import dirty_docs
from quarry.sources.tables import read_table

# Query parameters (fixed per query; the library defaults are the reference's).
MIN_LENGTH = 50
MAX_LENGTH = 0  # no upper limit
LONG_AT = 5000  # only in the query that shows the rule for long documents
TRUNCATE_AT = 2000
VALID_RATIO = 0.01
RULES = ["é=e", "ß=ss", "\t=\\u0020"]


def annotated(spark, sf_dir, rules=(), max_length=MAX_LENGTH, action="drop"):
    return annotate_corpus(
        dirty_docs(spark, sf_dir), rules=rules, html=True, min_length=MIN_LENGTH,
        max_length=max_length, action=action, valid_ratio=VALID_RATIO,
    )


def q_clean_flags(spark, sf_dir):
    return annotated(spark, sf_dir).drop("text_clean")


def q_clean_report(spark, sf_dir):
    return clean_report(annotated(spark, sf_dir))


def q_exact_dedup(spark, sf_dir):
    return dedup_exact(annotated(spark, sf_dir)).select("doc_id", "doc_hash", "split", "n_chars")


def q_split_stats(spark, sf_dir):
    return split_stats(dedup_exact(annotated(spark, sf_dir)))


def q_length_stats(spark, sf_dir):
    return length_stats(dedup_exact(annotated(spark, sf_dir)), "n_chars")


def q_length_truncate(spark, sf_dir):
    a = annotated(spark, sf_dir, max_length=TRUNCATE_AT, action="truncate")
    return dedup_exact(a).select("doc_id", "n_chars", "doc_hash", "split")


def q_clean_with_rules(spark, sf_dir):
    a = annotated(spark, sf_dir, rules=parse_replacement_rules(RULES))
    return a.select("doc_id", "n_chars", "drop_reason", "doc_hash")


def q_length_drop_long(spark, sf_dir):
    return clean_report(annotated(spark, sf_dir, max_length=LONG_AT))


def q_html_strip(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    stripped = remove_html_tags("html")
    text = py_strip(compress_whitespace(stripped))
    return p.select(
        "page_id",
        (F.length(stripped) != F.length("html")).alias("html_mod"),
        F.length(text).alias("n_chars"),
        F.sha2(text, 256).alias("text_hash"),
    )


def q_split_text(spark, sf_dir):
    """Text sink rendering: doc + newline + separator line, per split (A5)."""
    a = annotated(spark, sf_dir)
    kept = with_text(dedup_exact(a), a)
    body = F.concat(F.col("text_clean"), F.lit("\n"), F.lit("###"), F.lit("\n"))
    return kept.select("doc_id", "split", F.sha2(body, 256).alias("rendered_hash"), F.length(body).alias("rendered_len"))


QUERIES = {
    "clean_flags": q_clean_flags,
    "clean_report": q_clean_report,
    "exact_dedup": q_exact_dedup,
    "split_stats": q_split_stats,
    "length_stats": q_length_stats,
    "length_truncate": q_length_truncate,
    "length_drop_long": q_length_drop_long,
    "clean_with_rules": q_clean_with_rules,
    "html_strip": q_html_strip,
    "split_text": q_split_text,
}

# ---------------------------------------------------------------- oracle SQL
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def _rules_sql(expr: str, rules) -> str:
    for old, new in parse_replacement_rules(rules):
        o = " || ".join(f"chr({ord(c)})" for c in old)
        n = " || ".join(f"chr({ord(c)})" for c in new) or "''"
        expr = f"replace({expr}, {o}, {n})"
    return expr


def annotated_sql(rules=(), max_length=MAX_LENGTH, action="drop") -> str:
    s1 = _rules_sql("s0", rules)
    long_rule = f"WHEN length(tc0) > {max_length} THEN 'long'" if action == "drop" and max_length else ""
    tc = f"CASE WHEN length(tc0) > {max_length} THEN substr(tc0, 1, {max_length}) ELSE tc0 END" if action == "truncate" else "tc0"
    return f"""{DIRTY_DOCS},
c0 AS (SELECT doc_id, trim(text, {WS_SQL}) AS s0 FROM dirty_docs),
c1 AS (SELECT doc_id, s0, {s1} AS s1 FROM c0),
c2 AS (SELECT *, regexp_replace(s1, '{CONTROL_CHARS_RE}', '', 'g') AS s2 FROM c1),
c3 AS (SELECT *, regexp_replace(s2, '{HTML_TAG_RE}', '', 'g') AS s3 FROM c2),
c4 AS (SELECT *, regexp_replace(regexp_replace(s3, '{SPACE_RUN_RE}', ' ', 'g'), '{NEWLINE_RUN_RE}', chr(10) || chr(10), 'g') AS s4 FROM c3),
c5 AS (SELECT doc_id,
         (length(s2) <> length(s1) AND length(s0) > 0) AS ctrl_mod,
         (length(s3) <> length(s2) AND length(s0) > 0) AS html_mod,
         (s4 <> s3 AND length(s0) > 0) AS ws_mod,
         CASE WHEN length(s0) > 0 THEN trim(s4, {WS_SQL}) ELSE '' END AS tc0 FROM c4),
c6 AS (SELECT *, CASE WHEN length(tc0) = 0 THEN 'empty' WHEN length(tc0) < {MIN_LENGTH} THEN 'short' {long_rule} END AS drop_reason FROM c5),
ann AS (SELECT doc_id, ctrl_mod, html_mod, ws_mod, drop_reason, {tc} AS text_clean FROM c6),
annotated AS (SELECT doc_id, text_clean, CAST(length(text_clean) AS BIGINT) AS n_chars, drop_reason, ctrl_mod, html_mod, ws_mod,
  CASE WHEN drop_reason IS NULL THEN sha256(text_clean) END AS doc_hash,
  CASE WHEN drop_reason IS NULL THEN (CASE WHEN ('0x' || substr(sha1(text_clean), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < {VALID_RATIO} THEN 'valid' ELSE 'train' END) END AS split
  FROM ann),
kept AS (SELECT * FROM annotated WHERE drop_reason IS NULL
  AND doc_id IN (SELECT min(doc_id) FROM annotated WHERE drop_reason IS NULL GROUP BY doc_hash))"""


def _pct_sql(p: int) -> str:
    k = f"((n - 1) * {p} / 100)"
    lo = f"l[CAST(floor({k}) AS BIGINT) + 1]"
    hi = f"l[CAST(ceil({k}) AS BIGINT) + 1]"
    return f"CAST(CASE WHEN floor({k}) = ceil({k}) THEN {lo} ELSE floor({lo} * (ceil({k}) - {k}) + {hi} * ({k} - floor({k}))) END AS BIGINT) AS p{p}"


def length_stats_sql(src_cte: str) -> str:
    # src_cte defines `src(v)`
    pcts = ", ".join(_pct_sql(p) for p in (25, 75, 95, 99))
    return f"""{src_cte},
s AS (SELECT list_sort(list(v)) AS l, count(*) AS n, sum(v) AS tot, min(v) AS mn, max(v) AS mx FROM src)
SELECT n AS count, mn AS min, mx AS max, tot / n AS mean,
  CAST(floor((l[CAST(CASE WHEN n % 2 = 0 THEN n // 2 - 1 ELSE n // 2 END AS BIGINT) + 1] + l[n // 2 + 1]) / 2) AS BIGINT) AS median,
  {pcts}, CAST(tot AS BIGINT) AS total_chars FROM s"""


REPORT_SQL = """SELECT count(*) AS total_raw_documents,
  count(*) FILTER (WHERE drop_reason = 'empty') AS skipped_empty,
  count(*) FILTER (WHERE drop_reason = 'short') AS skipped_short,
  count(*) FILTER (WHERE drop_reason = 'long') AS skipped_long,
  count(*) FILTER (WHERE html_mod) AS cleaned_html,
  count(*) FILTER (WHERE ctrl_mod) AS cleaned_control_chars,
  count(*) FILTER (WHERE ws_mod) AS compressed_whitespace,
  count(*) FILTER (WHERE drop_reason IS NULL) - (SELECT count(*) FROM kept) AS duplicates_removed,
  (SELECT count(*) FROM kept) AS total_kept,
  1 - (SELECT count(*) FROM kept) / count(*) AS filter_rate
FROM annotated"""

ORACLE = {
    "clean_flags": f"WITH {annotated_sql()} SELECT doc_id, n_chars, drop_reason, ctrl_mod, html_mod, ws_mod, doc_hash, split FROM annotated",
    "clean_report": f"WITH {annotated_sql()} {REPORT_SQL}",
    "length_drop_long": f"WITH {annotated_sql(max_length=LONG_AT)} {REPORT_SQL}",
    "exact_dedup": f"WITH {annotated_sql()} SELECT doc_id, doc_hash, split, n_chars FROM kept",
    "split_stats": f"""WITH {annotated_sql()}
SELECT split, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS characters, sum(n_chars) / count(*) AS avg_doc_length
FROM kept GROUP BY split""",
    "length_stats": length_stats_sql(f"WITH {annotated_sql()}, src AS (SELECT n_chars AS v FROM kept)"),
    "length_truncate": f"WITH {annotated_sql(max_length=TRUNCATE_AT, action='truncate')} SELECT doc_id, n_chars, doc_hash, split FROM kept",
    "clean_with_rules": f"WITH {annotated_sql(rules=RULES)} SELECT doc_id, n_chars, drop_reason, doc_hash FROM annotated",
    "html_strip": f"""SELECT page_id, length(s) <> length(html) AS html_mod, CAST(length(t) AS BIGINT) AS n_chars, sha256(t) AS text_hash
FROM (SELECT page_id, html, s, trim(regexp_replace(regexp_replace(s, '{SPACE_RUN_RE}', ' ', 'g'), '{NEWLINE_RUN_RE}', chr(10) || chr(10), 'g'), {WS_SQL}) AS t
      FROM (SELECT page_id, html, regexp_replace(html, '{HTML_TAG_RE}', '', 'g') AS s FROM pages))""",
    "split_text": f"""WITH {annotated_sql()}
SELECT doc_id, split, sha256(text_clean || chr(10) || '###' || chr(10)) AS rendered_hash,
  CAST(length(text_clean) + 5 AS BIGINT) AS rendered_len FROM kept""",
}
