"""Structured-output evaluation queries: per-row scores in the three
scorer modes, enum checks, value match, summaries, leaderboard."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quarry.functions.draw import draw_sql
from quarry.operators import scoring as sc
from quarry.plans.corpus import WS_SQL
from quarry.plans.derive import RELJSON
from quarry.session import stored
from quarry.sources.adapters import (
    EVAL_ALIASES, EVAL_ENUM_FIELD, EVAL_GROUPS, EVAL_INSTRUCTIONS, EVAL_MODELS, EVAL_RENAMES, EVAL_UNKNOWN_FIELD, EVAL_UNKNOWN_HEAD,
    by_id, eval_outputs, eval_prompts, eval_records, eval_rounds, eval_schema, eval_source, with_allowed,
)

SEED = 42


def scored(spark, sf_dir, value_match=False, outputs=eval_outputs, keep_parsed=False):
    # what the prompts are made from is both the outputs fixture's source and the
    # join's other side: written once.  Prompts and outputs are made from it after
    # it is dealt by id, so neither texts nor outputs are written or shuffled, and
    # they meet by id where they lie.  The allowed fields, the same for a whole
    # segment, meet the rows where these are scored.
    source = stored(eval_source(spark, sf_dir))
    schema = eval_schema(source)
    prompts = eval_records(spark, sf_dir, by_id(spark, sf_dir, source))
    o = outputs(spark, sf_dir, SEED, prompts=prompts)
    if value_match:  # in as many tasks as the prompts are dealt into: what is stored is small and few files
        prompts = sc.with_gold(prompts)
    p = prompts.select("id", "cate", "_types", "required_fields", "enum_constraints", *[c for c in prompts.columns if c == "gold_parsed"])
    return sc.score(with_allowed(o.join(p, "id"), schema), aliases=EVAL_ALIASES, with_value_match=value_match, keep_parsed=keep_parsed)


def _j(c):
    return F.array_join(c, ",")


def q_score_rows(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("model", "id", "group", "parsed", F.size("missing_fields").alias("n_missing"), _j("missing_fields").alias("missing"),
                    F.size("extra_fields").alias("n_extra"), _j("extra_fields").alias("extra"), "enum_ok", "schema_strict")


def q_score_alias(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("model", "id", _j("missing_fields_alias").alias("missing_alias"), _j("extra_fields_alias").alias("extra_alias"),
                    "schema_strict_alias")


def q_score_stability(spark, sf_dir):
    s = scored(spark, sf_dir)
    return s.select("model", "id", _j("missing_fields_stab").alias("missing_stab"), _j("extra_fields_stab").alias("extra_stab"),
                    "schema_strict_stab", "schema_strict_stab_alias")


def q_enum_check(spark, sf_dir):
    s = scored(spark, sf_dir).filter(F.col("enum_ok").isNotNull())
    v = F.array_join(F.array_sort(F.transform(F.map_entries("enum_violations"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return s.select("model", "id", "enum_ok", v.alias("violations"))


def q_value_match(spark, sf_dir):
    s = scored(spark, sf_dir, value_match=True).filter(F.col("value_match").isNotNull())
    vals = F.map_values("value_match")
    return s.select("model", "id", F.size(vals).alias("n_fields"), F.size(F.filter(vals, lambda x: x)).alias("n_match"))


def q_by_model(spark, sf_dir):
    return sc.by_model(scored(spark, sf_dir))


def q_by_group(spark, sf_dir):
    return sc.by_group(scored(spark, sf_dir))


def q_leaderboard(spark, sf_dir):
    return sc.leaderboard(sc.by_model(scored(spark, sf_dir)), EVAL_MODELS)


def q_round_wide(spark, sf_dir):
    s = scored(spark, sf_dir, outputs=eval_rounds).withColumn("round", F.col("model"))
    return sc.round_wide(s, "round")


def q_structural_quality(spark, sf_dir):
    return sc.structural_quality(scored(spark, sf_dir, keep_parsed=True), ["model", "group"])


def q_eval_totals(spark, sf_dir):
    o = eval_outputs(spark, sf_dir, SEED)

    return o.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("latency_s")).alias("total_time_s"),
                                  F.avg(F.col("latency_s")).alias("avg_latency_s"))


def prompt_text(instruction, schema, text):
    """Instruction; a ``Schema:`` line unless the instruction mentions a
    schema; the input, prefixed with ``文本:`` unless the instruction already
    refers to the text; joined by newlines."""
    from quarry.functions.text import json_string_list

    ins = F.coalesce(instruction, F.lit(""))
    parts = [F.when(F.length(ins) > 0, ins)]
    mention = ins.contains("Schema:") | F.lower(ins).contains("schema")
    parts.append(F.when((F.size(schema) > 0) & ~mention, F.concat(F.lit("Schema: "), json_string_list(schema))))
    refers = ins.contains("文本:") | ins.contains("从文本")
    parts.append(F.when(refers, F.coalesce(text, F.lit(""))).otherwise(F.concat(F.lit("文本: "), F.coalesce(text, F.lit("")))))
    return F.concat_ws("\n", *parts)


def q_prompt_text(spark, sf_dir):
    p = eval_prompts(spark, sf_dir)
    ins = F.create_map(*[F.lit(x) for kv in EVAL_INSTRUCTIONS.items() for x in kv])[F.col("group")]
    t = prompt_text(ins, F.col("allowed_fields"), F.col("input"))
    return p.select("id", "group", F.sha2(t, 256).alias("prompt_hash"), F.length(t).alias("prompt_len"))


QUERIES = {
    "score_rows": q_score_rows,
    "score_alias": q_score_alias,
    "score_stability": q_score_stability,
    "enum_check": q_enum_check,
    "value_match": q_value_match,
    "by_model": q_by_model,
    "by_group": q_by_group,
    "leaderboard": q_leaderboard,
    "round_wide": q_round_wide,
    "structural_quality": q_structural_quality,
    "eval_totals": q_eval_totals,
    "prompt_text": q_prompt_text,
}

# ---------------------------------------------------------------- oracle SQL


def rel_json_sql(expr: str) -> str:
    return "coalesce(" + re.sub(r"(?<![.\w'])relation\b(?!')", expr, RELJSON) + ", '{}')"


def _alias_case(x: str) -> str:
    m = sc.alias_lookup_map(EVAL_ALIASES)
    return "CASE " + " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in m.items()) + f" ELSE {x} END"


def _path(*parts: str) -> str:
    return "'$' || " + " || ".join(f"'.\"' || {p} || '\"'" for p in parts)


GROUPS_SQL = "[" + ", ".join(f"'{g}'" for g in EVAL_GROUPS) + "]"
MODELS_SQL = "(VALUES " + ", ".join(f"('{m}', {i})" for i, m in enumerate(EVAL_MODELS)) + ") AS mm(model, model_ord)"
RENAMED = "gold"
for _o, _n in EVAL_RENAMES:
    RENAMED = f"replace({RENAMED}, '\"{_o}\": ', '\"{_n}\": ')"
KEY = "(model || ':' || id)"
FENCE = sc.FENCE_RE
EXTRA_REL = f"list_concat(rel, [{{'head': coalesce(rel[1].head, '{EVAL_UNKNOWN_HEAD}'), 'relation': '{EVAL_UNKNOWN_FIELD[0]}', 'tail': '{EVAL_UNKNOWN_FIELD[1]}'}}])"
DROP_REL = "list_filter(rel, lambda r: r.relation <> required[1])"

EVAL_SQL = f"""rel0 AS (
  SELECT l.l_orderkey AS o_orderkey, p.p_brand AS head, p.p_type AS relation, p.p_name AS tail,
    row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity) AS pos
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
relg AS (SELECT o_orderkey, list({{'head': head, 'relation': relation, 'tail': tail}} ORDER BY pos) AS rel,
  string_agg(head || ' ' || tail, '; ' ORDER BY pos) FILTER (WHERE pos <= 4) AS first4 FROM rel0 GROUP BY 1),
schema AS (
  SELECT c.c_mktsegment AS topic, list_sort(list(DISTINCT p.p_type)) || ['WARRANTY'] AS fields
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment <> 'MACHINERY' GROUP BY 1),
psrc AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_orderkey, c.c_mktsegment AS cate, coalesce(r.rel, []::STRUCT(head VARCHAR, relation VARCHAR, tail VARCHAR)[]) AS rel,
    c.c_mktsegment || ' order: ' || coalesce(r.first4, '') AS input,
    coalesce(list_filter(list_transform(r.rel, lambda x: x.relation), lambda x, i: list_position(list_transform(r.rel, lambda y: y.relation), x) = i), []::VARCHAR[]) AS types
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN relg r ON r.o_orderkey = o.o_orderkey),
prompts AS (
  SELECT id, {GROUPS_SQL}[o_orderkey % 3 + 1] AS grp, input, rel, types[1:2] AS required,
    coalesce(s.fields, list_sort(types)) AS allowed,
    CASE WHEN list_contains(types, '{EVAL_ENUM_FIELD}') THEN MAP {{'{EVAL_ENUM_FIELD}': list_sort(list_distinct(list_transform(
      list_filter(rel[1:4], lambda r: r.relation = '{EVAL_ENUM_FIELD}'), lambda r: r.tail)))}} ELSE MAP {{}}::MAP(VARCHAR, VARCHAR[]) END AS enums,
    {rel_json_sql('rel')} AS gold
  FROM psrc LEFT JOIN schema s ON s.topic = psrc.cate),
outs0 AS (SELECT mm.model, mm.model_ord, p.*, ({draw_sql(SEED, KEY, 'class')}) % 8 AS cls,
  0.1 + (({draw_sql(SEED, KEY, 'latency')}) % 1000) / 1000.0 AS latency_s FROM prompts p CROSS JOIN {MODELS_SQL}),
outs AS (SELECT *, CASE cls WHEN 0 THEN gold WHEN 1 THEN '```json' || chr(10) || gold || chr(10) || '```'
  WHEN 2 THEN {rel_json_sql(DROP_REL)} WHEN 3 THEN {RENAMED} WHEN 4 THEN {rel_json_sql(EXTRA_REL)}
  WHEN 5 THEN substr(gold, 1, length(gold) - 1) WHEN 6 THEN 'null' ELSE '[' || gold || ']' END AS output FROM outs0),
sc1 AS (SELECT *, trim(output, {WS_SQL}) AS s0 FROM outs),
sc2 AS (SELECT *, CASE WHEN regexp_matches(s0, '{FENCE}') THEN trim(regexp_extract(s0, '{FENCE}', 1), {WS_SQL}) ELSE s0 END AS clean FROM sc1),
sc3 AS (SELECT *, json_valid(clean) AS ok, CASE WHEN json_valid(clean) THEN json_type(clean::JSON) END AS kind FROM sc2),
sc4 AS (SELECT *, CASE WHEN kind = 'OBJECT' THEN json_keys(clean) ELSE []::VARCHAR[] END AS keys FROM sc3),
sc5 AS (SELECT *, list_transform(keys, lambda k: {{'key': k,
    'is_obj': json_type(json_extract(clean, {_path('k')})) = 'OBJECT',
    'fields': CASE WHEN json_type(json_extract(clean, {_path('k')})) = 'OBJECT' THEN json_keys(json_extract(clean, {_path('k')})) ELSE []::VARCHAR[] END}}) AS ents
  FROM sc4),
sc6 AS (SELECT *,
    flatten(list_transform(ents, lambda e: CASE WHEN e.is_obj THEN e.fields ELSE [e.key] END)) AS pool,
    flatten(list_transform(ents, lambda e: e.fields)) AS inner_keys,
    list_distinct(flatten(list_transform(ents, lambda e: [e.key] || e.fields))) AS allk,
    coalesce(ok, false) AS parsed, (NOT coalesce(ok, false) OR kind = 'NULL') AS unparsed, coalesce(kind = 'OBJECT', false) AS is_dict,
    flatten(list_transform(list_filter(ents, lambda e: e.is_obj), lambda e: flatten(list_transform(
      list_filter(e.fields, lambda f: list_contains(map_keys(enums), f)), lambda f: list_transform(
        list_filter(CASE json_type(json_extract(clean, {_path('e.key', 'f')}))
            WHEN 'VARCHAR' THEN [json_extract_string(clean, {_path('e.key', 'f')})]
            WHEN 'ARRAY' THEN json_extract(clean, {_path('e.key', 'f')})::VARCHAR[] ELSE []::VARCHAR[] END,
          lambda v: NOT list_contains(enums[f], v)),
        lambda v: {{'field': f, 'msg': 'got ''' || v || ''', expected one of [' ||
          array_to_string(list_transform(list_sort(enums[f]), lambda a: '''' || a || ''''), ', ') || ']'}})))))  AS viol0
  FROM sc5),
scored AS (SELECT *,
    CASE WHEN is_dict THEN list_filter(required, lambda f: NOT list_contains(pool, f)) ELSE required END AS missing,
    CASE WHEN is_dict AND NOT unparsed THEN list_filter(inner_keys, lambda f: NOT list_contains(allowed, f)) ELSE []::VARCHAR[] END AS extra,
    list_filter(viol0, lambda x, i: NOT list_contains(list_transform(list_slice(viol0, i + 1, len(viol0)), lambda y: y.field), x.field)) AS viol,
    list_transform(pool, lambda f: {_alias_case('f')}) AS pool_n,
    list_transform(allk, lambda f: {_alias_case('f')}) AS allk_n
  FROM sc6),
scored2 AS (SELECT *,
    CASE WHEN NOT unparsed AND len(map_keys(enums)) > 0 THEN len(viol) = 0 END AS enum_ok,
    NOT unparsed AND is_dict AND len(missing) = 0 AND len(extra) = 0 AND len(viol) = 0 AS schema_strict,
    CASE WHEN is_dict THEN list_filter(required, lambda f: NOT list_contains(pool_n, f)) ELSE required END AS missing_alias,
    CASE WHEN is_dict THEN list_sort(list_filter(list_distinct(pool), lambda f: NOT list_contains(allowed, {_alias_case('f')}))) ELSE []::VARCHAR[] END AS extra_alias,
    CASE WHEN NOT unparsed THEN list_filter(required, lambda f: NOT list_contains(allk, f)) ELSE required END AS missing_stab,
    CASE WHEN NOT unparsed THEN list_sort(list_filter(allk, lambda f: NOT list_contains(allowed, f))) ELSE []::VARCHAR[] END AS extra_stab,
    CASE WHEN NOT unparsed THEN list_filter(required, lambda f: NOT list_contains(allk_n, f)) ELSE required END AS missing_stab_alias,
    CASE WHEN NOT unparsed THEN list_sort(list_filter(allk, lambda f: NOT list_contains(allowed, {_alias_case('f')}))) ELSE []::VARCHAR[] END AS extra_stab_alias
  FROM scored),
final AS (SELECT *,
    is_dict AND len(missing_alias) = 0 AND len(extra_alias) = 0 AND len(viol) = 0 AS schema_strict_alias,
    NOT unparsed AND len(missing_stab) = 0 AND len(extra_stab) = 0 AND len(viol) = 0 AS schema_strict_stab,
    NOT unparsed AND len(missing_stab_alias) = 0 AND len(extra_stab_alias) = 0 AND len(viol) = 0 AS schema_strict_stab_alias
  FROM scored2)"""

#: Rows of the rounds, of which failed requests have no output and no latency.
ROUNDS_SQL = f"""rounds0 AS (SELECT *, CASE WHEN ({draw_sql(SEED, KEY, 'request')}) % 16 = 0 THEN 'timeout' END AS error FROM final),
rounds AS (SELECT * REPLACE (parsed AND error IS NULL AS parsed, schema_strict_stab AND error IS NULL AS schema_strict_stab,
  schema_strict_stab_alias AND error IS NULL AS schema_strict_stab_alias, CASE WHEN error IS NULL THEN latency_s END AS latency_s) FROM rounds0)"""

N = "count(*)"
RATES = ("schema_strict_rate", "schema_strict_alias_rate", "parseable_rate", "missing_rate", "hallucination_rate")
ORACLE = {
    "score_rows": f"""WITH {EVAL_SQL}
SELECT model, id, grp AS "group", parsed, len(missing) AS n_missing, array_to_string(missing, ',') AS missing,
  len(extra) AS n_extra, array_to_string(extra, ',') AS extra, enum_ok, schema_strict FROM final""",
    "score_alias": f"""WITH {EVAL_SQL}
SELECT model, id, array_to_string(missing_alias, ',') AS missing_alias, array_to_string(extra_alias, ',') AS extra_alias,
  schema_strict_alias FROM final""",
    "score_stability": f"""WITH {EVAL_SQL}
SELECT model, id, array_to_string(missing_stab, ',') AS missing_stab, array_to_string(extra_stab, ',') AS extra_stab,
  schema_strict_stab, schema_strict_stab_alias FROM final""",
    "enum_check": f"""WITH {EVAL_SQL}
SELECT model, id, enum_ok, array_to_string(list_sort(list_transform(viol, lambda x: x.field || '=' || x.msg)), ';') AS violations
FROM final WHERE enum_ok IS NOT NULL""",
    "by_model": f"""WITH {EVAL_SQL}
SELECT model, {N} AS total, count(*) FILTER (WHERE parsed) AS parseable, count(*) FILTER (WHERE parsed) / {N} AS parseable_rate,
  CAST(sum(len(missing)) AS BIGINT) AS missing_fields_count, count(*) FILTER (WHERE len(missing) > 0) / {N} AS missing_rate,
  CAST(sum(len(extra)) AS BIGINT) AS extra_fields_count, count(*) FILTER (WHERE len(extra) > 0) / {N} AS hallucination_rate,
  count(*) FILTER (WHERE schema_strict) AS schema_strict_count, count(*) FILTER (WHERE schema_strict) / {N} AS schema_strict_rate,
  count(*) FILTER (WHERE schema_strict_alias) / {N} AS schema_strict_alias_rate,
  count(*) FILTER (WHERE len(missing_alias) > 0) / {N} AS missing_alias_rate,
  count(*) FILTER (WHERE len(extra_alias) > 0) / {N} AS hallucination_alias_rate,
  sum(latency_s) AS total_time_s, (sum(latency_s) / nullif(count(latency_s), 0)) AS avg_latency_s
FROM final GROUP BY model""",
    "by_group": f"""WITH {EVAL_SQL}
SELECT model, grp AS "group", {N} AS total, count(*) FILTER (WHERE parsed) / {N} AS parseable_rate,
  count(*) FILTER (WHERE len(missing) > 0) / {N} AS missing_rate, count(*) FILTER (WHERE len(extra) > 0) / {N} AS hallucination_rate,
  count(*) FILTER (WHERE schema_strict) / {N} AS schema_strict_rate, count(*) FILTER (WHERE schema_strict_alias) / {N} AS schema_strict_alias_rate,
  count(*) FILTER (WHERE len(missing_alias) > 0) / {N} AS missing_alias_rate
FROM final GROUP BY ALL""",
    "leaderboard": f"""WITH {EVAL_SQL}, bm AS (
  SELECT model, min(model_ord) AS model_ord, count(*) FILTER (WHERE schema_strict) / {N} AS schema_strict_rate,
    count(*) FILTER (WHERE schema_strict_alias) / {N} AS schema_strict_alias_rate, count(*) FILTER (WHERE parsed) / {N} AS parseable_rate,
    count(*) FILTER (WHERE len(missing) > 0) / {N} AS missing_rate, count(*) FILTER (WHERE len(extra) > 0) / {N} AS hallucination_rate
  FROM final GROUP BY model),
bm4 AS (SELECT model, model_ord, """ + ", ".join(f"floor({c} * 10000 + 0.5) / 10000.0 AS {c}" for c in RATES) + """ FROM bm)
SELECT row_number() OVER (ORDER BY schema_strict_rate DESC, parseable_rate DESC, model_ord) AS rank, model, schema_strict_rate,
  schema_strict_alias_rate, parseable_rate, missing_rate, hallucination_rate
FROM bm4""",
    "round_wide": f"""WITH {EVAL_SQL}, {ROUNDS_SQL}
SELECT model AS round, {N} AS total, count(error) AS errors, count(*) FILTER (WHERE parsed) / {N} AS parse_rate,
  count(*) FILTER (WHERE schema_strict_stab) / {N} AS strict_rate, count(*) FILTER (WHERE schema_strict_stab_alias) / {N} AS alias_strict_rate,
  coalesce(sum(latency_s), 0.0) AS total_time_s, coalesce(sum(latency_s), 0.0) / {N} AS avg_latency_s,
  """ + ",\n  ".join(
        f"count(*) FILTER (WHERE grp = '{g}' AND parsed) / count(*) FILTER (WHERE grp = '{g}') AS {g}_parse_rate, "
        f"count(*) FILTER (WHERE grp = '{g}' AND schema_strict_stab) / count(*) FILTER (WHERE grp = '{g}') AS {g}_strict_rate, "
        f"count(*) FILTER (WHERE grp = '{g}' AND schema_strict_stab_alias) / count(*) FILTER (WHERE grp = '{g}') AS {g}_alias_strict_rate, "
        f"count(*) FILTER (WHERE grp = '{g}') AS {g}_total"
        for g in EVAL_GROUPS) + "\nFROM rounds GROUP BY model",
    "structural_quality": f"""WITH {EVAL_SQL}
SELECT model, grp AS "group", {N} AS total,
  count(*) FILTER (WHERE list_bool_or(list_transform(ents, lambda e: e.is_obj))) / {N} AS entity_key_rate,
  count(*) FILTER (WHERE len(pool) > 0 AND list_bool_and(list_transform(pool, lambda f: regexp_matches(f, '\\p{{Han}}')))) / {N} AS chinese_fields_rate,
  (sum((CASE WHEN len(required) > 0 THEN len(list_intersect(pool, required)) / len(required) ELSE 0.0 END)) / nullif(count((CASE WHEN len(required) > 0 THEN len(list_intersect(pool, required)) / len(required) ELSE 0.0 END)), 0)) AS avg_field_overlap
FROM final GROUP BY ALL""",
    "eval_totals": f"""WITH {EVAL_SQL}
SELECT model, {N} AS n, sum(latency_s) AS total_time_s, (sum(latency_s) / nullif(count(latency_s), 0)) AS avg_latency_s FROM outs GROUP BY model""",
}

_VM_PAIRS = f"""flatten(list_transform(
    list_filter(json_keys(gold), lambda g: list_contains(keys, g) AND json_type(json_extract(clean, {_path('g')})) = 'OBJECT'),
    lambda g: list_transform(json_keys(json_extract(gold, {_path('g')})), lambda f: {{'field': f, 'match':
      list_contains(json_keys(json_extract(clean, {_path('g')})), f) AND CASE
        WHEN json_type(json_extract(gold, {_path('g', 'f')})) = 'ARRAY' AND json_type(json_extract(clean, {_path('g', 'f')})) = 'ARRAY'
          THEN list_has_all(json_extract(clean, {_path('g', 'f')})::VARCHAR[], json_extract(gold, {_path('g', 'f')})::VARCHAR[])
        ELSE coalesce(json_extract(clean, {_path('g', 'f')})::VARCHAR = json_extract(gold, {_path('g', 'f')})::VARCHAR, false) END}})))"""

_INS_SQL = "CASE grp " + " ".join(f"WHEN '{g}' THEN '{t}'" for g, t in EVAL_INSTRUCTIONS.items()) + " END"

ORACLE["value_match"] = f"""WITH {EVAL_SQL}, vm AS (SELECT model, id, {_VM_PAIRS} AS pairs FROM final WHERE NOT unparsed AND is_dict AND len(rel) > 0),
vm2 AS (SELECT model, id, list_filter(pairs, lambda x, i: NOT list_contains(list_transform(list_slice(pairs, i + 1, len(pairs)), lambda y: y.field), x.field)) AS lastp FROM vm)
SELECT model, id, len(lastp) AS n_fields, len(list_filter(lastp, lambda x: x.match)) AS n_match FROM vm2"""

ORACLE["prompt_text"] = f"""WITH {EVAL_SQL}, pt AS (
  SELECT id, grp, concat_ws(chr(10), CASE WHEN length({_INS_SQL}) > 0 THEN {_INS_SQL} END,
    CASE WHEN len(allowed) > 0 AND NOT (contains({_INS_SQL}, 'Schema:') OR contains(lower({_INS_SQL}), 'schema'))
      THEN 'Schema: [' || array_to_string(list_transform(allowed, lambda s: to_json(s)), ', ') || ']' END,
    CASE WHEN contains({_INS_SQL}, '文本:') OR contains({_INS_SQL}, '从文本') THEN input ELSE '文本: ' || input END) AS t
  FROM prompts)
SELECT id, grp AS "group", sha256(t) AS prompt_hash, length(t) AS prompt_len FROM pt"""


PROMPT_LIMIT = 40


def q_prompt_limit(spark, sf_dir):
    """First-N prompt selection (the limit is the feature): N prompts in id order."""
    p = eval_prompts(spark, sf_dir)
    return p.orderBy(F.col("id").cast("bigint")).limit(PROMPT_LIMIT).select("id", "group", F.size("required_fields").alias("n_required"))


def q_smoke_check(spark, sf_dir):
    """Looser check of a smoke run: strip, drop a leading ```json / ``` and a
    trailing ```, strip; PASS when the rest parses as JSON, else PARTIAL."""
    from quarry.functions.text import py_strip

    o = eval_outputs(spark, sf_dir, SEED)
    s = py_strip(F.col("output"))
    s = F.when(s.startswith("```json"), F.substring(s, 8, 1 << 30)).otherwise(s)
    s = F.when(s.startswith("```"), F.substring(s, 4, 1 << 30)).otherwise(s)
    s = F.when(s.endswith("```"), F.substring(s, F.lit(1), F.length(s) - 3)).otherwise(s)
    s = py_strip(s)
    d = o.withColumn("_c", s).withColumn("_p", sc.parse_output(F.col("_c")))
    n_fields = F.when(F.col("_p.kind") == "object", F.size("_p.entries"))
    return d.select("model", "id", F.when(F.col("_p.ok"), F.lit("PASS")).otherwise(F.lit("PARTIAL")).alias("status"),
                    n_fields.alias("n_fields"))


QUERIES["prompt_limit"] = q_prompt_limit
QUERIES["smoke_check"] = q_smoke_check
ORACLE["prompt_limit"] = f"""WITH {EVAL_SQL} SELECT id, grp AS "group", len(required) AS n_required FROM prompts
ORDER BY CAST(id AS BIGINT) LIMIT {PROMPT_LIMIT}"""
ORACLE["smoke_check"] = f"""WITH {EVAL_SQL}, s1 AS (SELECT model, id, trim(output, {WS_SQL}) AS s FROM outs),
s2 AS (SELECT model, id, CASE WHEN starts_with(s, '```json') THEN substr(s, 8) ELSE s END AS s FROM s1),
s3 AS (SELECT model, id, CASE WHEN starts_with(s, '```') THEN substr(s, 4) ELSE s END AS s FROM s2),
s4 AS (SELECT model, id, trim(CASE WHEN suffix(s, '```') THEN substr(s, 1, length(s) - 3) ELSE s END, {WS_SQL}) AS s FROM s3)
SELECT model, id, CASE WHEN json_valid(s) THEN 'PASS' ELSE 'PARTIAL' END AS status,
  CASE WHEN json_valid(s) AND json_type(s::JSON) = 'OBJECT' THEN len(json_keys(s)) END AS n_fields FROM s4"""
