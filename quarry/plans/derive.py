"""Task derivation, stratified sampling and chat-record queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.draw import draw_sql
from quarry.operators import derive as dv
from quarry.operators import sample as sp
from quarry.plans.ie import IE_SQL, materialized, tiered
from quarry.session import cut_lineage
from quarry.sources.adapters import IE_CATE_MAP, IE_NO_SCHEMA_TOPIC, IE_UNUSED_FIELD, ie_topic_schema_from

SEED = 42
SAMPLE_TARGET = 6000
TRIM_TARGET = 8  # fewer than the topics: one row a topic, then trimmed
TOPUP_SHARE = 1.94  # x the extraction rows: topics below the mean are short, the others top them up


def derived(spark, sf_dir):
    n = materialized(spark, sf_dir)  # one pass over the line items feeds records and schema
    return dv.derive_tasks(tiered(spark, sf_dir, n), ie_topic_schema_from(n, IE_CATE_MAP), IE_CATE_MAP, seed=SEED)


#: What sampling looks at: every derived task, but none of its long texts.
SAMPLING = ("task_type", "original_id", "cate", "quality_tier", "n_relations", "input_len")


def candidates(spark, sf_dir):
    # the derived table feeds several small planning aggregates and the
    # sampling windows: materialise it once (reliable checkpoint)
    return cut_lineage(derived(spark, sf_dir).select(*SAMPLING))


def sampled(spark, sf_dir):
    return sp.priority_sample(candidates(spark, sf_dir), target=SAMPLE_TARGET, seed=SEED)


def indexed(spark, sf_dir):
    """The sample in its order, with prompts and outputs.  All tasks are derived
    and sampled without their texts; those of the sampled records are made
    after.  ``_row`` tells records apart, also where ids repeat."""
    n = materialized(spark, sf_dir)
    records = cut_lineage(tiered(spark, sf_dir, n).withColumn("_row", F.monotonically_increasing_id()))
    schema = cut_lineage(ie_topic_schema_from(n, IE_CATE_MAP))

    def tasks(of):
        return dv.derive_tasks(of, schema, IE_CATE_MAP, seed=SEED, keep=("_row",))

    s = sp.priority_sample(cut_lineage(tasks(records).select(*SAMPLING, "_row")), target=SAMPLE_TARGET, seed=SEED)
    idx = cut_lineage(sp.index_sample(s, "idx"))
    # the sample has a row for each of its target; records stay where they are
    chosen = F.broadcast(idx.select("_row").distinct())
    texts = tasks(records.join(chosen, "_row", "left_semi")).select("_row", "task_type", "prompt", "output")
    return texts.join(F.broadcast(idx), ["_row", "task_type"]).select(*[c for c in idx.columns if c != "_row"], "prompt", "output")


def chat(spark, sf_dir):
    c = cut_lineage(sp.to_chat(indexed(spark, sf_dir)))
    return sp.exact_split(c, F.col("id"), sp.INTERNAL_VALID_RATIO, SEED)


def q_relations_json(spark, sf_dir):
    from quarry.functions.jsonfmt import relations_json

    return tiered(spark, sf_dir).select("id", relations_json(F.col("relation")).alias("output"))


def q_derive_tasks(spark, sf_dir):
    return derived(spark, sf_dir).select("task_type", "original_id", "cate", "quality_tier", "n_relations", "input_len",
                                         "output", "perturbation_kind")


def q_task_prompts(spark, sf_dir):
    d = derived(spark, sf_dir).filter(F.col("task_type") != "schema_repair")
    return d.select("task_type", "original_id", F.sha2("prompt", 256).alias("prompt_hash"))


def q_perturb(spark, sf_dir):
    d = derived(spark, sf_dir).filter(F.col("task_type") == "schema_repair")
    return d.select("original_id", "perturbation_kind", "perturbation", F.sha2("prompt", 256).alias("prompt_hash"))


def q_task_shares(spark, sf_dir):
    from quarry.operators.stats import distribution

    return distribution(derived(spark, sf_dir), "task_type")


def q_schema_skip(spark, sf_dir):
    n = materialized(spark, sf_dir)
    return dv.schema_skips(tiered(spark, sf_dir, n), ie_topic_schema_from(n, IE_CATE_MAP), IE_CATE_MAP)


def q_priority_sample(spark, sf_dir):
    return sampled(spark, sf_dir).select("task_type", "original_id", "cate", "quality_tier", "phase")


def q_sample_trim(spark, sf_dir):
    s = sp.priority_sample(candidates(spark, sf_dir), target=TRIM_TARGET, seed=SEED)
    return s.select("task_type", "original_id", "cate", "quality_tier", "phase")


def q_sample_topup(spark, sf_dir):
    d = candidates(spark, sf_dir)
    n = d.filter(F.col("task_type") == "ie_extraction").count()
    s = sp.priority_sample(d, target=int(n * TOPUP_SHARE), seed=SEED)
    return s.select("task_type", "original_id", "cate", "quality_tier", "phase")


def q_sample_distribution(spark, sf_dir):
    s = sampled(spark, sf_dir)
    return s.groupBy("task_type", "cate", "quality_tier", sp.complexity().alias("complexity")).agg(
        F.count(F.lit(1)).alias("count"))


def q_chat_rows(spark, sf_dir):
    c = chat(spark, sf_dir)
    return c.select("id", "task_type", "topic_schema", "quality_tier", "split",
                    F.sha2(F.col("messages")[0]["content"], 256).alias("user_hash"),
                    F.sha2(F.col("messages")[1]["content"], 256).alias("assistant_hash"))


def q_chat_records(spark, sf_dir):
    c = chat(spark, sf_dir)
    return c.select("id", "task_type", "topic_schema", "quality_tier", "split", F.size("messages").alias("n_messages"),
                    F.sha2(F.col("messages")[1]["content"], 256).alias("assistant_hash"))


def q_exact_split(spark, sf_dir):
    c = chat(spark, sf_dir)
    return c.groupBy("split", "task_type").agg(F.count(F.lit(1)).alias("count"))


def q_spotcheck(spark, sf_dir):
    c = chat(spark, sf_dir).filter(F.col("split") == "train")
    return sp.spotcheck(c, "task_type", F.col("id"), sp.SPOTCHECK_PER_TASK, SEED).select("id", "task_type")


def q_json_validity(spark, sf_dir):
    from quarry.operators.scoring import json_ok

    c = chat(spark, sf_dir)
    ok = json_ok(F.col("messages")[1]["content"])
    return c.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("valid"),
                 (F.count_if(ok) / F.count(F.lit(1))).alias("valid_rate"))


def q_sample_metadata(spark, sf_dir):
    c = chat(spark, sf_dir)
    return c.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "valid").alias("valid_samples"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("split") == "train", F.col("topic_schema")))), ",").alias("topics"),
    )


QUERIES = {
    "relations_json": q_relations_json,
    "derive_tasks": q_derive_tasks,
    "task_prompts": q_task_prompts,
    "perturb": q_perturb,
    "task_shares": q_task_shares,
    "schema_skip": q_schema_skip,
    "priority_sample": q_priority_sample,
    "sample_trim": q_sample_trim,
    "sample_topup": q_sample_topup,
    "sample_distribution": q_sample_distribution,
    "chat_rows": q_chat_rows,
    "chat_records": q_chat_records,
    "exact_split": q_exact_split,
    "spotcheck": q_spotcheck,
    "json_validity": q_json_validity,
    "sample_metadata": q_sample_metadata,
}

# ---------------------------------------------------------------- oracle SQL
NL = "chr(10)"


def _jlist(x: str) -> str:
    return f"('[' || array_to_string(list_transform({x}, lambda s: to_json(s)), ', ') || ']')"


RELJSON = (
    "('{' || array_to_string(list_transform(list_filter(list_transform(relation, lambda r: r.head), "
    "lambda x, i: list_position(list_transform(relation, lambda r: r.head), x) = i), "
    "lambda e: to_json(e) || ': {' || array_to_string(list_transform("
    "list_filter(list_transform(list_filter(relation, lambda r: r.head = e), lambda r: r.relation), "
    "lambda x, i: list_position(list_transform(list_filter(relation, lambda r: r.head = e), lambda r: r.relation), x) = i), "
    "lambda k: to_json(k) || ': ' || CASE WHEN len(list_filter(relation, lambda r: r.head = e AND r.relation = k)) = 1 "
    "THEN to_json(list_filter(relation, lambda r: r.head = e AND r.relation = k)[1].tail) "
    "ELSE '[' || array_to_string(list_transform(list_filter(relation, lambda r: r.head = e AND r.relation = k), "
    "lambda r: to_json(r.tail)), ', ') || ']' END), ', ') || '}'), ', ') || '}')"
)

fc = ", ".join("'" + c + "'" for c in dv.FORMAT_CONSTRAINTS)
T2J_RULES_SQL = dv.T2J_RULES.replace("\n", "")


def _said_sql(template: str, **values: str) -> str:
    return "'" + template.format(**{k: f"' || {v} || '" for k, v in values.items()}) + "'"


REPAIR_SQL = f"""rep AS (SELECT id, input, relation, fields FROM src WHERE quality_tier = 'high' AND relation_count >= 3),
tri AS (SELECT id, r.head AS head, r.relation AS field, r.tail AS tail, i FROM (SELECT id, unnest(relation) AS r, generate_subscripts(relation, 1) AS i FROM rep)),
mem AS (SELECT *, min(ford) OVER (PARTITION BY id, head) AS eord FROM (SELECT id, head, field, list(tail ORDER BY i) AS tails, min(i) AS ford FROM tri GROUP BY ALL)),
single AS (SELECT id, head AS one_head, field AS one_field FROM mem WHERE len(tails) = 1 QUALIFY row_number() OVER (PARTITION BY id ORDER BY eord, ford) = 1),
names AS (
  SELECT rep.*, list_sort(list_filter(fields, lambda f: list_contains(names, f))) AS used, list_sort(list_filter(fields, lambda f: NOT list_contains(names, f))) AS spare, heads
  FROM rep JOIN (SELECT id, list(DISTINCT field) AS names FROM mem GROUP BY id) USING (id)
  JOIN (SELECT id, list(head ORDER BY eord) AS heads FROM (SELECT DISTINCT id, head, eord FROM mem) GROUP BY id) USING (id)),
pick AS (
  SELECT names.*, one_head, one_field, CASE WHEN len(used) > 0 THEN 'misspell' WHEN len(spare) > 0 THEN 'extra' WHEN one_field IS NOT NULL THEN 'to_list' END AS kind,
    used[({draw_sql(SEED, 'id', 'field')}) % greatest(len(used), 1) + 1] AS target, spare[({draw_sql(SEED, 'id', 'fake')}) % greatest(len(spare), 1) + 1] AS fake,
    heads[({draw_sql(SEED, 'id', 'host')}) % len(heads) + 1] AS host
  FROM names LEFT JOIN single USING (id)),
bad AS (
  SELECT *, CASE WHEN length(target) > 1 THEN substr(target, 1, spot) || chr(unicode(substr(target, spot + 1, 1)) + {dv.MISSPELL_SHIFTS}[({draw_sql(SEED, 'id', 'shift')}) % 3 + 1]) || substr(target, spot + 2)
    ELSE target END AS bad
  FROM (SELECT *, (({draw_sql(SEED, 'id', 'place')}) % greatest(length(target), 1))::BIGINT AS spot FROM pick)),
edits AS (
  SELECT mem.id, head, eord, kind = 'misspell' AND field = target AND eord = min(CASE WHEN field = target THEN eord END) OVER (PARTITION BY mem.id) AS hit, bad, field, ford,
    CASE WHEN kind = 'to_list' AND head = one_head AND field = one_field THEN list_append(tails, '{dv.LIST_FILLER}') ELSE tails END AS tails
  FROM mem JOIN bad USING (id)
  UNION ALL
  SELECT id, host, (SELECT min(eord) FROM mem WHERE mem.id = bad.id AND head = host), false, NULL, fake, 1000000, ['{dv.EXTRA_VALUE}'] FROM bad WHERE kind = 'extra'),
wrong AS (
  SELECT id, '{{' || string_agg(to_json(head) || ': {{' || members || '}}', ', ' ORDER BY eord) || '}}' AS wrong
  FROM (SELECT id, head, eord, string_agg(to_json(CASE WHEN hit THEN bad ELSE field END) || ': ' || CASE WHEN len(tails) = 1 THEN to_json(tails[1]) ELSE {_jlist('tails')} END, ', '
                 ORDER BY CASE WHEN hit THEN 1000000 ELSE ford END) AS members FROM edits GROUP BY ALL)
  GROUP BY id),
repair AS (
  SELECT id, kind, said, '{dv.REPAIR_PROMPT_HEAD.rstrip(chr(10))}' || {NL} || 'Schema: ' || {_jlist('fields')} || {NL} || '原文: ' || input || {NL} || '有错误的抽取结果: ' || wrong || {NL}
    || '错误类型: ' || said || {NL} || '{dv.REPAIR_PROMPT_TAIL}' AS prompt
  FROM (SELECT *, CASE kind WHEN 'misspell' THEN {_said_sql(dv.DESC_MISSPELL.replace("'", "''"), old='target', new='bad')} WHEN 'extra' THEN {_said_sql(dv.DESC_EXTRA.replace("'", "''"), entity='host', field='fake')}
          ELSE {_said_sql(dv.DESC_TO_LIST.replace("'", "''"), field='one_field')} END AS said FROM bad JOIN wrong USING (id)) WHERE kind IS NOT NULL)"""
DERIVE_SQL = f"""{IE_SQL},
schema AS (
  SELECT c.c_mktsegment AS topic, list_sort(list(DISTINCT p.p_type)) || ['{IE_UNUSED_FIELD}'] AS fields
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment <> '{IE_NO_SCHEMA_TOPIC}' GROUP BY 1),
looked AS (
  SELECT t.*, coalesce(s1.fields, s2.fields) AS fields FROM tiered t
  LEFT JOIN schema s1 ON s1.topic = t.cate
  LEFT JOIN schema s2 ON s2.topic = CASE WHEN t.cate = 'HOME' THEN 'HOUSEHOLD' END),
src AS (
  SELECT *, {RELJSON} AS output,
    len(list_filter(list_transform(relation, lambda r: r.relation), lambda x: list_contains(fields, x))) > 0 AS has_used,
    len(list_filter(fields, lambda f: NOT list_contains(list_transform(relation, lambda r: r.relation), f))) > 0 AS has_unused
  FROM looked WHERE len(coalesce(fields, [])) > 0),
{REPAIR_SQL},
tasks AS (
  SELECT 'ie_extraction' AS task_type, *, NULL::VARCHAR AS perturbation_kind, NULL::VARCHAR AS perturbation,
    '{dv.IE_PROMPT_HEAD.rstrip(chr(10))}' || {NL} || 'Schema: ' || {_jlist('fields')} || {NL} || '文本: ' || input AS prompt FROM src
  UNION ALL
  SELECT 'text_to_json', *, NULL, NULL, '{dv.T2J_PROMPT_HEAD.rstrip(chr(10))}' || {NL} || 'Schema 字段: ' || {_jlist('fields')} || {NL}
    || '{T2J_RULES_SQL}' || {NL} || '文本: ' || input FROM src WHERE quality_tier IN ('high', 'medium')
  UNION ALL
  SELECT 'format_following', *, NULL, NULL, [{fc}][({draw_sql(SEED, 'id', 'format')}) % 4 + 1] || {NL} || 'Schema: ' || {_jlist('fields')}
    || {NL} || '从文本中抽取信息并输出 JSON: ' || input FROM src WHERE quality_tier = 'high'
  UNION ALL
  SELECT 'schema_repair', src.*, repair.kind, repair.said, repair.prompt FROM src JOIN repair USING (id)),
derived AS (SELECT task_type, id AS original_id, cate, quality_tier, relation_count AS n_relations, input_len, output,
  perturbation_kind, perturbation, prompt FROM tasks)"""

TARGETS_SQL = "(VALUES " + ", ".join(f"('{t}', {n}, {i})" for i, (t, n) in enumerate(sp.task_targets(SAMPLE_TARGET, sp.TASK_RATIO).items())) + ") AS tg(task_type, target, t_ord)"
KEY = "(original_id || ':' || task_type)"


def sample_sql(targets: str) -> str:
    """The sampling CTEs for a ``tg(task_type, target, t_ord)`` relation."""
    return f"""{DERIVE_SQL},
d AS (
  SELECT dd.*, tg.target, tg.t_ord,
    CASE coalesce(quality_tier, 'medium') WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 END AS q_rank,
    CASE WHEN n_relations <= 3 AND input_len < 100 THEN 1 WHEN n_relations <= 6 AND input_len < 250 THEN 0 ELSE 2 END AS c_rank,
    {draw_sql(SEED, KEY, 'fill')} AS rank_draw, {KEY} AS k
  FROM derived dd JOIN {targets} USING (task_type) WHERE tg.target > 0),
nt AS (SELECT task_type, count(DISTINCT cate) AS n_topics FROM d GROUP BY 1),
fill AS (
  SELECT * FROM (SELECT d.*, greatest(1, target // n_topics) AS per_topic,
    row_number() OVER (PARTITION BY task_type, cate ORDER BY q_rank, c_rank, rank_draw, k) AS rn
    FROM d JOIN nt USING (task_type) WHERE q_rank IS NOT NULL) WHERE rn <= per_topic),
deficit AS (SELECT task_type, max(target) - count(*) AS need FROM fill GROUP BY task_type),
top AS (
  SELECT * FROM (SELECT d.*, row_number() OVER (PARTITION BY task_type ORDER BY {draw_sql(SEED, 'k', 'topup')}, k) AS rn2
    FROM d WHERE NOT EXISTS (SELECT 1 FROM fill f WHERE f.original_id = d.original_id AND f.task_type = d.task_type)) x
  JOIN deficit USING (task_type) WHERE rn2 <= need),
s0 AS (
  SELECT task_type, original_id, cate, quality_tier, n_relations, input_len, output, prompt, target, t_ord, q_rank, c_rank, rank_draw, k, 0 AS phase FROM fill
  UNION ALL
  SELECT task_type, original_id, cate, quality_tier, n_relations, input_len, output, prompt, target, t_ord, q_rank, c_rank, rank_draw, k, 1 FROM top),
sampled AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY {draw_sql(SEED, 'k', 'trim')}, k) AS rt,
    count(*) OVER (PARTITION BY task_type) AS got FROM s0) WHERE got <= target OR rt <= target),
indexed AS (
  SELECT *, row_number() OVER (ORDER BY t_ord, phase, cate, q_rank, c_rank, rank_draw, original_id) - 1 AS idx FROM sampled),
chat AS (
  SELECT printf('instructie_%s_%06d', task_type, idx) AS id, 'instructie' AS source, task_type, cate AS topic_schema,
    quality_tier, prompt, output FROM indexed),
chat_split AS (
  SELECT *, CASE WHEN (row_number() OVER (ORDER BY {draw_sql(SEED, 'id', 'split')}, id) - 1)
    < CAST(floor(count(*) OVER () * (1 - {sp.INTERNAL_VALID_RATIO})) AS BIGINT) THEN 'train' ELSE 'valid' END AS split FROM chat)"""


SAMPLE_SQL = sample_sql(TARGETS_SQL)
_RATIO = "(VALUES " + ", ".join(f"('{t}', {r}::DOUBLE, {i})" for i, (t, r) in enumerate(sp.TASK_RATIO.items())) + ") AS r(task_type, ratio, t_ord)"
TOPUP_TARGETS = f"""(SELECT task_type, CAST(floor((SELECT CAST(floor(count(*) * {TOPUP_SHARE}::DOUBLE) AS BIGINT) FROM derived WHERE task_type = 'ie_extraction') * ratio) AS BIGINT) AS target, t_ord
  FROM {_RATIO}) AS tg"""
TRIM_TARGETS = TARGETS_SQL.replace(TARGETS_SQL[TARGETS_SQL.index("(VALUES"):TARGETS_SQL.index(") AS tg")], "(VALUES " + ", ".join(
    f"('{t}', {n}, {i})" for i, (t, n) in enumerate(sp.task_targets(TRIM_TARGET, sp.TASK_RATIO).items())))

ORACLE = {
    "relations_json": f"WITH {IE_SQL} SELECT id, {RELJSON} AS output FROM tiered",
    "derive_tasks": f"WITH {DERIVE_SQL} SELECT task_type, original_id, cate, quality_tier, n_relations, input_len, output, perturbation_kind FROM derived",
    "task_prompts": f"WITH {DERIVE_SQL} SELECT task_type, original_id, sha256(prompt) AS prompt_hash FROM derived WHERE task_type <> 'schema_repair'",
    "task_shares": f"WITH {DERIVE_SQL} SELECT task_type, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM derived GROUP BY 1",
    "schema_skip": f"WITH {DERIVE_SQL} SELECT cate, count(*) FILTER (WHERE len(coalesce(fields, [])) = 0) AS no_schema, count(*) AS rows FROM looked GROUP BY cate",
    "priority_sample": f"WITH {SAMPLE_SQL} SELECT task_type, original_id, cate, quality_tier, phase FROM sampled",
    "sample_trim": f"WITH {sample_sql(TRIM_TARGETS)} SELECT task_type, original_id, cate, quality_tier, phase FROM sampled",
    "sample_topup": f"WITH {sample_sql(TOPUP_TARGETS)} SELECT task_type, original_id, cate, quality_tier, phase FROM sampled",
    "sample_distribution": f"""WITH {SAMPLE_SQL}
SELECT task_type, cate, quality_tier, CASE c_rank WHEN 0 THEN 'medium' WHEN 1 THEN 'simple' ELSE 'complex' END AS complexity,
  count(*) AS count FROM sampled GROUP BY ALL""",
    "perturb": f"WITH {DERIVE_SQL} SELECT original_id, perturbation_kind, perturbation, sha256(prompt) AS prompt_hash FROM derived WHERE task_type = 'schema_repair'",
    "chat_rows": f"""WITH {SAMPLE_SQL}
SELECT id, task_type, topic_schema, quality_tier, split, sha256(prompt) AS user_hash, sha256(output) AS assistant_hash FROM chat_split""",
    "chat_records": f"""WITH {SAMPLE_SQL}
SELECT id, task_type, topic_schema, quality_tier, split, 2 AS n_messages, sha256(output) AS assistant_hash FROM chat_split""",
    "exact_split": f"WITH {SAMPLE_SQL} SELECT split, task_type, count(*) AS count FROM chat_split GROUP BY ALL",
    "spotcheck": f"""WITH {SAMPLE_SQL}
SELECT id, task_type FROM (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY {draw_sql(SEED, 'id', 'spot')}, id) AS rn
  FROM chat_split WHERE split = 'train') WHERE rn <= {sp.SPOTCHECK_PER_TASK}""",
    "json_validity": f"""WITH {SAMPLE_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE json_valid(output)) AS valid,
  count(*) FILTER (WHERE json_valid(output)) / count(*) AS valid_rate FROM chat_split""",
    "sample_metadata": f"""WITH {SAMPLE_SQL}
SELECT count(*) AS total_samples, count(*) FILTER (WHERE split = 'train') AS train_samples,
  count(*) FILTER (WHERE split = 'valid') AS valid_samples, array_to_string(list_sort(list(DISTINCT topic_schema) FILTER (WHERE split = 'train')), ',') AS topics
FROM chat_split""",
}
