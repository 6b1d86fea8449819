"""Conversation queries: normalize, render, generation prompt, system
prompt injection, reply cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.draw import draw_sql
from quarry.functions.text import py_strip
from quarry.operators import chat as ch
from quarry.plans.corpus import WS_SQL
from quarry.sources.adapters import conv_turns

SEED = 42
SYSTEM_RATIO = 0.5


def conversations(spark, sf_dir):
    return ch.turns_from_long(conv_turns(spark, sf_dir))


def normalized(spark, sf_dir):
    return ch.normalize_conversations(conversations(spark, sf_dir))


def q_conv_normalize(spark, sf_dir):
    n = normalized(spark, sf_dir)
    return n.select("conv_id", "invalid_reason", F.size("conversations").alias("n_turns"),
                    F.array_join(F.transform("conversations", lambda t: t["role"]), ",").alias("roles"))


def q_chat_render(spark, sf_dir):
    n = normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    r = ch.render_chat(F.col("conversations"))
    return n.select("conv_id", F.sha2(r, 256).alias("rendered_hash"), F.length(r).alias("rendered_len"))


def q_generation_prompt(spark, sf_dir):
    g = ch.generation_prompt(conversations(spark, sf_dir))
    return g.select("conv_id", "invalid_reason", F.sha2("prompt", 256).alias("prompt_hash"))


def q_system_inject(spark, sf_dir):
    n = normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    s = ch.inject_system(n, SYSTEM_RATIO, seed=SEED)
    return s.select("conv_id", "system_injected", F.try_element_at("conversations", F.lit(1))["content"].alias("first_content"),
                    F.size("conversations").alias("n_turns"))


def q_system_replay(spark, sf_dir):
    """System prompts as a generator seeded by sample draws them; the
    conversation's number stands for the line index."""
    n = normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    s = ch.inject_system(n, SYSTEM_RATIO, seed=SEED, compat=True)
    return s.select("conv_id", "system_injected", F.try_element_at("conversations", F.lit(1))["content"].alias("first_content"),
                    F.size("conversations").alias("n_turns"))


def q_reply_clean(spark, sf_dir):
    c = conv_turns(spark, sf_dir).filter(F.lower(py_strip("role")) == "assistant")
    raw = F.concat(F.col("text"), F.when(F.col("turn") % 3 == 0, F.lit(" " + ch.EOS_TOKEN + "  ")).otherwise(F.lit("")))
    out = ch.clean_reply(raw)
    return c.select("conv_id", "turn", F.sha2(out, 256).alias("reply_hash"), F.length(out).alias("reply_len"))


QUERIES = {
    "conv_normalize": q_conv_normalize,
    "chat_render": q_chat_render,
    "generation_prompt": q_generation_prompt,
    "system_inject": q_system_inject,
    "system_replay": q_system_replay,
    "reply_clean": q_reply_clean,
}

# ---------------------------------------------------------------- oracle SQL
ROLES_SQL = "[" + ", ".join(f"'{r}'" for r in ch.ROLE_MARKERS) + "]"
MARKER_SQL = "CASE x.role " + " ".join(
    f"WHEN '{r}' THEN '{m[:-1]}' || chr(10)" for r, m in ch.ROLE_MARKERS.items()) + " END"
EOS = ch.EOS_TOKEN
CONV_SQL = f"""turns AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 17 = 5 AND turn = 1 THEN 'narrator' WHEN turn % 5 = 3 THEN '  ' || upper(role) || ' ' ELSE role END AS role,
    CASE WHEN (conv_id * 7 + turn) % 13 = 0 THEN '   ' ELSE text END AS content
  FROM conversations),
conv AS (SELECT conv_id, list({{'role': role, 'content': content}} ORDER BY turn) AS turns FROM turns GROUP BY conv_id),
norm AS (SELECT conv_id, list_transform(turns, lambda x: {{'role': lower(trim(x.role, {WS_SQL})), 'content': trim(x.content, {WS_SQL})}}) AS nt FROM conv),
norm2 AS (SELECT conv_id,
  list_filter(list_transform(nt, lambda x: CASE WHEN x.role IS NULL OR x.content IS NULL THEN 'non_string_turn'
    WHEN NOT list_contains({ROLES_SQL}, x.role) THEN 'unsupported_role' END), lambda e: e IS NOT NULL) AS errs,
  list_filter(nt, lambda x: length(x.content) > 0) AS kept FROM norm),
normalized AS (SELECT conv_id, CASE WHEN len(errs) > 0 THEN errs[1] WHEN len(kept) = 0 THEN 'empty_after_normalize' END AS invalid_reason,
  kept FROM norm2),
rendered AS (SELECT conv_id, invalid_reason, kept,
  array_to_string(list_transform(kept, lambda x: {MARKER_SQL} || x.content || chr(10) ||
    CASE WHEN x.role = 'assistant' THEN '{EOS}' || chr(10) ELSE '' END), '') AS body FROM normalized)"""

PROMPTS_SQL = "[" + ", ".join(f"'{p}'" for p in ch.DEFAULT_SYSTEM_PROMPTS) + "]"

ORACLE = {
    "conv_normalize": f"""WITH {CONV_SQL}
SELECT conv_id, invalid_reason, CASE WHEN invalid_reason IS NULL THEN len(kept) END AS n_turns,
  CASE WHEN invalid_reason IS NULL THEN array_to_string(list_transform(kept, lambda x: x.role), ',') END AS roles FROM normalized""",
    "chat_render": f"""WITH {CONV_SQL}
SELECT conv_id, sha256(body) AS rendered_hash, length(body) AS rendered_len FROM rendered WHERE invalid_reason IS NULL""",
    "generation_prompt": f"""WITH {CONV_SQL}
SELECT conv_id, coalesce(invalid_reason, CASE WHEN kept[-1].role = 'assistant' THEN 'ends_with_assistant' END) AS invalid_reason,
  CASE WHEN coalesce(invalid_reason, CASE WHEN kept[-1].role = 'assistant' THEN 'ends_with_assistant' END) IS NULL
    THEN sha256(body || '<|assistant|>' || chr(10)) END AS prompt_hash FROM rendered""",
    "system_inject": f"""WITH {CONV_SQL}, inj AS (
  SELECT conv_id, kept, kept[1].role <> 'system' AND {draw_sql(SEED, 'conv_id', 'system')} / {float(2**60)} < {SYSTEM_RATIO} AS system_injected
  FROM normalized WHERE invalid_reason IS NULL)
SELECT conv_id, system_injected,
  CASE WHEN system_injected THEN {PROMPTS_SQL}[{draw_sql(SEED, 'conv_id', 'system_pick')} % 4 + 1] ELSE kept[1].content END AS first_content,
  len(kept) + CASE WHEN system_injected THEN 1 ELSE 0 END AS n_turns FROM inj""",
    "reply_clean": f"""WITH {CONV_SQL}, r AS (
  SELECT conv_id, turn, trim(content || CASE WHEN turn % 3 = 0 THEN ' {EOS}  ' ELSE '' END, {WS_SQL}) AS s FROM turns WHERE lower(trim(role, {WS_SQL})) = 'assistant'),
c AS (SELECT conv_id, turn, trim(CASE WHEN suffix(s, '{EOS}') THEN substr(s, 1, length(s) - {len(EOS)}) ELSE s END, {WS_SQL}) AS o FROM r)
SELECT conv_id, turn, sha256(o) AS reply_hash, length(o) AS reply_len FROM c""",
}
