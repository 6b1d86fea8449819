"""Conversations: normalize, inject system prompts, render chat text,
generation prompts, reply cleaning.  All native higher-order functions over
the per-conversation turn array (a conversation is one row)."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.draw import bucket, uniform
from quarry.functions.text import py_strip

# ---- fixed values: chat format of the reference -----------------------------
ROLE_MARKERS = {
    "system": "<|system|>\n",
    "user": "<|user|>\n",
    "assistant": "<|assistant|>\n",
    "tool": "<|tool|>\n",
}
EOS_TOKEN = "<|endoftext|>"
DEFAULT_SYSTEM_PROMPTS = [
    "你是一个知识丰富的AI助手，请尽力给出准确、简洁的回答。",
    "你是一个可靠的中文助手，请根据用户问题给出有帮助的回复。",
    "You are a helpful AI assistant.",
    "You are a knowledgeable and concise assistant.",
]
# ---------------------------------------------------------------------------

TURN = "struct<role:string,content:string>"


def turns_from_long(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Long table (one row per turn) -> one row per conversation with the
    ordered ``conversations`` array (sorting structs led by the turn number)."""
    t = F.struct(F.col(order).alias("_o"), F.col(role).alias("role"), F.col(text).alias("content"))
    g = df.groupBy(key).agg(F.array_sort(F.collect_list(t)).alias("_t"))
    return g.select(key, F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("conversations"))


def normalize_conversations(df: DataFrame, col: str = "conversations") -> DataFrame:
    """Strip + lower-case roles, strip contents, drop blank turns.

    ``invalid_reason`` reports the first problem in turn order, like the
    reference's first raised error: ``empty_list``, ``non_string_turn``,
    ``unsupported_role``, or ``empty_after_normalize``; null when valid."""
    allowed = F.array(*[F.lit(r) for r in ROLE_MARKERS])
    norm = F.transform(
        F.col(col),
        lambda t: F.struct(F.lower(py_strip(t["role"])).alias("role"), py_strip(t["content"]).alias("content"),
                           (t["role"].isNull() | t["content"].isNull()).alias("_ns")),
    )
    errs = F.filter(
        F.transform(norm, lambda t: F.when(t["_ns"], F.lit("non_string_turn"))
                    .when(~F.array_contains(allowed, t["role"]), F.lit("unsupported_role"))),
        lambda e: e.isNotNull(),
    )
    kept = F.transform(F.filter(norm, lambda t: ~t["_ns"] & (F.length(t["content"]) > 0)),
                       lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    reason = (
        F.when(F.col(col).isNull() | (F.size(F.col(col)) <= 0), F.lit("empty_list"))
        .when(F.size(errs) > 0, F.try_element_at(errs, F.lit(1)))
        .when(F.size(kept) == 0, F.lit("empty_after_normalize"))
    )
    return df.withColumn("invalid_reason", reason).withColumn(
        col, F.when(F.col("invalid_reason").isNull(), kept)
    )


def replayed_choice(index: Column, ratio: float, prompts: list, seed: int) -> Column:
    """The system prompt that Python's generator, seeded with ``seed`` + line
    index, draws for a sample; null if it draws none.  An Arrow UDF over the
    index alone: Spark has no Mersenne Twister."""

    @F.pandas_udf("string")
    def choose(at: pd.Series) -> pd.Series:
        def one(i):
            if pd.isna(i):
                return None
            rng = random.Random(seed + int(i))
            return rng.choice(prompts) if rng.random() < ratio else None

        return at.map(one).astype(object)

    return choose(index)


def inject_system(df: DataFrame, ratio: float, prompts=None, seed: int = 42, key: str = "conv_id",
                  col: str = "conversations", compat: bool = False) -> DataFrame:
    """With probability ``ratio`` (a hash draw of seed and key) prepend a
    system turn chosen by another draw, unless the first turn is system.

    ``compat``: draw as a generator seeded with ``seed`` + ``key`` does, where
    ``key`` is the line index of the sample (``io.sft_index``)."""
    prompts = list(DEFAULT_SYSTEM_PROMPTS if prompts is None else prompts)
    conv = F.col(col)
    if ratio <= 0 or not prompts:
        return df.withColumn("system_injected", F.lit(False))
    first_is_system = F.try_element_at(conv, F.lit(1))["role"] == "system"
    if compat:
        may = conv.isNotNull() & (F.size(conv) > 0) & ~F.coalesce(first_is_system, F.lit(False))
        d = df.withColumn("_prompt", replayed_choice(F.when(may, F.col(key).cast("long")), ratio, prompts, seed))
        turn = F.struct(F.lit("system").alias("role"), F.col("_prompt").alias("content"))
        return d.withColumn("system_injected", F.col("_prompt").isNotNull()).withColumn(
            col, F.when(F.col("system_injected"), F.concat(F.array(turn), conv)).otherwise(conv)).drop("_prompt")
    do = conv.isNotNull() & (F.size(conv) > 0) & ~first_is_system & (uniform(seed, F.col(key), "system") < F.lit(ratio))
    choice = F.element_at(F.array(*[F.lit(p) for p in prompts]), (bucket(seed, F.col(key), len(prompts), "system_pick") + 1).cast("int"))
    turn = F.struct(F.lit("system").alias("role"), choice.alias("content"))
    return df.withColumn("system_injected", F.coalesce(do, F.lit(False))).withColumn(
        col, F.when(F.col("system_injected"), F.concat(F.array(turn), conv)).otherwise(conv)
    )


def render_chat(conv: Column, eos: str = EOS_TOKEN, generation: bool = False) -> Column:
    """marker + content + newline per turn; assistant turns add eos + newline;
    optional trailing assistant marker."""
    markers = F.create_map(*[F.lit(x) for kv in ROLE_MARKERS.items() for x in kv])
    body = F.array_join(
        F.transform(conv, lambda t: F.concat(
            F.element_at(markers, t["role"]), t["content"], F.lit("\n"),
            F.when(t["role"] == "assistant", F.lit(eos + "\n")).otherwise(F.lit("")))),
        "",
    )
    return F.concat(body, F.lit(ROLE_MARKERS["assistant"])) if generation else body


def generation_prompt(df: DataFrame, eos: str = EOS_TOKEN, col: str = "conversations") -> DataFrame:
    """Normalized conversation rendered with the assistant marker appended;
    invalid when the last turn is an assistant turn."""
    n = normalize_conversations(df, col)
    last_assistant = F.try_element_at(F.col(col), F.lit(-1))["role"] == "assistant"
    n = n.withColumn("invalid_reason", F.coalesce(F.col("invalid_reason"), F.when(last_assistant, F.lit("ends_with_assistant"))))
    return n.withColumn("prompt", F.when(F.col("invalid_reason").isNull(), render_chat(F.col(col), eos, True)))


def resolve_prompt(df: DataFrame, eos: str = EOS_TOKEN) -> DataFrame:
    """Prompt source per row: exactly one of ``conversation_json`` or
    ``conversation_file`` (contents of a path), else a non-blank ``prompt``.
    Adds ``resolved`` and ``resolve_reason`` (null when resolved)."""
    has_json = F.col("conversation_json").isNotNull()
    has_file = F.col("conversation_file").isNotNull()
    src = F.when(has_json, F.col("conversation_json")).otherwise(F.col("conversation_file"))
    from quarry.sources.io import parse_conversations

    d = df.withColumn("conversations", parse_conversations(src)).withColumn("_bad", F.col("conversations").isNull())
    g = generation_prompt(d.withColumnRenamed("prompt", "_raw_prompt"), eos)
    reason = (
        F.when(has_json & has_file, F.lit("both_json_and_path"))
        .when(has_json | has_file,
              F.when(F.col("_bad"), F.lit("bad_json")).otherwise(F.col("invalid_reason")))
        .when(F.length(py_strip(F.coalesce(F.col("_raw_prompt"), F.lit("")))) == 0, F.lit("empty_prompt"))
    )
    resolved = F.when(has_json | has_file, F.col("prompt")).otherwise(F.col("_raw_prompt"))
    return g.withColumn("resolve_reason", reason).withColumn(
        "resolved", F.when(F.col("resolve_reason").isNull(), resolved)
    ).drop("prompt", "_bad").withColumnRenamed("_raw_prompt", "prompt")


def clean_reply(c: Column, eos: str = EOS_TOKEN) -> Column:
    """Strip, drop a trailing EOS marker, strip again (lone surrogates cannot
    occur in Spark's UTF-8 strings)."""
    s = py_strip(c)
    cut = F.substring(s, F.lit(1), F.length(s) - len(eos))
    return py_strip(F.when(s.endswith(F.lit(eos)), cut).otherwise(s))


def clip_ids(ids: Column, vocab_size: int) -> Column:
    """Drop token ids not below the model vocabulary size."""
    return F.filter(ids, lambda x: x < vocab_size)
