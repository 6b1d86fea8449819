"""Instruction-extraction records: normalize, measure, hard/soft filter,
leakage removal, quality tiers.  All row-local work is native expressions;
the only shuffles are the quantile histogram and the leakage anti-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import py_strip
from quarry.operators.stats import nearest_rank

# ---- fixed values: reference defaults ---------------------------------------
CATE_MAP = {"建筑结构": "建筑"}
HARD_LIMITS = {
    "min_relations": 1,
    "max_relations": 25,
    "min_input_len": 15,
    "max_input_len": 800,
    "max_output_json_len": 2500,
    "max_head_tail_len": 100,
}
SOFT_PCTS = {"input_len": 99, "output_len": 99, "relation_count": 99, "head_tail_len": 99}
QUALITY = {
    "match_ratio_high": 1.0,
    "match_ratio_medium": 0.8,
    "ideal_relation_range": (2, 10),
    "ideal_input_len_range": (30, 400),
}
QUANTILE_PCTS = (75, 90, 95, 99)
MEASURES = ("input_len", "output_len", "relation_count", "head_tail_len")
# ---------------------------------------------------------------------------


def map_lookup(col: Column, mapping: dict) -> Column:
    """``mapping.get(x, x)`` as a literal map expression (no join)."""
    if not mapping:
        return col
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, col), col)


def normalize_ie(df: DataFrame, source: str | Column | None = None, cate_map: dict | None = None) -> DataFrame:
    """``input = strip(text or input or '')``, id as string, relation fields
    stripped, category renamed, type arrays kept only when some head type is
    non-empty, ``source`` attached."""
    cate_map = CATE_MAP if cate_map is None else cate_map
    text = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("input"), F.lit(""))
    rel = F.coalesce(F.col("relation"), F.array())
    s = (lambda x: py_strip(F.coalesce(x, F.lit(""))))
    relation = F.transform(
        rel, lambda r: F.struct(s(r["head"]).alias("head"), s(r["relation"]).alias("relation"), s(r["tail"]).alias("tail"))
    )
    has_types = F.exists(rel, lambda r: F.coalesce(r["head_type"], F.lit("")) != "")
    src = F.col("source") if source is None else (F.lit(source) if isinstance(source, str) else source)
    return df.select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        map_lookup(F.coalesce(F.col("cate"), F.lit("")), cate_map).alias("cate"),
        py_strip(text).alias("input"),
        relation.alias("relation"),
        src.alias("source"),
        F.when(has_types, F.transform(rel, lambda r: F.coalesce(r["head_type"], F.lit("")))).alias("head_types"),
        F.when(has_types, F.transform(rel, lambda r: F.coalesce(r["tail_type"], F.lit("")))).alias("tail_types"),
    )


def check_normalized(df: DataFrame, old_names=tuple(CATE_MAP)) -> DataFrame:
    """Violation counts of the post-conditions (input present, relation is a
    list, no old category name); a caller raises when any is non-zero."""
    return df.agg(
        F.count_if(F.col("input").isNull()).alias("missing_input"),
        F.count_if(F.col("relation").isNull()).alias("missing_relation"),
        F.count_if(F.col("cate").isin(*old_names) if old_names else F.lit(False)).alias("old_cate"),
    )


def output_json_len(rel: Column) -> Column:
    """``len(json.dumps(relation, ensure_ascii=False))`` natively: Spark's
    compact JSON plus the five separator spaces per object and one per comma."""
    n = F.size(rel)
    return F.when(n == 0, F.lit(2)).otherwise(F.length(F.to_json(rel)) + 6 * n - 1)


def max_head_tail_len(rel: Column) -> Column:
    return F.aggregate(rel, F.lit(0), lambda acc, r: F.greatest(acc, F.length(r["head"]), F.length(r["tail"])))


def with_measures(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("input_len", F.length("input"))
        .withColumn("relation_count", F.size("relation"))
        .withColumn("output_len", output_json_len(F.col("relation")))
        .withColumn("head_tail_len", max_head_tail_len(F.col("relation")))
    )


def hard_reason(limits: dict | None = None) -> Column:
    """First failing hard rule (order fixed), null when all pass."""
    lim = {**HARD_LIMITS, **(limits or {})}
    return (
        F.when(F.col("relation_count") < lim["min_relations"], F.lit("empty_relation"))
        .when(F.col("relation_count") > lim["max_relations"], F.lit("too_many_relations"))
        .when(F.col("input_len") < lim["min_input_len"], F.lit("too_short_input"))
        .when(F.col("input_len") > lim["max_input_len"], F.lit("too_long_input"))
        .when(F.col("output_len") > lim["max_output_json_len"], F.lit("too_long_output"))
        .when(F.col("head_tail_len") > lim["max_head_tail_len"], F.lit("too_long_head_tail"))
    )


def leak_keys(*holdouts: DataFrame, on: str = "input") -> DataFrame:
    """Distinct SHA-256 keys of the held-out texts (union of sets)."""
    keys = None
    for h in holdouts:
        k = h.select(F.sha2(F.col(on), 256).alias("_leak_key"))
        keys = k if keys is None else keys.unionByName(k)
    return keys.distinct()


#: Shares into which one text's rows are dealt where the number of partitions is given.
SHARES = 8


def mark_leaks(train: DataFrame, keys: DataFrame, on: str = "input", parts: int | None = None) -> DataFrame:
    """``leaked`` flag by exact text membership in the held-out sets.

    Joins on a 32-byte hash, not the text.  AQE turns this into a broadcast
    join when the key set is small at run time and otherwise splits skewed
    partitions (a hot text on the train side).  The key side is distinct, so
    the left join cannot multiply rows.

    ``parts``: the number of partitions, for records that are many for those of
    the session.  AQE does not split these, so the rows of a text are dealt into
    ``SHARES`` and meet a copy of its key in each."""
    k = keys.withColumn("_leak", F.lit(True))
    if parts is not None:
        by = ["_leak_key", "_share"]
        k = k.withColumn("_share", F.explode(F.array(*[F.lit(i) for i in range(SHARES)]))).repartition(parts, *by)
        share = F.pmod(F.xxhash64("id"), F.lit(SHARES)).cast("int")
        t = train.withColumn("_leak_key", F.sha2(F.col(on), 256)).withColumn("_share", share).repartition(parts, *by)
        return t.join(k, by, "left").withColumn("leaked", F.coalesce(F.col("_leak"), F.lit(False))).drop(*by, "_leak")
    return (
        train.withColumn("_leak_key", F.sha2(F.col(on), 256))
        .join(k, "_leak_key", "left")
        .withColumn("leaked", F.coalesce(F.col("_leak"), F.lit(False)))
        .drop("_leak_key", "_leak")
    )


def topic_quantiles(train: DataFrame, pcts=QUANTILE_PCTS) -> DataFrame:
    """Nearest-rank quantiles per topic for the four measures (long format)."""
    m = with_measures(train) if "output_len" not in train.columns else train
    return nearest_rank(m, "cate", {k: F.col(k) for k in MEASURES}, pcts)


def soft_caps(quantiles: DataFrame, pcts: dict | None = None, compat: bool = False) -> DataFrame:
    """One row per topic with a cap per measure.  ``compat=True`` reproduces
    the reference, where every measure uses the input-length percentile."""
    p = {**SOFT_PCTS, **(pcts or {})}
    aggs = []
    for m in MEASURES:
        pct = p["input_len"] if compat else p[m]
        aggs.append(F.max(F.when(F.col("measure") == m, F.col(f"P{pct}"))).alias(f"cap_{m}"))
    return quantiles.groupBy("cate").agg(*aggs)


def soft_reason() -> Column:
    """Per-topic cap rules, strict ``>``, order input -> count -> output ->
    head/tail; a topic without caps passes (null caps never fire)."""
    return (
        F.when(F.col("input_len") > F.col("cap_input_len"), F.lit("soft_input_len_exceed"))
        .when(F.col("relation_count") > F.col("cap_relation_count"), F.lit("soft_relation_count_exceed"))
        .when(F.col("output_len") > F.col("cap_output_len"), F.lit("soft_output_len_exceed"))
        .when(F.col("head_tail_len") > F.col("cap_head_tail_len"), F.lit("soft_head_tail_len_exceed"))
    )


def apply_filters(
    train: DataFrame, *holdouts: DataFrame, limits: dict | None = None, pcts: dict | None = None,
    compat: bool = False, parts: int | None = None,
) -> DataFrame:
    """Annotate every train row with ``reject_reason``: hard rule, then
    ``leak_with_valid_test`` (only for hard-passing rows), then soft caps
    computed from the **unfiltered** train set.  Null = kept."""
    m = with_measures(train)
    caps = soft_caps(topic_quantiles(m), pcts, compat)
    flagged = mark_leaks(m, leak_keys(*holdouts), parts=parts) if holdouts else m.withColumn("leaked", F.lit(False))
    hr = hard_reason(limits)
    reason = F.coalesce(hr, F.when(F.col("leaked"), F.lit("leak_with_valid_test")), soft_reason())
    # one row a topic: by a shuffle all records of a topic would meet in one task
    return flagged.join(F.broadcast(caps), "cate", "left").withColumn("reject_reason", reason).drop(*[f"cap_{x}" for x in MEASURES])


def match_ratio(rel: Column, text: Column) -> Column:
    """Share of relations whose head and tail both occur in the text; 0.0
    when there are none (an empty string always occurs)."""
    n = F.size(rel)
    hit = F.size(F.filter(rel, lambda r: F.contains(text, r["head"]) & F.contains(text, r["tail"])))
    return F.when(n == 0, F.lit(0.0)).otherwise(hit.cast("double") / n)


def with_quality_tier(df: DataFrame, cfg: dict | None = None) -> DataFrame:
    """Tier from three dimensions; decided on the unrounded ratio, stored
    rounded to 4 places (like the reference)."""
    q = {**QUALITY, **(cfg or {})}
    lo_r, hi_r = q["ideal_relation_range"]
    lo_l, hi_l = q["ideal_input_len_range"]
    n = F.size("relation")
    ln = F.length("input")
    d = (
        df.withColumn("_ratio", match_ratio(F.col("relation"), F.col("input")))
        .withColumn(
            "quality_dims",
            F.struct(
                (F.col("_ratio") >= q["match_ratio_high"]).alias("match"),
                n.between(lo_r, hi_r).alias("rel_count"),
                ln.between(lo_l, hi_l).alias("input_len"),
            ),
        )
    )
    score = sum(F.col(f"quality_dims.{k}").cast("int") for k in ("match", "rel_count", "input_len"))
    tier = (
        F.when((F.col("_ratio") >= q["match_ratio_high"]) & (score >= 2), F.lit("high"))
        .when((F.col("_ratio") >= q["match_ratio_medium"]) & (score >= 1), F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    return d.withColumn("quality_tier", tier).withColumn("match_ratio", F.round("_ratio", 4)).drop("_ratio")


def complexity() -> Column:
    n, ln = F.col("n_relations"), F.col("input_len")
    return F.when((n <= 3) & (ln < 100), F.lit("simple")).when((n <= 6) & (ln < 250), F.lit("medium")).otherwise(
        F.lit("complex")
    )


def tier_crosstab(tiered: DataFrame) -> DataFrame:
    """Topic x tier counts with the high share (pivot on known values)."""
    p = tiered.groupBy("cate").pivot("quality_tier", ["high", "medium", "low"]).count().na.fill(0)
    tot = F.col("high") + F.col("medium") + F.col("low")
    return p.withColumn("total", tot).withColumn("high_pct", F.col("high") / tot)


def retention(annotated: DataFrame) -> DataFrame:
    """Per topic: kept / original in one conditional aggregate."""
    return annotated.groupBy("cate").agg(
        F.count(F.lit(1)).alias("original"),
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
    ).withColumn("retention", F.col("kept") / F.col("original"))


def tier_report(tiered: DataFrame) -> DataFrame:
    """Tier counts, mean ratio, exact-match count, per-dimension pass rates."""
    n = F.count(F.lit(1))
    return tiered.agg(
        n.alias("n"),
        F.count_if(F.col("quality_tier") == "high").alias("high"),
        F.count_if(F.col("quality_tier") == "medium").alias("medium"),
        F.count_if(F.col("quality_tier") == "low").alias("low"),
        F.avg(F.col("match_ratio")).alias("mean_match_ratio"),
        F.count_if(F.col("match_ratio") >= 1.0).alias("exact_match"),
        (F.count_if("quality_dims.match") / n).alias("match_rate"),
        (F.count_if("quality_dims.rel_count") / n).alias("rel_count_rate"),
        (F.count_if("quality_dims.input_len") / n).alias("input_len_rate"),
    )
