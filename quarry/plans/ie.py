"""Instruction-extraction record queries: normalize, filters, leakage,
quantiles, tiers and their reports (adapter: one IE record per order)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import ie
from quarry.plans.corpus import WS_SQL
from quarry.session import cut_lineage
from quarry.sources.adapters import IE_CATE_MAP, ie_categories, ie_raw, ie_src, record_partitions

# Thresholds scaled to the adapter's records (library defaults stay the reference's).
IE_LIMITS = {"max_relations": 9, "min_input_len": 35, "max_input_len": 98, "max_output_json_len": 560,
             "max_head_tail_len": 11}
IE_QUALITY = {"ideal_input_len_range": (30, 90)}


def normalized(spark, sf_dir):
    return ie.normalize_ie(ie_src(spark, sf_dir), cate_map=IE_CATE_MAP)


def materialized(spark, sf_dir):
    """Normalized records materialised once (reliable checkpoint), like the
    reference's step-1 output file: they feed four branches (train, two
    hold-outs, quantiles) and the topic schema."""
    return cut_lineage(normalized(spark, sf_dir))


def split_sets(spark, sf_dir, n=None):
    n = materialized(spark, sf_dir) if n is None else n
    return n.filter(F.col("source") == "train"), n.filter(F.col("source") == "valid"), n.filter(F.col("source") == "test")


def filtered(spark, sf_dir, n=None):
    train, valid, test = split_sets(spark, sf_dir, n)
    return ie.apply_filters(train, valid, test, limits=IE_LIMITS, parts=record_partitions(spark, sf_dir))


def kept(spark, sf_dir, n=None):
    return filtered(spark, sf_dir, n).filter(F.col("reject_reason").isNull())


def tiered(spark, sf_dir, n=None):
    return ie.with_quality_tier(kept(spark, sf_dir, n), IE_QUALITY)


def q_ie_normalize(spark, sf_dir):
    m = ie.with_measures(normalized(spark, sf_dir))
    return m.select("id", "cate", "source", "input_len", "relation_count", "output_len", "head_tail_len",
                    F.col("head_types").isNotNull().alias("has_types"))


def q_ie_leakage(spark, sf_dir):
    train, valid, test = split_sets(spark, sf_dir, normalized(spark, sf_dir))
    return ie.mark_leaks(train, ie.leak_keys(valid, test)).filter("leaked").select("id", "cate")


def q_topic_quantiles(spark, sf_dir):
    train, _, _ = split_sets(spark, sf_dir, normalized(spark, sf_dir))
    return ie.topic_quantiles(train)


def q_ie_filter(spark, sf_dir):
    return filtered(spark, sf_dir).select("id", "cate", "reject_reason")


def q_ie_reason_counts(spark, sf_dir):
    f = filtered(spark, sf_dir)
    return f.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("count"))


def q_quality_tier(spark, sf_dir):
    t = tiered(spark, sf_dir)
    return t.select("id", "cate", "quality_tier", "match_ratio",
                    F.col("quality_dims.match").alias("dim_match"),
                    F.col("quality_dims.rel_count").alias("dim_rel_count"),
                    F.col("quality_dims.input_len").alias("dim_input_len"))


def q_tier_crosstab(spark, sf_dir):
    return ie.tier_crosstab(tiered(spark, sf_dir))


def q_ie_retention(spark, sf_dir):
    return ie.retention(filtered(spark, sf_dir))


def q_tier_report(spark, sf_dir):
    return ie.tier_report(tiered(spark, sf_dir))


def train_categories(spark, sf_dir):
    """Category of the training records: needs no relations, so no line items."""
    renamed = ie.map_lookup(F.coalesce(F.col("cate"), F.lit("")), IE_CATE_MAP)
    return ie_categories(spark, sf_dir).filter(F.col("source") == "train").select(renamed.alias("cate"))


def q_cate_distribution(spark, sf_dir):
    from quarry.operators.stats import distribution

    return distribution(train_categories(spark, sf_dir), "cate")


def q_ie_check(spark, sf_dir):
    return ie.check_normalized(normalized(spark, sf_dir), old_names=tuple(IE_CATE_MAP))


def q_ie_normalize_raw(spark, sf_dir):
    """Normalization of records with ``text`` and entity types."""
    n = ie.normalize_ie(ie_raw(spark, sf_dir), cate_map=IE_CATE_MAP)
    return n.select("id", F.sha2("input", 256).alias("input_hash"), F.array_join("head_types", ",").alias("head_types"), F.array_join("tail_types", ",").alias("tail_types"))


QUERIES = {
    "ie_normalize": q_ie_normalize,
    "ie_normalize_raw": q_ie_normalize_raw,
    "ie_leakage": q_ie_leakage,
    "topic_quantiles": q_topic_quantiles,
    "ie_filter": q_ie_filter,
    "ie_reason_counts": q_ie_reason_counts,
    "quality_tier": q_quality_tier,
    "tier_crosstab": q_tier_crosstab,
    "ie_retention": q_ie_retention,
    "tier_report": q_tier_report,
    "cate_distribution": q_cate_distribution,
    "ie_check": q_ie_check,
}

# ---------------------------------------------------------------- oracle SQL
L = IE_LIMITS
IE_SQL = f"""rel AS (
  SELECT l.l_orderkey AS o_orderkey, p.p_brand AS head, p.p_type AS relation, p.p_name AS tail,
    row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity) AS pos
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
relagg AS (
  SELECT o_orderkey,
    list({{'head': head, 'relation': relation, 'tail': tail}} ORDER BY pos) AS relation,
    string_agg(head || ' ' || tail, '; ' ORDER BY pos) FILTER (WHERE pos <= 4) AS first4,
    count(*) AS n_rel,
    sum(length(head) + length(relation) + length(tail) + 40) + 2 * count(*) AS output_len,
    max(greatest(length(head), length(tail))) AS head_tail_len
  FROM rel GROUP BY o_orderkey),
ie AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE c.c_mktsegment END AS cate,
    trim(c.c_mktsegment || ' order: ' || coalesce(r.first4, ''), {WS_SQL}) AS input,
    CAST(coalesce(r.n_rel, 0) AS INTEGER) AS relation_count,
    CAST(coalesce(r.output_len, 2) AS INTEGER) AS output_len,
    CAST(coalesce(r.head_tail_len, 0) AS INTEGER) AS head_tail_len,
    coalesce(r.relation, []) AS relation,
    CASE WHEN o.o_orderkey % 20 = 0 THEN 'valid' WHEN o.o_orderkey % 20 = 1 THEN 'test' ELSE 'train' END AS source
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN relagg r ON r.o_orderkey = o.o_orderkey),
iem AS (SELECT *, CAST(length(input) AS INTEGER) AS input_len FROM ie),
train AS (SELECT * FROM iem WHERE source = 'train'),
leakset AS (SELECT DISTINCT input FROM iem WHERE source IN ('valid', 'test')),
qlong AS (
  SELECT cate, 'input_len' AS measure, input_len AS v FROM train UNION ALL
  SELECT cate, 'output_len', output_len FROM train UNION ALL
  SELECT cate, 'relation_count', relation_count FROM train UNION ALL
  SELECT cate, 'head_tail_len', head_tail_len FROM train),
quant AS (
  SELECT cate, measure,
    CAST(l[CAST(least(floor(n * 75 / 100), n - 1) AS BIGINT) + 1] AS BIGINT) AS P75,
    CAST(l[CAST(least(floor(n * 90 / 100), n - 1) AS BIGINT) + 1] AS BIGINT) AS P90,
    CAST(l[CAST(least(floor(n * 95 / 100), n - 1) AS BIGINT) + 1] AS BIGINT) AS P95,
    CAST(l[CAST(least(floor(n * 99 / 100), n - 1) AS BIGINT) + 1] AS BIGINT) AS P99
  FROM (SELECT cate, measure, list_sort(list(v)) AS l, count(*) AS n FROM qlong GROUP BY cate, measure)),
caps AS (
  SELECT cate,
    max(P99) FILTER (WHERE measure = 'input_len') AS c_in, max(P99) FILTER (WHERE measure = 'relation_count') AS c_rc,
    max(P99) FILTER (WHERE measure = 'output_len') AS c_out, max(P99) FILTER (WHERE measure = 'head_tail_len') AS c_ht
  FROM quant GROUP BY cate),
filtered AS (
  SELECT t.*, CASE
    WHEN relation_count < 1 THEN 'empty_relation'
    WHEN relation_count > {L['max_relations']} THEN 'too_many_relations'
    WHEN input_len < {L['min_input_len']} THEN 'too_short_input'
    WHEN input_len > {L['max_input_len']} THEN 'too_long_input'
    WHEN output_len > {L['max_output_json_len']} THEN 'too_long_output'
    WHEN head_tail_len > {L['max_head_tail_len']} THEN 'too_long_head_tail'
    WHEN input IN (SELECT input FROM leakset) THEN 'leak_with_valid_test'
    WHEN input_len > c_in THEN 'soft_input_len_exceed'
    WHEN relation_count > c_rc THEN 'soft_relation_count_exceed'
    WHEN output_len > c_out THEN 'soft_output_len_exceed'
    WHEN head_tail_len > c_ht THEN 'soft_head_tail_len_exceed'
    END AS reject_reason
  FROM train t LEFT JOIN caps USING (cate)),
kept AS (SELECT * FROM filtered WHERE reject_reason IS NULL),
tiered0 AS (
  SELECT *, CASE WHEN relation_count = 0 THEN 0.0 ELSE
      len(list_filter(relation, lambda r: contains(input, r.head) AND contains(input, r.tail)))::DOUBLE / relation_count END AS ratio
  FROM kept),
tiered1 AS (
  SELECT *, ratio >= 1.0 AS dim_match, relation_count BETWEEN 2 AND 10 AS dim_rel_count,
    input_len BETWEEN {IE_QUALITY['ideal_input_len_range'][0]} AND {IE_QUALITY['ideal_input_len_range'][1]} AS dim_input_len
  FROM tiered0),
tiered AS (
  SELECT *, round(ratio, 4) AS match_ratio,
    CASE WHEN ratio >= 1.0 AND (dim_match::INT + dim_rel_count::INT + dim_input_len::INT) >= 2 THEN 'high'
         WHEN ratio >= 0.8 AND (dim_match::INT + dim_rel_count::INT + dim_input_len::INT) >= 1 THEN 'medium'
         ELSE 'low' END AS quality_tier
  FROM tiered1)"""

ORACLE = {
    "ie_normalize": f"WITH {IE_SQL} SELECT id, cate, source, input_len, relation_count, output_len, head_tail_len, false AS has_types FROM iem",
    "ie_normalize_raw": f"""WITH {IE_SQL}, typed AS (SELECT *, CAST(id AS BIGINT) % 4 = 0 AND len(relation) > 0 AS has_types FROM iem)
SELECT id, sha256(CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'T: ' || input ELSE input END) AS input_hash,
  CASE WHEN has_types THEN array_to_string(list_transform(relation, lambda r, i: CASE WHEN i % 2 = 1 THEN upper(substr(r.head, 1, 5)) ELSE '' END), ',') END AS head_types,
  CASE WHEN has_types THEN array_to_string(list_transform(relation, lambda r: substr(r.tail, 1, 3)), ',') END AS tail_types FROM typed""",
    "ie_leakage": f"WITH {IE_SQL} SELECT id, cate FROM train WHERE input IN (SELECT input FROM leakset)",
    "topic_quantiles": f"WITH {IE_SQL} SELECT * FROM quant",
    "ie_filter": f"WITH {IE_SQL} SELECT id, cate, reject_reason FROM filtered",
    "ie_reason_counts": f"WITH {IE_SQL} SELECT coalesce(reject_reason, 'kept') AS reason, count(*) AS count FROM filtered GROUP BY 1",
    "quality_tier": f"WITH {IE_SQL} SELECT id, cate, quality_tier, match_ratio, dim_match, dim_rel_count, dim_input_len FROM tiered",
    "tier_crosstab": f"""WITH {IE_SQL}
SELECT cate, count(*) FILTER (WHERE quality_tier = 'high') AS high, count(*) FILTER (WHERE quality_tier = 'medium') AS medium,
  count(*) FILTER (WHERE quality_tier = 'low') AS low, count(*) AS total,
  count(*) FILTER (WHERE quality_tier = 'high') / count(*) AS high_pct
FROM tiered GROUP BY cate""",
    "ie_retention": f"""WITH {IE_SQL}
SELECT cate, count(*) AS original, count(*) FILTER (WHERE reject_reason IS NULL) AS kept,
  count(*) FILTER (WHERE reject_reason IS NULL) / count(*) AS retention FROM filtered GROUP BY cate""",
    "tier_report": f"""WITH {IE_SQL}
SELECT count(*) AS n, count(*) FILTER (WHERE quality_tier = 'high') AS high,
  count(*) FILTER (WHERE quality_tier = 'medium') AS medium, count(*) FILTER (WHERE quality_tier = 'low') AS low,
  (sum(match_ratio) / nullif(count(match_ratio), 0)) AS mean_match_ratio, count(*) FILTER (WHERE match_ratio >= 1.0) AS exact_match,
  count(*) FILTER (WHERE dim_match) / count(*) AS match_rate, count(*) FILTER (WHERE dim_rel_count) / count(*) AS rel_count_rate,
  count(*) FILTER (WHERE dim_input_len) / count(*) AS input_len_rate FROM tiered""",
    "cate_distribution": f"""WITH {IE_SQL}
SELECT cate, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM train GROUP BY cate""",
    "ie_check": f"""WITH {IE_SQL}
SELECT 0::BIGINT AS missing_input, 0::BIGINT AS missing_relation, count(*) FILTER (WHERE cate = 'HOUSEHOLD') AS old_cate FROM iem""",
}


def q_top_categories(spark, sf_dir):
    from quarry.operators.stats import top_k

    return top_k(train_categories(spark, sf_dir), "cate", 3)


def q_distinct_texts(spark, sf_dir):
    """Unique inputs per split and the size of the valid ∪ test text set."""
    n = normalized(spark, sf_dir)
    per = n.groupBy("source").agg(F.count_distinct("input").alias("unique_texts"))
    held = ie.leak_keys(n.filter(F.col("source") == "valid"), n.filter(F.col("source") == "test"))
    return per.unionByName(held.agg(F.lit("valid+test").alias("source"), F.count(F.lit(1)).alias("unique_texts")))


QUERIES["top_categories"] = q_top_categories
QUERIES["distinct_texts"] = q_distinct_texts
ORACLE["top_categories"] = f"WITH {IE_SQL} SELECT cate, count(*) AS count FROM train GROUP BY cate ORDER BY count DESC, cate LIMIT 3"
ORACLE["distinct_texts"] = f"""WITH {IE_SQL} SELECT source, count(DISTINCT input) AS unique_texts FROM iem GROUP BY source
UNION ALL SELECT 'valid+test', count(DISTINCT input) FROM iem WHERE source IN ('valid', 'test')"""
