"""Stratified sampling, global ordering and splits.

Randomness is a hash of (seed, key, salt) (see :mod:`quarry.functions.draw`).
"First k of each group" is a histogram of draw buckets, a broadcast of each
group's boundary and a rank of the boundary bucket only (:func:`first_k`), so
neither a hot group nor many map tasks meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.draw import draw
from quarry.operators.ie import complexity

# ---- fixed values: reference defaults ---------------------------------------
TASK_RATIO = {"ie_extraction": 0.50, "text_to_json": 0.25, "format_following": 0.15, "schema_repair": 0.10}
QUALITY_ORDER = ["high", "medium", "low"]
COMPLEXITY_ORDER = ["medium", "simple", "complex"]
CANDIDATE_TARGET = 30000
INTERNAL_VALID_RATIO = 0.05
SEED = 42
SPOTCHECK_PER_TASK = 5
# ---------------------------------------------------------------------------


def order_index(values, col: Column) -> Column:
    """Position of ``col`` in a fixed list (0-based); null when absent."""
    m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
    return F.try_element_at(m, col)


def sample_key() -> Column:
    return F.concat_ws(":", F.col("original_id").cast("string"), F.col("task_type"))


def task_targets(target: int, ratio: dict) -> dict:
    return {t: int(target * r) for t, r in ratio.items()}


#: Fine buckets of a uniform draw within one stratum.
DRAW_BUCKETS = 1024


def first_k(df: DataFrame, keys: list, prefix: list, draw_col: str, tiebreak: str, k: Column, buckets: int = DRAW_BUCKETS) -> DataFrame:
    """The first ``k`` (an expression over ``keys``) rows of every ``keys``
    group in the order ``prefix + [draw_col, tiebreak]``.

    A histogram over (keys, prefix, draw bucket) says which bucket holds a
    group's k-th row.  That place, one row a group, is broadcast, and no row is
    shuffled to be chosen: those before the place pass, those after it do not,
    and only the rows of the bucket itself, a ``buckets``-th of a stratum, are
    ranked.  Nothing is collected and no window holds a group."""
    x = df.withColumn("_fb", F.floor(F.col(draw_col) / F.lit(2.0 ** 60) * buckets).cast("int"))
    where = [*keys, *prefix, "_fb"]
    place = F.struct(*prefix, "_fb")  # compares as ``orderBy`` does, null first
    hist = x.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy(*prefix, "_fb").rowsBetween(W.unboundedPreceding, -1)
    hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    hist = hist.withColumn("_k", k).filter(F.col("_before") < F.col("_k"))
    last = F.max_by(F.struct(place.alias("place"), "_n", (F.col("_k") - F.col("_before")).alias("room")), place).alias("_last")
    last = hist.groupBy(*keys).agg(last).select(*[F.col(c).alias(f"_h{i}") for i, c in enumerate(keys)], "_last")
    same = [F.col(c).eqNullSafe(F.col(f"_h{i}")) for i, c in enumerate(keys)]
    y = x.join(F.broadcast(last), same).select(*x.columns, "_last")
    here = place.eqNullSafe(F.col("_last.place"))
    cut = here & (F.col("_last._n") > F.col("_last.room"))
    rank = F.row_number().over(W.partitionBy(*where).orderBy(draw_col, tiebreak))
    edge = y.filter(cut).withColumn("_rn", rank).filter(F.col("_rn") <= F.col("_last.room"))
    whole = y.filter(~cut & (here | (place < F.col("_last.place"))))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


def priority_sample(derived: DataFrame, target: int = CANDIDATE_TARGET, ratio: dict | None = None, seed: int = SEED) -> DataFrame:
    """Per task: equal share per topic ``max(1, target // n_topics)`` filled in
    priority order (quality high>medium>low, then complexity
    medium>simple>complex, then random), topped up at random from the rest
    when short, trimmed at random when over.  Adds ``phase`` and ``rank``
    columns that define the sample's order.  Only one row for each task of
    ``ratio`` comes back to the driver: it decides whether any task is short
    or over, and the plan has no top-up or trim otherwise."""
    ratio = TASK_RATIO if ratio is None else ratio
    targets = {t: n for t, n in task_targets(target, ratio).items() if n > 0}
    d = derived.filter(F.col("task_type").isin(list(targets)))
    d = (
        d.withColumn("_q", order_index(QUALITY_ORDER, F.coalesce(F.col("quality_tier"), F.lit("medium"))))
        .withColumn("_c", order_index(COMPLEXITY_ORDER, complexity()))
        .withColumn("_u", draw(seed, sample_key(), "fill"))
        .withColumn("_key", sample_key())
    )
    eligible = d.filter(F.col("_q").isNotNull())
    goal = order_index_map(targets, F.col("task_type"))
    sizes = d.groupBy("task_type", "cate").agg(F.count("_q").alias("n"))
    sizes = sizes.withColumn("topics", F.count(F.lit(1)).over(W.partitionBy("task_type")))
    sizes = sizes.withColumn("share", F.greatest(F.lit(1), F.floor(goal / F.col("topics"))))
    tasks = sizes.groupBy("task_type").agg(F.first("topics").alias("topics"), F.first("share").alias("share"), F.sum(F.least("n", "share")).alias("got")).collect()
    if not tasks:
        return d.limit(0).drop("_key").withColumn("phase", F.lit(0)).withColumnsRenamed({"_q": "q_rank", "_c": "c_rank", "_u": "rank_draw"})
    share = order_index_map({r["task_type"]: r["share"] for r in tasks}, F.col("task_type"))
    s = first_k(eligible, ["task_type", "cate"], ["_q", "_c"], "_u", "_key", share).withColumn("phase", F.lit(0))
    short = {r["task_type"]: targets[r["task_type"]] - r["got"] for r in tasks if r["got"] < targets[r["task_type"]]}
    if short:
        pool = d.filter(F.col("task_type").isin(list(short))).join(
            s.select("original_id", "task_type"), ["original_id", "task_type"], "left_anti")
        pool = pool.withColumn("_t", draw(seed, F.col("_key"), "topup"))
        top = first_k(pool, ["task_type"], [], "_t", "_key", order_index_map(short, F.col("task_type")))
        s = s.unionByName(top.drop("_t").withColumn("phase", F.lit(1)))
    # shares of at least one row for each topic may add up to more than the target
    over = {r["task_type"]: targets[r["task_type"]] for r in tasks if r["share"] * r["topics"] > targets[r["task_type"]]}
    if over:
        x = s.withColumn("_r", draw(seed, F.col("_key"), "trim"))
        is_over = F.col("task_type").isin(list(over))
        s = first_k(x.filter(is_over), ["task_type"], [], "_r", "_key", order_index_map(over, F.col("task_type"))).unionByName(x.filter(~is_over)).drop("_r")
    return (
        s.withColumnRenamed("_q", "q_rank").withColumnRenamed("_c", "c_rank").withColumnRenamed("_u", "rank_draw")
        .drop("_key")
    )


def index_sample(sampled: DataFrame, name: str = "idx") -> DataFrame:
    """Sample order: task order, phase, topic, priority, random draw, key."""
    prefix = [order_index(list(TASK_RATIO), F.col("task_type")), "phase", "cate", "q_rank", "c_rank"]
    return global_index(sampled, prefix, "rank_draw", [F.col("original_id").cast("string")], name)


def order_index_map(mapping: dict, col: Column) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, col)


def global_index(df: DataFrame, prefix: list, draw_col: str, tiebreak: list, name: str = "idx",
                 buckets: int = 1024) -> DataFrame:
    """0-based position in the order ``prefix + [draw_col] + tiebreak`` without
    a single-partition window.

    ``draw_col`` is a uniform 60-bit draw, so ``(prefix, floor(draw * B / 2^60))``
    cuts the order into contiguous, similar-sized buckets.  Rows are numbered
    inside each bucket by a window partitioned on the bucket (many small
    partitions, no skew: the draw spreads even a hot prefix over B buckets),
    and each bucket's offset comes from a running sum over the tiny
    per-bucket count table (at most strata x B rows).  Everything is
    deterministic, so counts and positions always agree, also on retries."""
    pre = [F.col(c) if isinstance(c, str) else c for c in prefix]
    pre_names = [f"_gp{i}" for i in range(len(pre))]
    x = df.select("*", *[c.alias(n) for c, n in zip(pre, pre_names)],
                  F.floor(F.col(draw_col) / F.lit(2.0 ** 60) * buckets).cast("int").alias("_gb"))
    bkey = pre_names + ["_gb"]
    tb = [F.col(c) if isinstance(c, str) else c for c in tiebreak]
    w = W.partitionBy(*bkey).orderBy(F.col(draw_col), *tb)
    x = x.withColumn("_loc", F.row_number().over(w) - 1)
    counts = x.groupBy(*bkey).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(W.orderBy(*bkey).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("_cnt")
    return (
        x.join(offsets, bkey)  # one row per bucket: AQE broadcasts it
        .withColumn(name, F.col("_off") + F.col("_loc"))
        .drop(*bkey, "_loc", "_off")
    )


def exact_split(df: DataFrame, key: Column, ratio: float = INTERNAL_VALID_RATIO, seed: int = SEED, salt: str = "split") -> DataFrame:
    """Random order by hash, first ``int(n * (1 - ratio))`` rows are train."""
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()  # part of the plan: nothing runs while the query is built
    cut = F.floor(n * F.lit(1 - ratio))
    x = df.withColumn("_s", draw(seed, key, salt)).withColumn("_sk", key.cast("string"))
    return global_index(x, [], "_s", ["_sk"], "_pos").withColumn(
        "split", F.when(F.col("_pos") < cut, F.lit("train")).otherwise(F.lit("valid"))
    ).drop("_s", "_sk", "_pos")


def spotcheck(df: DataFrame, by: str, key: Column, n: int = SPOTCHECK_PER_TASK, seed: int = SEED) -> DataFrame:
    """``n`` random rows per group."""
    w = W.partitionBy(by).orderBy("_d", "_dk")
    return (
        df.withColumn("_d", draw(seed, key, "spot")).withColumn("_dk", key.cast("string"))
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_d", "_dk", "_rn")
    )


def to_chat(df: DataFrame, idx_col: str = "idx", system: str | None = None) -> DataFrame:
    """Chat-style record: ``instructie_{task}_{idx:06d}``, user = prompt,
    assistant = output (optional fixed system turn first)."""
    msgs = [F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")),
            F.struct(F.lit("assistant").alias("role"), F.col("output").alias("content"))]
    if system is not None:
        msgs.insert(0, F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    return df.select(
        F.format_string("instructie_%s_%06d", F.col("task_type"), F.col(idx_col)).alias("id"),
        F.lit("instructie").alias("source"),
        "task_type",
        F.col("cate").alias("topic_schema"),
        "quality_tier",
        F.array(*msgs).alias("messages"),
    )
