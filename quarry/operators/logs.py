"""Benchmark and training-log summaries (small per-config / per-run
aggregates over append-only logs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.operators.stats import order_statistic

TTFT_SHARE = 0.15  # fixed value: time-to-first-token estimate = 15 % of total time


def bench_summary(log: DataFrame) -> DataFrame:
    """Per config over its ok requests: time mean/min/max, ``p95 =
    sorted[int(n*0.95)]``, throughput (tokens / time) mean/min/max, mean output
    tokens, TTFT mean/min/max or the 15 % estimate when none was logged.
    A config without an ok request has status ``all_failed`` and null figures."""
    ok = F.col("status") == "ok"
    good = log.filter(ok)
    p95 = order_statistic(good.select("config", "time_total_s"), "config", "time_total_s", lambda n: F.floor(n * F.lit(0.95)), 0.95, "time_p95")
    time, rate = F.when(ok, F.col("time_total_s")), F.when(ok, F.col("completion_tokens") / F.col("time_total_s"))
    ttft = F.when(ok, F.col("ttft_s"))
    agg = log.groupBy("config").agg(
        F.count_if(ok).alias("runs"),
        F.avg(time).alias("time_mean"), F.min(time).alias("time_min"), F.max(time).alias("time_max"),
        F.avg(rate).alias("tps_mean"), F.min(rate).alias("tps_min"), F.max(rate).alias("tps_max"),
        F.avg(F.when(ok, F.col("completion_tokens"))).alias("completion_tokens_avg"),
        F.avg(ttft).alias("_ttft"), F.min(ttft).alias("ttft_min"), F.max(ttft).alias("ttft_max"),
    )
    return agg.join(p95, "config", "left").select(
        "config", F.when(F.col("runs") > 0, F.lit("ok")).otherwise(F.lit("all_failed")).alias("status"),
        "runs", "time_mean", "time_min", "time_max", "time_p95", "tps_mean", "tps_min", "tps_max",
        "completion_tokens_avg", F.coalesce("_ttft", F.col("time_mean") * TTFT_SHARE).alias("ttft_mean"), "ttft_min", "ttft_max",
        F.col("_ttft").isNull().alias("ttft_estimated"),
    )


def concurrency_summary(log: DataFrame) -> DataFrame:
    """Two levels: per (config, run) the batch time (slowest request, failed
    ones too) and counts; per config batch-time stats over all batches, pooled
    throughput of the ok requests (0 for a request that took no time),
    successes and errors."""
    ok = F.col("status") == "ok"
    rate = F.when(ok, F.when(F.col("time_total_s") > 0, F.col("completion_tokens") / F.col("time_total_s")).otherwise(F.lit(0.0)))
    runs = log.groupBy("config", "run").agg(
        F.max("time_total_s").alias("batch_time"), F.count_if(ok).alias("n_success"), F.count_if(~ok).alias("n_errors"),
        F.sum(rate).alias("_rates"), F.min(rate).alias("_low"), F.max(rate).alias("_high"),
    )
    return runs.groupBy("config").agg(
        F.count(F.lit(1)).alias("runs"), F.avg("batch_time").alias("batch_mean"), F.min("batch_time").alias("batch_min"),
        F.max("batch_time").alias("batch_max"), F.sum("n_success").cast("bigint").alias("total_requests"),
        F.sum("n_errors").cast("bigint").alias("total_errors"),
        (F.sum("_rates") / F.nullif(F.sum("n_success"), F.lit(0))).alias("tps_mean"), F.min("_low").alias("tps_min"), F.max("_high").alias("tps_max"),
    )


def speedup_summary(log: DataFrame) -> DataFrame:
    """Per (prompt_len, gen_len): mean time without and with the cache, the
    latter's prefill and decode parts, tokens/s (with the cache: of the decode
    part) and the speed-up."""
    cached = F.col("mode") == "cache"
    g = log.groupBy("prompt_len", "gen_len").agg(
        F.avg(F.when(~cached, F.col("time_s"))).alias("no_cache_time_s"),
        F.avg(F.when(cached, F.col("time_s"))).alias("cache_time_s"),
        F.avg(F.when(cached, F.col("prefill_s"))).alias("cache_prefill_time_s"),
        F.avg(F.when(cached, F.col("time_s") - F.col("prefill_s"))).alias("cache_decode_time_s"),
    )

    def over(x, y, otherwise):
        return F.when(y > 0, x / y).when(y.isNotNull(), F.lit(otherwise))

    plain, cache, decode = F.col("no_cache_time_s"), F.col("cache_time_s"), F.col("cache_decode_time_s")
    return g.select(
        "prompt_len", "gen_len", "no_cache_time_s", "cache_time_s", "cache_prefill_time_s", "cache_decode_time_s",
        over(F.col("gen_len"), plain, 0.0).alias("no_cache_tps"), over(F.col("gen_len"), decode, 0.0).alias("cache_decode_tps"),
        F.when(plain.isNotNull(), over(plain, cache, float("inf"))).alias("speedup"),
    )


def speedup_range(table: DataFrame) -> DataFrame:
    return table.agg(F.min("speedup").alias("min_speedup"), F.avg(F.col("speedup")).alias("mean_speedup"),
                     F.max("speedup").alias("max_speedup"), F.count(F.lit(1)).alias("cells"))


def weighted_loss(log: DataFrame, by="run") -> DataFrame:
    """Token-weighted mean loss ``sum(loss*w)/sum(w)`` over batches with w > 0;
    NaN when no batch has weight or when a weighted loss is NaN."""
    w = F.col("weight")
    return log.groupBy(by).agg(
        F.coalesce(F.sum(F.when(w > 0, F.col("loss") * w)) / F.nullif(F.sum(F.when(w > 0, w)), F.lit(0)),
                   F.lit(float("nan"))).alias("weighted_loss"),
        F.sum(F.when(w > 0, w)).cast("bigint").alias("total_weight"),
    )


def log_summary(log: DataFrame, by="run") -> DataFrame:
    """Per run: first and last step with their train and validation loss, the
    best validation loss and the first step that reached it."""
    def first(c):
        return F.min_by(c, "step").alias(f"first_{c}")

    def last(c):
        return F.max_by(c, "step").alias(f"last_{c}")

    return log.groupBy(by).agg(
        F.min("step").alias("first_step"), F.max("step").alias("last_step"), first("loss"), last("loss"), first("val_loss"), last("val_loss"),
        F.min("val_loss").alias("best_val_loss"), F.min_by("step", F.struct("val_loss", "step")).alias("best_step"),
        F.count(F.lit(1)).alias("evals"),
    )


def best_so_far(log: DataFrame, by="run", bucket: int = 65_536) -> DataFrame:
    """``is_best``: strictly below every earlier validation loss of the run.

    Two levels: a running minimum over the minima of step buckets (one row for
    each ``bucket`` steps), then over the rows inside one bucket, so no window
    holds a whole run."""
    x = log.withColumn("_b", F.floor(F.col("step") / bucket))
    lows = x.groupBy(by, "_b").agg(F.min("val_loss").alias("_low"))
    before = W.partitionBy(by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    lows = lows.select(by, "_b", F.min("_low").over(before).alias("_before"))
    inside = F.min("val_loss").over(W.partitionBy(by, "_b").orderBy("step").rowsBetween(W.unboundedPreceding, -1))
    x = x.join(lows, [by, "_b"]).withColumn("_prev", F.least(inside, F.col("_before")))  # least() skips nulls
    return x.withColumn("is_best", F.col("_prev").isNull() | (F.col("val_loss") < F.col("_prev"))).drop("_b", "_before", "_prev")


def status_tally(df: DataFrame, col: str = "status") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def compare_baseline(summary_long: DataFrame, baseline_long: DataFrame) -> DataFrame:
    """Round summary vs a stored baseline, both long ``(metric, value)``:
    an equi-join on the metric name (no cross join), plus the delta."""
    b = baseline_long.withColumnRenamed("value", "baseline")
    return summary_long.join(b, "metric", "left").withColumn("delta", F.col("value") - F.col("baseline"))
