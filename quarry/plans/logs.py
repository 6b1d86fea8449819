"""Benchmark-log and training-log summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import logs as lg
from quarry.sources.adapters import bench_log, kv_log, train_log


def q_bench_summary(spark, sf_dir):
    return lg.bench_summary(bench_log(spark, sf_dir))


def q_concurrency_summary(spark, sf_dir):
    return lg.concurrency_summary(bench_log(spark, sf_dir))


def q_speedup_summary(spark, sf_dir):
    return lg.speedup_summary(kv_log(spark, sf_dir))


def q_speedup_range(spark, sf_dir):
    return lg.speedup_range(lg.speedup_summary(kv_log(spark, sf_dir)))


def q_loss_weighted(spark, sf_dir):
    return lg.weighted_loss(train_log(spark, sf_dir))


def q_log_summary(spark, sf_dir):
    return lg.log_summary(train_log(spark, sf_dir))


def q_best_checkpoints(spark, sf_dir):
    return lg.best_so_far(train_log(spark, sf_dir)).filter("is_best").select("run", "step", "val_loss")


def q_status_tally(spark, sf_dir):
    return lg.status_tally(bench_log(spark, sf_dir))


def q_baseline_compare(spark, sf_dir):
    s = lg.bench_summary(bench_log(spark, sf_dir))
    long = s.select("config", F.explode(F.array(
        F.struct(F.lit("time_mean").alias("metric"), F.col("time_mean").alias("value")),
        F.struct(F.lit("tps_mean").alias("metric"), F.col("tps_mean").alias("value")))).alias("m")).select("config", "m.*")
    base = long.filter(F.col("config") == "view").select("metric", "value")
    return lg.compare_baseline(long, base)


QUERIES = {
    "bench_summary": q_bench_summary,
    "concurrency_summary": q_concurrency_summary,
    "speedup_summary": q_speedup_summary,
    "speedup_range": q_speedup_range,
    "loss_weighted": q_loss_weighted,
    "log_summary": q_log_summary,
    "best_checkpoints": q_best_checkpoints,
    "status_tally": q_status_tally,
    "baseline_compare": q_baseline_compare,
}

BENCH = """raw AS (SELECT *, user_id % 40 = 3 AS down, user_id % 3 AS run FROM events),
bl AS (SELECT CASE WHEN down THEN event_type || '-down' ELSE event_type END AS config, run, event_id, value AS time_total_s,
  CAST(event_id % 256 AS INTEGER) AS completion_tokens, CASE WHEN event_type = 'click' THEN value / 10 END AS ttft_s,
  CASE WHEN event_id % 256 > 0 AND value > 0 AND NOT down AND NOT (event_type = 'view' AND run = 1) THEN 'ok' ELSE 'error' END AS status FROM raw),
ok AS (SELECT *, completion_tokens / time_total_s AS tp FROM bl WHERE status = 'ok'),
good AS (SELECT config, count(*) AS runs, avg(time_total_s) AS time_mean, min(time_total_s) AS time_min, max(time_total_s) AS time_max,
  list_sort(list(time_total_s))[CAST(floor(count(*) * 0.95::DOUBLE) AS BIGINT) + 1] AS time_p95,
  avg(tp) AS tps_mean, min(tp) AS tps_min, max(tp) AS tps_max, avg(completion_tokens) AS completion_tokens_avg,
  coalesce(avg(ttft_s), avg(time_total_s) * 0.15::DOUBLE) AS ttft_mean, min(ttft_s) AS ttft_min, max(ttft_s) AS ttft_max,
  count(ttft_s) = 0 AS ttft_estimated FROM ok GROUP BY config),
bs AS (SELECT config, CASE WHEN runs > 0 THEN 'ok' ELSE 'all_failed' END AS status, coalesce(runs, 0) AS runs,
  good.* EXCLUDE (config, runs, ttft_estimated), coalesce(ttft_estimated, true) AS ttft_estimated
  FROM (SELECT DISTINCT config FROM bl) AS c LEFT JOIN good USING (config))"""
KV = """kv AS (SELECT 128 * (1 + user_id % 4) AS prompt_len, 64 * (1 + event_id % 2) AS gen_len,
  CASE WHEN event_id % 3 = 0 THEN 'no_cache' ELSE 'cache' END AS mode, value AS time_s, value * (1 + user_id % 4) / 8 AS prefill_s FROM events),
sp AS (SELECT prompt_len, gen_len, avg(time_s) FILTER (WHERE mode = 'no_cache') AS no_cache_time_s,
  avg(time_s) FILTER (WHERE mode = 'cache') AS cache_time_s, avg(prefill_s) FILTER (WHERE mode = 'cache') AS cache_prefill_time_s,
  avg(time_s - prefill_s) FILTER (WHERE mode = 'cache') AS cache_decode_time_s FROM kv GROUP BY ALL),
spd AS (SELECT *, CASE WHEN no_cache_time_s > 0 THEN gen_len / no_cache_time_s WHEN no_cache_time_s IS NOT NULL THEN 0 END AS no_cache_tps,
  CASE WHEN cache_decode_time_s > 0 THEN gen_len / cache_decode_time_s WHEN cache_decode_time_s IS NOT NULL THEN 0 END AS cache_decode_tps,
  CASE WHEN no_cache_time_s IS NULL THEN NULL WHEN cache_time_s > 0 THEN no_cache_time_s / cache_time_s WHEN cache_time_s IS NOT NULL THEN 'Infinity'::DOUBLE END AS speedup FROM sp)"""
TRAIN = """tl AS (SELECT event_type AS run, event_id AS step, value AS val_loss, value / 10 AS loss, user_id % 5 AS weight FROM events)"""

ORACLE = {
    "bench_summary": f"WITH {BENCH} SELECT * FROM bs",
    "concurrency_summary": f"""WITH {BENCH}, r AS (SELECT config, run, max(time_total_s) AS batch_time,
  count(*) FILTER (WHERE status = 'ok') AS n_success, count(*) FILTER (WHERE status <> 'ok') AS n_errors FROM bl GROUP BY ALL),
per AS (SELECT config, count(*) AS runs, avg(batch_time) AS batch_mean, min(batch_time) AS batch_min, max(batch_time) AS batch_max,
  CAST(sum(n_success) AS BIGINT) AS total_requests, CAST(sum(n_errors) AS BIGINT) AS total_errors FROM r GROUP BY config),
tp AS (SELECT config, avg(v) AS tps_mean, min(v) AS tps_min, max(v) AS tps_max
  FROM (SELECT config, CASE WHEN time_total_s > 0 THEN tp ELSE 0 END AS v FROM ok) AS q GROUP BY config)
SELECT per.*, tp.tps_mean, tp.tps_min, tp.tps_max FROM per LEFT JOIN tp USING (config)""",
    "speedup_summary": f"""WITH {KV} SELECT * FROM spd""",
    "speedup_range": f"""WITH {KV} SELECT min(speedup) AS min_speedup, avg(speedup) AS mean_speedup, max(speedup) AS max_speedup, count(*) AS cells FROM spd""",
    "loss_weighted": f"""WITH {TRAIN} SELECT run, coalesce(sum(loss * weight) FILTER (WHERE weight > 0) / nullif(sum(weight) FILTER (WHERE weight > 0), 0), 'NaN'::DOUBLE) AS weighted_loss,
  CAST(sum(weight) FILTER (WHERE weight > 0) AS BIGINT) AS total_weight FROM tl GROUP BY run""",
    "log_summary": f"""WITH {TRAIN} SELECT run, min(step) AS first_step, max(step) AS last_step,
  arg_min(loss, step) AS first_loss, arg_max(loss, step) AS last_loss, arg_min(val_loss, step) AS first_val_loss, arg_max(val_loss, step) AS last_val_loss,
  min(val_loss) AS best_val_loss, first(step ORDER BY val_loss, step) AS best_step, count(*) AS evals FROM tl GROUP BY run""",
    "best_checkpoints": f"""WITH {TRAIN} SELECT run, step, val_loss FROM (SELECT *, min(val_loss) OVER (PARTITION BY run ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM tl) WHERE prev IS NULL OR val_loss < prev""",
    "status_tally": f"WITH {BENCH} SELECT status, count(*) AS count FROM bl GROUP BY status",
    "baseline_compare": f"""WITH {BENCH}, long AS (SELECT config, 'time_mean' AS metric, time_mean AS value FROM bs UNION ALL
  SELECT config, 'tps_mean', tps_mean FROM bs), base AS (SELECT metric, value AS baseline FROM long WHERE config = 'view')
SELECT long.metric, config, value, baseline, value - baseline AS delta FROM long LEFT JOIN base USING (metric)""",
}
