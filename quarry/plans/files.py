"""Queries over written files: each writes a report or a log with the library's
sink and returns what a reader gets back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quarry.operators import logs as lg
from quarry.operators import scoring as sc
from quarry.plans import scoring as ps
from quarry.plans.logs import BENCH
from quarry.session import checkpoint_dir
from quarry.sources import io
from quarry.sources.adapters import EVAL_GROUPS, bench_log, eval_rounds
from quarry.streaming import clean_stream as cs


def _folder(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _csv(spark, df, name, schema):
    path = _folder(spark, name)
    # a report of one row for each output is larger than the tables it is made from
    io.write_csv(df, path, compression="gzip")
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def q_detailed_csv(spark, sf_dir):
    got = _csv(spark, io.detailed_rows(ps.scored(spark, sf_dir)), "detailed", ", ".join(f"{c} string" for c in io.DETAILED))
    # an empty list is an empty cell, which a reader returns as null
    return got.na.fill("", ["missing_fields", "extra_fields"]).withColumn("raw_output", F.sha2("raw_output", 256))


def q_stability_csv(spark, sf_dir):
    wide = sc.round_wide(ps.scored(spark, sf_dir, outputs=eval_rounds), "model").withColumnRenamed("model", "round")
    text = ("round", "mode")
    return _csv(spark, io.stability_rows(wide, "default"), "stability", ", ".join(f"{c} {'string' if c in text else 'long' if c == 'total' else 'double'}" for c in io.STABILITY))


def q_bench_csv(spark, sf_dir):
    log = bench_log(spark, sf_dir)
    kinds = {"config": "string", "type": "string", "input_len": "int", "output_len": "int", "concurrency": "int", "runs": "long", "errors": "long"}
    rows = io.bench_rows(lg.bench_summary(log), lg.concurrency_summary(log), 128, 256, 8)
    return _csv(spark, rows, "bench", ", ".join(f"{c} {kinds.get(c, 'double')}" for c in io.BENCH))


def q_stream_turn_log(spark, sf_dir):
    """Conversation turns appended to a JSONL log by a stream."""
    from quarry.plans.streams import _stream

    turns = _stream(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
    path = _folder(spark, "turn-log")
    cs.append_log(turns, path, _folder(spark, "turn-log-state")).awaitTermination()
    got = spark.read.schema("conv_id long, turn int, role string, content string, timestamp string").json(path)
    return got.select("conv_id", "turn", "role", F.sha2("content", 256).alias("content_hash"), F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$").alias("stamped"))


QUERIES = {
    "detailed_csv": q_detailed_csv,
    "stability_csv": q_stability_csv,
    "bench_csv": q_bench_csv,
    "stream_turn_log": q_stream_turn_log,
}

_SHORT = {"extraction": "extraction", "schema_constraint": "schema", "format_following": "format"}
_RATE = {"P": "parsed", "S": "schema_strict_stab", "A": "schema_strict_stab_alias"}
_GROUP_RATES = ", ".join(f"count(*) FILTER (WHERE grp = '{g}' AND {c}) / count(*) FILTER (WHERE grp = '{g}') AS {_SHORT[g]}_{k}" for g in EVAL_GROUPS for k, c in _RATE.items())

ORACLE = {
    "detailed_csv": f"""WITH {ps.EVAL_SQL}
SELECT model, id, grp AS "group", CAST(parsed AS VARCHAR) AS parsed, array_to_string(missing, '; ') AS missing_fields,
  array_to_string(extra, '; ') AS extra_fields, CAST(schema_strict AS VARCHAR) AS schema_strict, CAST(schema_strict_alias AS VARCHAR) AS schema_strict_alias,
  sha256(substr(output, 1, 200)) AS raw_output FROM final""",
    "stability_csv": f"""WITH {ps.EVAL_SQL}, {ps.ROUNDS_SQL}
SELECT model AS round, 'default' AS mode, count(*) AS total, count(*) FILTER (WHERE parsed) / count(*) AS parse_rate,
  count(*) FILTER (WHERE schema_strict_stab) / count(*) AS strict_rate, count(*) FILTER (WHERE schema_strict_stab_alias) / count(*) AS alias_strict_rate,
  {_GROUP_RATES}, coalesce(sum(latency_s), 0.0) / count(*) AS avg_latency_s FROM rounds GROUP BY model""",
    "bench_csv": f"""WITH {BENCH}, r AS (SELECT config, run, max(time_total_s) AS batch_time, count(*) FILTER (WHERE status <> 'ok') AS n_errors FROM bl GROUP BY ALL),
per AS (SELECT config, count(*) AS runs, avg(batch_time) AS a, min(batch_time) AS b, max(batch_time) AS c, CAST(sum(n_errors) AS BIGINT) AS errors FROM r GROUP BY config),
tp AS (SELECT config, avg(v) AS d, min(v) AS e, max(v) AS f FROM (SELECT config, CASE WHEN time_total_s > 0 THEN tp ELSE 0 END AS v FROM ok) AS q GROUP BY config)
SELECT config, 'single' AS type, 128 AS input_len, 256 AS output_len, NULL::INTEGER AS concurrency, time_mean AS time_mean_s, time_min AS time_min_s, time_max AS time_max_s,
  tps_mean AS tok_s_mean, tps_min AS tok_s_min, tps_max AS tok_s_max, ttft_mean AS ttft_mean_s, runs, NULL::BIGINT AS errors FROM bs WHERE status = 'ok'
UNION ALL SELECT per.config, 'multi', 128, 256, 8, a, b, c, d, e, f, NULL, runs, errors FROM per LEFT JOIN tp ON tp.config = per.config""",
    "stream_turn_log": "SELECT conv_id, turn, role, sha256(text) AS content_hash, true AS stamped FROM conversations",
}
