"""The instruction-extraction pipeline as a file-to-file job: raw JSONL splits
and a topic schema in, chat JSONL, step reports, metadata and a Markdown data
report out.

Every step writes its rows and the next one reads them back, so no step is
computed twice and a lost executor costs at most one step.  Only aggregates of
one row for each topic, task, tier or reason reach the driver, for the reports.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import derive as dv
from quarry.operators import ie
from quarry.operators import sample as sp
from quarry.operators.stats import distribution
from quarry.session import ship_package
from quarry.sources import io

RAW = ("id string, cate string, text string, input string, "
       "relation array<struct<head:string,relation:string,tail:string,head_type:string,tail_type:string>>")


def _stage(df: DataFrame, path: str) -> DataFrame:
    """Write one step as JSONL and read it back with its schema."""
    io.write_jsonl(df, path)
    return df.sparkSession.read.schema(df.schema).json(path)


def _counts(df: DataFrame, *by: str) -> dict:
    """Counts of a column (or of nested ones) as a dictionary in falling order."""
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *by).collect()
    out: dict = {}
    for r in rows:
        at = out
        for c in by[:-1]:
            at = at.setdefault(r[c], {})
        at[r[by[-1]]] = r["n"]
    return out


def _save(spark: SparkSession, path: str, text: str) -> None:
    """One small text file through Spark's writer, so any store will do."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _report(spark: SparkSession, out: str, name: str, report: dict) -> dict:
    _save(spark, os.path.join(out, "reports", name), json.dumps(report, ensure_ascii=False, indent=2, default=str))
    return report


def reason_counts(annotated: DataFrame, compat: bool = False) -> dict:
    """Rows for each reject reason, hard and soft apart.  ``compat`` counts a
    leak twice, as the published figures do."""
    counts = _counts(annotated.filter(F.col("reject_reason").isNotNull()), "reject_reason")
    if compat and "leak_with_valid_test" in counts:
        counts["leak_with_valid_test"] *= 2
    soft = {k: n for k, n in counts.items() if k.startswith("soft_")}
    return {"hard": {k: n for k, n in counts.items() if k not in soft}, "soft": soft}


def run(spark: SparkSession, train: str, valid: str, test: str, schema: str, out: str, target: int = sp.CANDIDATE_TARGET,
        limits: dict | None = None, quality: dict | None = None, cate_map: dict | None = None, seed: int = sp.SEED,
        source_name: str = "records", compat: bool = False) -> dict:
    """Normalize, filter, tier, derive, sample and format; returns the metadata."""
    ship_package(spark)
    cate_map = ie.CATE_MAP if cate_map is None else cate_map

    # 1. normalize
    sets = {}
    for name, path in (("train", train), ("valid", valid), ("test", test)):
        sets[name] = _stage(ie.normalize_ie(io.read_jsonl(spark, path, RAW), name, cate_map), os.path.join(out, "normalized", name))
    n_raw = {name: d.count() for name, d in sets.items()}
    _report(spark, out, "01_normalize", {"step": "normalize", "counts": n_raw, "topics": {k: _counts(d, "cate") for k, d in sets.items()}})

    # 2. filter
    marked = _stage(ie.apply_filters(sets["train"], sets["valid"], sets["test"], limits=limits, compat=compat), os.path.join(out, "filtered"))
    reasons = reason_counts(marked, compat)
    kept = marked.filter(F.col("reject_reason").isNull())
    topics, n_soft = _counts(kept, "cate"), kept.count()
    n_hard = n_soft + sum(reasons["soft"].values())
    quantiles: dict = {}
    for r in ie.topic_quantiles(sets["train"]).collect():  # topics x four measures
        quantiles.setdefault(r["cate"], {})[r["measure"]] = {k: v for k, v in r.asDict().items() if k.startswith("P")}
    _report(spark, out, "02_filter", {
        "step": "filter", "input_count": n_raw["train"], "after_hard_filter": n_hard, "after_soft_filter": n_soft,
        "hard_filter_reasons": reasons["hard"], "soft_filter_reasons": reasons["soft"], "per_topic_quantiles": quantiles,
        "filtered_topic_dist": topics})

    # 3. tier
    tiered = _stage(ie.with_quality_tier(kept.drop("reject_reason", "leaked"), quality), os.path.join(out, "tiered"))
    _report(spark, out, "03_quality", {"step": "quality_tier", **ie.tier_report(tiered).first().asDict(), "by_topic": _counts(tiered, "cate", "quality_tier")})

    # 4. derive
    fields = io.read_topic_schema(spark, schema)
    tasks = _stage(dv.derive_tasks(tiered, fields, cate_map, seed=seed), os.path.join(out, "tasks"))
    per_task = _counts(tasks, "task_type")
    skipped = {r["cate"]: r["no_schema"] for r in dv.schema_skips(tiered, fields, cate_map).filter("no_schema > 0").collect()}
    _report(spark, out, "04_derive", {"step": "derive_tasks", "tasks": per_task, "no_schema": skipped, "kinds": _counts(tasks.filter("perturbation_kind is not null"), "perturbation_kind")})

    # 5. sample
    sampled = _stage(sp.index_sample(sp.priority_sample(tasks, target=target, seed=seed), "idx"), os.path.join(out, "sampled"))
    n_sampled = sampled.count()
    _report(spark, out, "05_sample", {"step": "stratified_sample", "sampled": n_sampled, "tasks": _counts(sampled, "task_type"), "topics": _counts(sampled, "cate"), "tiers": _counts(sampled, "quality_tier")})

    # 6. chat records
    chat = _stage(sp.exact_split(sp.to_chat(sampled), F.col("id"), sp.INTERNAL_VALID_RATIO, seed), os.path.join(out, "chat"))
    train_set, valid_set = (chat.filter(F.col("split") == s).drop("split") for s in ("train", "valid"))
    for name, d in (("train", train_set), ("valid", valid_set)):
        io.write_jsonl(d, os.path.join(out, "final", name))
    sizes = _counts(chat, "split")
    meta = {
        "version": "1.0", "source": source_name, "train_samples": sizes.get("train", 0), "valid_samples": sizes.get("valid", 0),
        "task_types": list(sp.TASK_RATIO), "task_ratio": sp.TASK_RATIO, "topic_schemas": sorted(_counts(train_set, "topic_schema")),
        "format": "chat-style JSONL with messages field", "original_data_size": n_raw["train"],
        "pipeline_steps": ["normalize", "hard_filter", "soft_filter", "quality_tier", "derive_tasks", "stratified_sample"],
    }
    _report(spark, out, "metadata", meta)
    steps = [("raw train", n_raw["train"]), ("after hard filter", n_hard), ("after soft filter", n_soft), ("derived tasks", sum(per_task.values())),
             ("sampled", n_sampled), ("final train", meta["train_samples"]), ("final valid", meta["valid_samples"])]
    _save(spark, os.path.join(out, "reports", "data_report"), markdown_report(steps, chat, train_set, reasons))
    return meta


def markdown_report(steps: list, chat: DataFrame, train: DataFrame, reasons: dict) -> str:
    """The data report: steps, task shares against their targets, topics,
    tiers and reject reasons, all from small aggregates."""
    def table(df, by, label):
        rows = distribution(df, by).orderBy(F.desc("count"), by).collect()
        return io.markdown_table([{label: r[by], "count": r["count"], "share": f"{r['share'] * 100:.1f}%"} for r in rows], [label, "count", "share"])

    shares = {r["task_type"]: r for r in distribution(chat, "task_type").collect()}
    tasks = [{"task": t, "count": shares[t]["count"] if t in shares else 0, "share": f"{shares[t]['share'] * 100:.1f}%" if t in shares else "0.0%", "target": f"{r * 100:.0f}%"}
             for t, r in sp.TASK_RATIO.items()]
    why = [{"filter": kind, "reason": k, "count": n} for kind in ("hard", "soft") for k, n in reasons[kind].items()]
    parts = [
        "# Data report", "## Steps", io.markdown_table([{"step": a, "samples": f"{n:,}"} for a, n in steps], ["step", "samples"]),
        "## Tasks", io.markdown_table(tasks, ["task", "count", "share", "target"]),
        "## Topics (train)", table(train, "topic_schema", "topic"), "## Quality (train)", table(train, "quality_tier", "tier"),
        "## Rejected", io.markdown_table(why, ["filter", "reason", "count"]),
    ]
    return "\n\n".join(parts) + "\n"
