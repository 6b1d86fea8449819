"""Invariants: results do not depend on partitioning or input order, and
counts are conserved."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMOKE
from quarry.operators.clean import annotate_corpus, clean_report, dedup_exact
from quarry.operators.sample import TASK_RATIO, task_targets
from quarry.plans import derive as pd_
from quarry.plans.corpus import MAX_LENGTH, MIN_LENGTH, VALID_RATIO
from quarry.sources.adapters import dirty_docs


def _kept(df):
    a = annotate_corpus(df, html=True, min_length=MIN_LENGTH, max_length=MAX_LENGTH, valid_ratio=VALID_RATIO)
    return sorted(tuple(r) for r in dedup_exact(a).select("doc_id", "doc_hash", "split").collect()), a


def test_dedup_and_split_are_partition_invariant(spark):
    base = dirty_docs(spark, SMOKE)
    ref, _ = _kept(base.repartition(1))
    for n in (4, 16):
        got, _ = _kept(base.repartition(n))
        assert got == ref
    shuffled, _ = _kept(base.orderBy(F.sha1(F.col("doc_id").cast("string"))).repartition(7))
    assert shuffled == ref


def test_corpus_counts_conserve(spark):
    _, ann = _kept(dirty_docs(spark, SMOKE))
    r = clean_report(ann).collect()[0]
    total = r["skipped_empty"] + r["skipped_short"] + r["skipped_long"] + r["duplicates_removed"] + r["total_kept"]
    assert total == r["total_raw_documents"]
    kept = dedup_exact(ann)
    assert kept.count() == r["total_kept"]
    assert kept.select("doc_hash").distinct().count() == r["total_kept"]  # no duplicate text survives


def test_ie_reasons_conserve(spark):
    q = entry.queries()
    reasons = q["ie_reason_counts"](spark, SMOKE).collect()
    train = q["ie_filter"](spark, SMOKE).count()
    assert sum(r["count"] for r in reasons) == train


def test_sample_targets_and_splits(spark):
    s = pd_.sampled(spark, SMOKE)
    per_task = {r["task_type"]: r["n"] for r in s.groupBy("task_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    targets = task_targets(pd_.SAMPLE_TARGET, TASK_RATIO)
    assert all(per_task[t] <= targets[t] for t in per_task)
    assert s.select("original_id", "task_type").distinct().count() == s.count()  # no sample drawn twice
    c = pd_.chat(spark, SMOKE)
    ids = c.select("id", "split")
    assert ids.select("id").distinct().count() == ids.count()  # ids unique, so splits are disjoint
    n = ids.count()
    assert ids.filter(F.col("split") == "train").count() == int(n * (1 - 0.05))
