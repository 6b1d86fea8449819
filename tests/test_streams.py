"""Streams over several micro-batches: bounded dedup state, replayed batches."""

import hashlib
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from conftest import SMOKE
from quarry.operators import logs as lg
from quarry.plans.streams import _in_files
from quarry.sources.adapters import train_log
from quarry.streaming import clean_stream as cs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def arrivals(spark, batches):
    """(minute, text) rows of each micro-batch."""
    rows = [(k * 1000 + i, text, START + timedelta(minutes=m), k) for k, batch in enumerate(batches) for i, (m, text) in enumerate(batch)]
    df = spark.createDataFrame(rows, "doc_id long, text string, at timestamp, file int")
    return _in_files(spark, df, "arrivals-test", "file", len(batches))


def run(spark, batches, horizon="30 minutes"):
    reports: list = []
    s = cs.clean_stream(arrivals(spark, batches), min_length=5, watermark_col="at", horizon=horizon)
    out = cs.run_to_table(spark, s, "bounded-test", progress=reports)
    return sorted(r["text_clean"] for r in out.collect()), [r["stateOperators"][0] for r in reports if r["stateOperators"]]


def test_repeats_late_rows_and_expiry(spark):
    # a batch drops rows older than the watermark before it, and forgets at its end what expired by then
    batches = [
        [(0, "first text"), (1, "first text"), (2, "second text"), (3, "tiny")],
        [(10, "first text"), (60, "third text")],  # moves the watermark to minute 30
        [(61, "third text"), (62, "first text")],  # both known; the first text expires with this batch
        [(20, "late text"), (200, "fourth text"), (63, "first text")],  # minute 20 is late; the first text comes again
        [(201, "third text"), (10, "late too")],
        [(202, "third text")],
    ]
    got, state = run(spark, batches)
    assert got == sorted(["first text", "second text", "third text", "first text", "fourth text", "third text"])
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 2
    assert state[-1]["numRowsTotal"] <= 2  # the rest has expired


def test_state_stays_bounded_and_holds_kept_rows_only(spark):
    batches = [[(k * 100 + i, f"text number {k * 40 + i}") for i in range(40)] + [(k * 100, "x")] * 200 for k in range(6)]
    got, state = run(spark, batches)
    assert len(got) == 240
    assert max(s["numRowsTotal"] for s in state) <= 80  # two batches' texts, never the 1,200 dropped rows
    assert max(s["numRowsUpdated"] for s in state) <= 40


def test_stream_equals_batch_dedup_without_watermark(spark):
    batches = [[(i, f"same text {i % 7}") for i in range(30)], [(i, f"same text {i % 11}") for i in range(30)]]
    out = cs.run_to_table(spark, cs.clean_stream(arrivals(spark, batches), min_length=5), "unbounded-test")
    rows = out.collect()
    assert {r["doc_hash"] for r in rows} == {hashlib.sha256(f"same text {i}".encode()).hexdigest() for i in range(11)} and len(rows) == 11


def test_a_repeated_batch_gives_the_same_summary(spark, tmp_path):
    log = train_log(spark, SMOKE).drop("ts")
    parts = [log.filter(F.col("step") % 3 == k) for k in range(3)]
    folder = str(tmp_path / "summary")
    for epoch in (0, 1, 1, 1, 2, 2):  # a batch runs again after a failure
        cs.merge_batch(spark, parts[epoch], epoch, folder)
    got = {r["run"]: r for r in cs.latest_summary(spark, folder).collect()}
    want = {r["run"]: r for r in lg.log_summary(log).join(lg.weighted_loss(log), "run").collect()}
    assert got.keys() == want.keys()
    for run_, r in got.items():
        for c in ("first_step", "last_step", "first_loss", "last_loss", "first_val_loss", "last_val_loss", "best_val_loss", "best_step", "evals"):
            assert r[c] == want[run_][c], c
        assert abs(r["weighted_loss"] - want[run_]["weighted_loss"]) < 1e-9


def test_summary_without_weights_or_validation(spark, tmp_path):
    log = spark.createDataFrame([("r", 3, 1.0, None, 0), ("r", 1, 2.0, None, 0)], "run string, step long, loss double, val_loss double, weight long")
    cs.merge_batch(spark, log, 0, str(tmp_path / "s"))
    r = cs.latest_summary(spark, str(tmp_path / "s")).first()
    assert (r["first_step"], r["last_step"], r["best_step"], r["best_val_loss"], r["evals"]) == (1, 3, None, None, 2) and r["weighted_loss"] != r["weighted_loss"]


def test_arrivals_of_several_files(spark, monkeypatch):
    from quarry.plans import streams

    monkeypatch.setattr(streams, "PART_BYTES", 400)
    batches = [[(k * 100 + i, f"text number {i % 20} of {'many' if k else 'some'}") for i in range(40)] for k in range(3)] + [[], [(400, "one more text")]]
    s = arrivals(spark, batches)
    reports: list = []
    out = cs.run_to_table(spark, cs.clean_stream(s, min_length=5), "several-test", progress=reports)
    assert out.count() == 41
    assert [r["numInputRows"] for r in reports if r["numInputRows"]] == [40, 40, 40, 1]
