"""Structured Streaming versions of the incremental behaviours.

* :func:`clean_stream` -- line/document stream -> cleaning chain, length
  rules, hash split (all stateless) -> exact dedup on the text hash.  The state
  holds hashes only, partitioned by hash; texts are never in it.  With an
  ingest-time column, ``dropDuplicatesWithinWatermark`` keeps a hash with its
  expiry and forgets it beyond the horizon, so the state stays as large as one
  horizon's distinct texts; repeats beyond it get through, and rows older than
  the watermark are dropped as late.
* :func:`stream_train_summary` -- an append-only training log read as a
  stream; every micro-batch merges its own summary with the one before it.

Sinks and checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.clean import annotate_corpus
from quarry.session import checkpoint_dir


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def clean_stream(stream: DataFrame, rules=(), html: bool = True, min_length: int = 50, max_length: int = 0,
                 valid_ratio: float = 0.01, watermark_col: str | None = None, horizon: str = "1 day") -> DataFrame:
    """Streaming clean + dedup (first arrival of each text hash wins)."""
    keep = (watermark_col,) if watermark_col else ()
    a = annotate_corpus(stream, rules=rules, html=html, min_length=min_length, max_length=max_length, valid_ratio=valid_ratio, keep=keep)
    # Dropped rows go before the key, so they neither meet in one state task
    # nor take state.  They leave through a generator: a plain filter would be
    # pushed below the cleaning chain and run it a second time.
    kept = F.filter(F.array(F.struct("drop_reason", "doc_hash", "split", "n_chars", "text_clean", *keep)), lambda r: r["drop_reason"].isNull())
    a = a.select(F.inline(kept)).drop("drop_reason")
    if watermark_col:
        a = a.withWatermark(watermark_col, horizon).dropDuplicatesWithinWatermark(["doc_hash"])
    else:
        a = a.dropDuplicates(["doc_hash"])
    return a.select("doc_hash", "split", "n_chars", "text_clean")


def run_to_table(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet", progress: list | None = None) -> DataFrame:
    """Run a streaming frame over all available input (``availableNow``) into
    a file sink under the shared checkpoint folder; return the batch read of
    the sink.  ``progress`` receives the reports of the micro-batches."""
    out, ck = _scratch(spark, name), _scratch(spark, name + "-ckpt")
    q = df.writeStream.format(fmt).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start(out)
    q.awaitTermination()
    if progress is not None:
        progress.extend(q.recentProgress)
    return spark.read.format(fmt).load(out)


#: A running summary of one run: sums, and the extreme rows as structs.
SUMMARY = ("run", "wsum", "wtot", "first", "last", "best", "evals")


def batch_summary(log: DataFrame) -> DataFrame:
    """The summary of some rows of a training log (run, step, loss, val_loss, weight)."""
    w = F.col("weight")
    row = F.struct("step", "loss", "val_loss")
    return log.groupBy("run").agg(
        F.sum(F.when(w > 0, F.col("loss") * w)).alias("wsum"), F.sum(F.when(w > 0, w)).alias("wtot"), F.min(row).alias("first"), F.max(row).alias("last"),
        F.min(F.when(F.col("val_loss").isNotNull(), F.struct("val_loss", "step"))).alias("best"), F.count(F.lit(1)).alias("evals"))


def merged_summary(parts: DataFrame) -> DataFrame:
    """Summaries of disjoint rows as one."""
    return parts.groupBy("run").agg(
        F.sum("wsum").alias("wsum"), F.sum("wtot").alias("wtot"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("best").alias("best"), F.sum("evals").alias("evals"))


def merge_batch(spark: SparkSession, batch: DataFrame, epoch: int, folder: str) -> None:
    """Write the summary after micro-batch ``epoch``: the one after the batch
    before it, merged with this batch.  It is a table of its own, so a batch
    that runs again writes the same; older ones are removed, but the one that a
    repeated batch needs."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = batch_summary(batch)
    if fs.exists(fs_path(f"{folder}/{epoch - 1}/_SUCCESS")):
        now = merged_summary(now.union(spark.read.parquet(f"{folder}/{epoch - 1}")))
    now.write.mode("overwrite").parquet(f"{folder}/{epoch}")
    fs.delete(fs_path(f"{folder}/{epoch - 2}"), True)


def latest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The running summary as of the last finished micro-batch: weighted loss,
    first and last step with their losses, best validation loss and its step."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName()) for s in fs.listStatus(fs_path(folder)) if fs.exists(fs_path(s.getPath(), "_SUCCESS"))]
    r = spark.read.parquet(f"{folder}/{max(done)}")
    loss = F.coalesce(F.col("wsum") / F.nullif("wtot", F.lit(0)), F.lit(float("nan")))
    return r.select(
        "run", loss.alias("weighted_loss"), *[F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in ("step", "loss", "val_loss")],
        F.col("best.val_loss").alias("best_val_loss"), F.col("best.step").alias("best_step"), "evals")


def stream_train_summary(spark: SparkSession, log_stream: DataFrame, name: str = "train-summary") -> DataFrame:
    """Running per-run summary of a streaming training log.  A micro-batch
    leaves only its small summary, never log rows; see :func:`merge_batch`."""
    out, ck = _scratch(spark, name), _scratch(spark, name + "-ckpt")
    q = log_stream.writeStream.foreachBatch(lambda batch, epoch: merge_batch(batch.sparkSession, batch, epoch, out)).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    return latest_summary(spark, out)


def iso_now():
    """The current UTC time in ISO 8601 with microseconds."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def append_log(stream: DataFrame, path: str, checkpoint: str, stamp: str = "timestamp"):
    """Append-only JSONL log sink (chat turns, training records): every
    micro-batch of what is there is appended with its UTC time; returns the
    started query.  The file sink's own log makes a replayed batch count once."""
    return (stream.withColumn(stamp, iso_now()).writeStream.format("json").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
