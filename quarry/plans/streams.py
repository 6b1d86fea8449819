"""Streaming queries, run to completion over the given tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quarry.plans.corpus import MAX_LENGTH, MIN_LENGTH, VALID_RATIO
from quarry.plans.logs import TRAIN
from quarry.session import checkpoint_dir
from quarry.sources.adapters import train_log
from quarry.sources.tables import read_table
from quarry.streaming import clean_stream as cs


def _stream(spark, sf_dir, name):
    schema = read_table(spark, sf_dir, name).schema
    # a glob: the file source watches the folder for files matching it
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(sf_dir, f"{name}.parque[t]"))


#: Bytes of values that one file of an arrival should hold.
PART_BYTES = 64 << 20


def _in_files(spark, df, name, order, files):
    """The rows as ``files`` arrivals in ``order`` (a column of their numbers),
    written one after the other; streams read one at a time.  An arrival is one
    parquet file, or as many of about ``PART_BYTES`` as the largest one takes."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    rows = df.drop(order)
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in rows.dtypes), F.lit(0))
    most = df.select(order, width.cast("long").alias("w")).groupBy(order).agg(F.sum("w").alias("w")).agg(F.max("w")).first()[0]
    parts = max(1, -(-(most or 0) // PART_BYTES))
    for k in range(files):
        own = df.filter(F.col(order) == k).drop(order)
        (own.repartition(parts) if parts > 1 else own.coalesce(1)).write.mode("append").parquet(path)
        # parts without rows are not written: empty files make up the number
        for _ in range(parts * (k + 1) - len(spark.read.schema(rows.schema).parquet(path).inputFiles()) if parts > 1 else 0):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", parts).parquet(path)


def _dirty(s):
    """The same dirt as the batch adapter, applied to the stream."""
    i = F.col("doc_id")

    def on(m, v):
        return F.when(i % m == 0, F.lit(v)).otherwise(F.lit(""))

    t = F.when(i % 97 == 0, F.lit("    ")).otherwise(F.col("text"))
    t = F.overlay(t, on(11, "\x01"), F.lit(11), F.lit(0))
    t = F.concat(on(13, "<p>"), t, on(13, "</p>"))
    t = F.concat(t, on(17, "\n\n\n\n  x"))
    return F.concat(on(7, "　\t"), t)


def q_stream_clean(spark, sf_dir):
    s = _stream(spark, sf_dir, "documents")
    s = s.select("doc_id", _dirty(s).alias("text"))
    out = cs.run_to_table(spark, cs.clean_stream(s, min_length=MIN_LENGTH, max_length=MAX_LENGTH, valid_ratio=VALID_RATIO), "stream-clean")
    return out.select("doc_hash", "split", "n_chars")


FILES, HORIZON = 6, "1 hour"


def q_stream_clean_bounded(spark, sf_dir):
    """Cleaning and dedup with bounded state over several micro-batches:
    documents arrive by id, one a minute, every fiftieth two files late."""
    d = read_table(spark, sf_dir, "documents")
    top = d.agg((F.max("doc_id") + 1).alias("n")).scalar()
    late = F.when(F.col("doc_id") % 50 == 0, 2).otherwise(0)
    file = F.least(F.floor(F.col("doc_id") * FILES / top).cast("int") + late, F.lit(FILES - 1))
    rows = d.select("doc_id", _dirty(d).alias("text"), F.timestamp_seconds(F.col("doc_id") * 60).alias("at"), file.alias("file"))
    s = _in_files(spark, rows, "arrivals", "file", FILES)
    out = cs.run_to_table(spark, cs.clean_stream(s, min_length=MIN_LENGTH, max_length=MAX_LENGTH, valid_ratio=VALID_RATIO, watermark_col="at", horizon=HORIZON), "stream-bounded")
    return out.select("doc_hash", "split", "n_chars")


def q_stream_train_summary(spark, sf_dir):
    log = train_log(spark, sf_dir).drop("ts").withColumn("file", (F.col("step") % FILES).cast("int"))
    return cs.stream_train_summary(spark, _in_files(spark, log, "train-log", "file", FILES))


QUERIES = {
    "stream_clean": q_stream_clean,
    "stream_clean_bounded": q_stream_clean_bounded,
    "stream_train_summary": q_stream_train_summary,
}


def _oracle():
    from quarry.plans.corpus import annotated_sql

    return {
        "stream_clean": f"WITH {annotated_sql()} SELECT DISTINCT doc_hash, split, n_chars FROM annotated WHERE drop_reason IS NULL",
        "stream_train_summary": f"""WITH {TRAIN} SELECT run, coalesce(sum(loss * weight) FILTER (WHERE weight > 0) / nullif(sum(weight) FILTER (WHERE weight > 0), 0), 'NaN'::DOUBLE) AS weighted_loss,
  min(step) AS first_step, max(step) AS last_step, arg_min(loss, step) AS first_loss, arg_max(loss, step) AS last_loss, arg_min(val_loss, step) AS first_val_loss,
  arg_max(val_loss, step) AS last_val_loss, min(val_loss) AS best_val_loss, first(step ORDER BY val_loss, step) AS best_step, count(*) AS evals FROM tl GROUP BY run""",
    }


ORACLE = _oracle()
