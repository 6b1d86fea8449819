"""Pre-training corpus preparation (clean -> length filter -> exact dedup ->
hash split -> stats) as one narrow projection plus one skew-safe aggregate.

``annotate_corpus`` keeps *every* input row and explains its fate in
``drop_reason`` (null = kept so far), so all counters come from a single
aggregate over one annotated frame instead of per-step rescans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.draw import hash_split
from quarry.functions.text import (
    compress_whitespace,
    py_strip,
    remove_control_chars,
    remove_html_tags,
    replace_literals,
)


def clean_text(df: DataFrame, col: str = "text", rules=(), html: bool = False) -> DataFrame:
    """Cleaning chain in fixed order; each step yields a 'modified' flag.

    strip -> empty? -> literal rules -> control chars (flag by length) ->
    HTML tags (opt-in, flag by length) -> whitespace (flag by inequality) ->
    strip -> empty?
    """
    nonempty = F.length("_s0") > 0
    out = (
        df.withColumn("_s0", py_strip(F.col(col)))
        .withColumn("_s1", replace_literals("_s0", rules))
        .withColumn("_s2", remove_control_chars("_s1"))
        .withColumn("ctrl_mod", (F.length("_s2") != F.length("_s1")) & nonempty)
    )
    if html:
        out = out.withColumn("_s3", remove_html_tags("_s2")).withColumn(
            "html_mod", (F.length("_s3") != F.length("_s2")) & nonempty
        )
    else:
        out = out.withColumn("_s3", F.col("_s2")).withColumn("html_mod", F.lit(False))
    out = (
        out.withColumn("_s4", compress_whitespace("_s3"))
        .withColumn("ws_mod", (F.col("_s4") != F.col("_s3")) & nonempty)
        .withColumn("text_clean", F.when(nonempty, py_strip("_s4")).otherwise(F.lit("")))
        .drop("_s0", "_s1", "_s2", "_s3", "_s4")
    )
    return out


def length_reason(text_col: str, min_length: int = 50, max_length: int = 0, action: str = "drop"):
    """First failing length rule: 'empty' | 'short' | 'long' (drop mode) | null."""
    if action not in ("drop", "truncate"):
        raise ValueError("action must be 'drop' or 'truncate'")
    n = F.length(text_col)
    r = F.when(n == 0, F.lit("empty"))
    if min_length > 0:
        r = r.when(n < min_length, F.lit("short"))
    if max_length > 0 and action == "drop":
        r = r.when(n > max_length, F.lit("long"))
    return r


def annotate_corpus(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules=(),
    html: bool = False,
    min_length: int = 50,
    max_length: int = 0,
    action: str = "drop",
    valid_ratio: float = 0.01,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per input row: cleaned text, flags, drop reason, sha256 and split, and
    the columns ``keep``.

    Narrow (no shuffle); all columns derive from one row.
    """
    c = clean_text(df.select(id_col, *keep, text_col), text_col, rules, html)
    c = c.withColumn("drop_reason", length_reason("text_clean", min_length, max_length, action))
    if max_length > 0 and action == "truncate":
        c = c.withColumn(
            "text_clean",
            F.when(F.length("text_clean") > max_length, F.substring("text_clean", 1, max_length)).otherwise(
                F.col("text_clean")
            ),
        )
    kept = F.col("drop_reason").isNull()
    return (
        c.withColumn("n_chars", F.length("text_clean"))
        .withColumn("doc_hash", F.when(kept, F.sha2("text_clean", 256)))
        .withColumn("split", F.when(kept, hash_split("text_clean", valid_ratio)))
        .select(id_col, *keep, "text_clean", "n_chars", "drop_reason", "ctrl_mod", "html_mod", "ws_mod", "doc_hash", "split")
    )


def dedup_exact(annotated: DataFrame, id_col: str = "doc_id", dedup: bool = True) -> DataFrame:
    """Kept rows as ``(id, doc_hash, split, n_chars)``: keep-first exact dedup
    on the cleaned text's SHA-256.

    No text enters the aggregate: the smallest id of a hash stands for the
    text, and length and split are the same for equal texts.  All buffers are
    fixed-width, so this is a hash aggregate with a map-side combine, and a hot
    hash reaches the shuffle as one small row per map task.  Text sinks join
    the text back with :func:`with_text`.

    Rows dropped earlier have a null hash and fall into one group, removed by a
    filter on the aggregate's *output*: a filter on an input column would be
    pushed below the projections, and the cleaning chain would run twice.
    """
    kept = F.col("drop_reason").isNull()
    if not dedup:
        return annotated.filter(kept).select(id_col, "doc_hash", "split", "n_chars")
    first = annotated.groupBy("doc_hash").agg(
        F.min(F.when(kept, F.col(id_col))).alias(id_col),
        F.max(F.col("split") == "valid").alias("_valid"),
        F.max(F.when(kept, F.col("n_chars"))).alias("n_chars"),
    )
    split = F.when(F.col("_valid"), F.lit("valid")).otherwise(F.lit("train")).alias("split")
    return first.filter(F.col("n_chars").isNotNull()).select(id_col, "doc_hash", split, "n_chars")


def with_text(kept: DataFrame, annotated: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Kept rows with their cleaned text, for sinks that need it: one join on
    the id (and the hash, as ids may repeat); both sides are split when skewed."""
    return kept.join(annotated.select(id_col, "doc_hash", "text_clean"), [id_col, "doc_hash"])


def split_stats(kept: DataFrame) -> DataFrame:
    """Per split: documents, characters, mean length."""
    return kept.groupBy("split").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_chars").cast("bigint").alias("characters"),
        (F.sum("n_chars") / F.count(F.lit(1))).alias("avg_doc_length"),
    )


def clean_report(annotated: DataFrame, dedup: bool = True) -> DataFrame:
    """Step counters in one row from a single aggregate over the annotated frame.

    Duplicates = rows that passed the length rules minus distinct hashes among
    them (exact, and equal to what the keep-first dedup removes).
    """
    passed = F.col("drop_reason").isNull()
    dups = (F.count_if(passed) - F.count_distinct("doc_hash")) if dedup else F.lit(0)
    return (
        annotated.agg(
            F.count(F.lit(1)).alias("total_raw_documents"),
            F.count_if(F.col("drop_reason") == "empty").alias("skipped_empty"),
            F.count_if(F.col("drop_reason") == "short").alias("skipped_short"),
            F.count_if(F.col("drop_reason") == "long").alias("skipped_long"),
            F.count_if("html_mod").alias("cleaned_html"),
            F.count_if("ctrl_mod").alias("cleaned_control_chars"),
            F.count_if("ws_mod").alias("compressed_whitespace"),
            dups.cast("bigint").alias("duplicates_removed"),
            F.count_if(passed).alias("_passed"),
        )
        .withColumn("total_kept", F.col("_passed") - F.col("duplicates_removed"))
        .withColumn(
            "filter_rate",
            F.when(F.col("total_raw_documents") > 0, 1 - F.col("total_kept") / F.col("total_raw_documents")).otherwise(
                F.lit(0.0)
            ),
        )
        .drop("_passed")
    )
