"""File-to-file jobs matching the reference's command-line steps (input
files in, output files and a metadata report out), built from the operators.
Everything between read and write stays distributed; only small aggregates
are collected for the metadata document."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import bpe
from quarry.operators.clean import annotate_corpus, clean_report, dedup_exact, split_stats, with_text
from quarry.operators.stats import length_stats
from quarry.session import ship_package
from quarry.sources import io


def prepare_corpus(spark: SparkSession, input_path: str, output_dir: str, text_key: str = "text", valid_ratio: float = 0.01,
                   separator: str = "###", replace: tuple = (), min_length: int = 50, max_length: int = 0,
                   max_length_action: str = "drop", clean_html: bool = False, dedup: bool = True) -> dict:
    """JSONL corpus -> cleaned, filtered, deduplicated, hash-split text files
    (``train``/``valid`` with separator lines, ``tokenizer_corpus`` without)
    plus ``metadata.json``.  Returns the metadata dict."""
    ship_package(spark)
    from quarry.functions.text import parse_replacement_rules

    rules = parse_replacement_rules(list(replace))
    raw = io.read_text_records(spark, input_path, text_key).withColumnRenamed("line_id", "doc_id")
    ann = annotate_corpus(raw.withColumnRenamed(text_key, "text"), rules=rules, html=clean_html, min_length=min_length,
                          max_length=max_length, action=max_length_action, valid_ratio=valid_ratio)
    from quarry.session import cut_lineage

    ann = cut_lineage(ann)  # feeds the outputs and three reports
    kept = cut_lineage(dedup_exact(ann, dedup=dedup))  # ids, lengths and splits only
    texts = with_text(kept, ann)
    io.write_splits(texts, os.path.join(output_dir, "splits"), separator)
    io.write_corpus(texts, os.path.join(output_dir, "tokenizer_corpus"))
    report = clean_report(ann, dedup).collect()[0].asDict()
    lengths = length_stats(kept, "n_chars").collect()[0].asDict()
    per_split = {r["split"]: r.asDict() for r in split_stats(kept).collect()}
    meta = {
        "source_path": input_path, "text_key": text_key, "document_separator": separator, "valid_ratio": valid_ratio,
        "replacement_rules": [{"old": o, "new": n} for o, n in rules],
        "cleaning_config": {"min_length": min_length, "max_length": max_length, "max_length_action": max_length_action,
                            "clean_html": clean_html, "dedup_enabled": dedup},
        "filter_stats": {**report, "filter_rate": f"{report['filter_rate'] * 100:.2f}%"},
        "length_stats": lengths if lengths.get("count") else {"count": 0},
        "train": per_split.get("train", {}), "valid": per_split.get("valid", {}),
        "tokenizer_corpus": {"documents": report["total_kept"]},
    }
    spark.createDataFrame([(json.dumps(meta, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite").text(os.path.join(output_dir, "metadata"))
    return meta


def train_tokenizer(spark: SparkSession, corpus: DataFrame, output_dir: str, vocab_size: int, specials=(), text: str = "text"):
    """Corpus text column -> BPE vocabulary and merges files; returns them."""
    ship_package(spark)
    counts = bpe.pretoken_counts(corpus, text, specials)
    vocab, merges = bpe.train_bpe(counts, vocab_size, specials)
    io.write_vocab(bpe.vocab_frame(spark, vocab, specials), bpe.merges_frame(spark, merges), output_dir)
    return vocab, merges


def tokenize_corpus(spark: SparkSession, docs: DataFrame, output_dir: str, vocab: dict, merges: list, specials=(),
                    text: str = "text") -> dict:
    """Documents -> token ids parquet (one encode pass) + metadata."""
    ship_package(spark)
    enc = docs.withColumn("ids", bpe.encode_column(spark, F.col(text), vocab, merges, specials)).drop(text)
    meta = io.write_tokens(enc, output_dir, len(vocab)).collect()[0].asDict()
    return meta


def score_outputs(spark: SparkSession, outputs: DataFrame, prompts: DataFrame, output_dir: str, aliases: dict | None = None) -> None:
    """Model outputs ⋈ prompt specs -> scored rows (JSON) and by-model,
    by-group and leaderboard summaries (JSON)."""
    ship_package(spark)
    from quarry.operators import scoring as sc

    prompts = sc.with_gold(prompts) if "gold_output" in prompts.columns else prompts
    scored = sc.score(outputs.join(prompts, "id"), aliases=aliases)
    from quarry.session import cut_lineage

    scored = cut_lineage(scored)
    io.write_jsonl(scored, os.path.join(output_dir, "scored"))
    bm = sc.by_model(scored)
    io.write_jsonl(bm, os.path.join(output_dir, "by_model"))
    io.write_jsonl(sc.by_group(scored), os.path.join(output_dir, "by_group"))
    order = [r["model"] for r in scored.groupBy("model").agg(F.min("model_ord").alias("o")).orderBy("o").collect()] \
        if "model_ord" in scored.columns else sorted(r["model"] for r in bm.select("model").collect())
    io.write_jsonl(sc.leaderboard(bm, order), os.path.join(output_dir, "leaderboard"))
