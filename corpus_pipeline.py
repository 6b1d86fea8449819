"""Corpus pipeline: quality rules, SimHash near-dedup, benchmark
decontamination, secret redaction, BPE coding.

Each stage takes ``(spark, docs, sf_dir)``; ``docs`` is what the stage before
it kept, written as Parquet and read again.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import phrase_index, quality_rules, secret_scan, simhash, word_bpe
from quarry.llm.queries import bpe_digests, table
from quarry.session import checkpoint_dir, ship_package

#: The contract of the near-duplicate stage.
SHINGLE_WORDS, MAX_BITS = 4, 4


def carried(docs: DataFrame) -> DataFrame:
    """Whole rows beside their text, so no column can clash with a measure."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no base or table rule rejects."""
    return quality_rules.judged(carried(docs)).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component.  Rows with
    equal id and text stay once; rows that share an id but not the text stay
    each if the id leads a component; rows without an id all stay."""
    ship_package(spark)
    found = simhash.near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)
    leaders = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id")
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("digest"))
    kept = rows.join(leaders, "doc_id", "left_semi").dropDuplicates(["doc_id", "digest"])
    return kept.select("row.*").union(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark phrases cover less than a twentieth."""
    found = phrase_index.find(carried(docs), table(spark, sf_dir, "benchmark"), keep=("row",))
    return found.where(~phrase_index.contaminated(phrase_index.n_hit(), F.col("n_words"))).select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked and ``n_chars`` counted anew."""
    ship_package(spark)
    masked = secret_scan.redact(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    if "n_chars" not in docs.columns:
        return masked
    count = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", count)


def coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (binary, little-endian unsigned 32-bit
    integers), their number, and digests of the ids and of the decoded text."""
    ship_package(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = word_bpe.decode(word_bpe.encode(docs, path), path)
    return bpe_digests(coded.withColumn("token_ids", F.col("ids")))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("BPE encoding and decoding", coding),
]

#: SQL has no XXH64 and no BPE; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps goes through Parquet in
    the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
