from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import quality_rules, secret_scan
from quarry.llm.secret_scan import encoding, masked, ranks, spans

from .helpers import clashing, classes, edge_docs, phrase_hits, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SMALL = "/root/testdata/sf0.001"


def plain_run(spark, sf_dir):
    """The stages one after the other, by plain code but for the rules, which
    their own tests hold against plain code."""
    rows = [(r.doc_id, r.text) for r in quality_rules.judged(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("kept").collect()]
    prints = [(i, simhash(t)) for i, t in rows]
    least = classes(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    rows = [r for r, c in zip(rows, least, strict=True) if r[0] == c]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, (n, hit, _) in zip(rows, phrase_hits(rows, items), strict=True) if not (hit and 20 * hit >= n)]
    enc = encoding(P.PATTERN, ranks(P.path("byte_bpe_50k.tiktoken")))
    rows = [(i, masked(t, spans(t, enc), "[secret]")) for i, t in rows]
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return Counter((i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows)


def test_run_equals_plain_stages(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == plain_run(spark, SMALL)
    assert all(len(r.token_ids) == 4 * r.n_tokens for r in got)


def test_stages_keep_columns_and_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
            assert {(r.doc_id, r.lang) for r in rows} <= {(r.doc_id, r.lang) for r in docs.collect()}
            assert all(r.n_words == "mine" for r in rows)


def test_near_dedup_keeps_one_of_each_group(spark):
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).where("doc_id is not null").collect()]
    want = classes([(i, simhash(t)) for i, t in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    got = corpus_pipeline.near_dedup(spark, edge_docs(spark).where("doc_id is not null"), SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({r for r, c in zip(rows, want, strict=True) if r[0] in set(want)} & {r for r in rows if r[0] in set(want)})


def test_secrets_are_masked(spark):
    rows = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.secrets(spark, edge_docs(spark).withColumn("n_chars", F.lit(-1).cast("long")), SMALL).collect()]
    assert any("[secret]" in (t or "") for _, t, _ in rows)
    assert all(n == (len(t) if t is not None else -1) for _, t, n in rows)
    assert not any(secret_scan.ACCESS.search(t or "") for _, t, _ in rows)
