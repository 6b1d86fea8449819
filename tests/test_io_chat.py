import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import chat as ch
from quarry.operators import sft
from quarry.sources import io


def _tmp():
    return tempfile.mkdtemp(prefix="quarry-test-")


def test_jsonl_strict_and_tolerant(spark):
    d = _tmp()
    p = os.path.join(d, "in.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"text": "中文 ok"}\n\n{"text": 5}\nnot json\n{"other": "x"}\n')
    tol = io.read_text_records(spark, p).collect()
    assert [r["text"] for r in tol] == ["中文 ok"]  # bad JSON and non-string text dropped
    with pytest.raises(Exception):
        io.read_jsonl(spark, p, "text string", strict=True).collect()
    ok = os.path.join(d, "ok.jsonl")
    with open(ok, "w", encoding="utf-8") as f:
        f.write('{"text": "a"}\n\n{"text": "b"}\n')
    assert sorted(r["text"] for r in io.read_jsonl(spark, ok, "text string").collect()) == ["a", "b"]


def test_split_sink_and_token_sink(spark):
    d = _tmp()
    df = spark.createDataFrame([("doc one", "train"), ("doc two", "valid")], "text_clean string, split string")
    io.write_splits(df, os.path.join(d, "splits"))
    train = spark.read.text(os.path.join(d, "splits", "split=train")).collect()
    assert [r[0] for r in train] == ["doc one", "###"]
    toks = spark.createDataFrame([(1, [1, 5, 3]), (2, [9])], "doc_id long, ids array<int>")
    meta = io.write_tokens(toks, os.path.join(d, "tok"), 300).collect()[0]
    assert meta["num_tokens"] == 4 and meta["max_token_id"] == 9
    with pytest.raises(ValueError):
        io.write_tokens(toks, os.path.join(d, "tok2"), 70000)


def test_vocab_roundtrip(spark):
    from quarry.operators.bpe import merges_frame, vocab_frame

    vocab = {b: bytes([b]) for b in range(256)}
    merges = [(b" ", b"t"), (b"\xe4", b"\xb8")]
    for a, b in merges:
        vocab[len(vocab)] = a + b
    vocab[len(vocab)] = b"<|endoftext|>"
    d = _tmp()
    io.write_vocab(vocab_frame(spark, vocab, ["<|endoftext|>"]), merges_frame(spark, merges), d)
    v2, m2 = io.read_vocab(spark, d)
    assert v2 == vocab and m2 == merges


def test_report_rows(spark):
    agg = spark.createDataFrame([(10, 2)], "total long, dups long")
    rows = {r["metric"]: r["value"] for r in io.report_rows("clean", agg).collect()}
    assert rows == {"total": "10", "dups": "2"}


def test_resolve_prompt_rules(spark):
    conv = '[{"role": "user", "content": "hi"}]'
    rows = [
        (None, None, None, "  plain prompt "),
        (conv, None, None, None),
        (conv, "p", '[{"role": "user", "content": "x"}]', None),
        (None, None, None, "   "),
        ('[{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]', None, None, None),
    ]
    df = spark.createDataFrame(rows, "conversation_json string, conversation_path string, conversation_file string, prompt string")
    out = ch.resolve_prompt(df).collect()
    assert out[0]["resolve_reason"] is None and out[0]["resolved"] == "  plain prompt "
    assert out[1]["resolved"] == "<|user|>\nhi\n<|assistant|>\n"
    assert out[2]["resolve_reason"] == "both_json_and_path"
    assert out[3]["resolve_reason"] == "empty_prompt"
    assert out[4]["resolve_reason"] == "ends_with_assistant"


def test_normalize_conversation_errors(spark):
    T = "array<struct<role:string,content:string>>"
    rows = [
        ([{"role": " USER ", "content": " hi "}, {"role": "assistant", "content": "  "}],),
        ([{"role": "user", "content": "a"}, {"role": "robot", "content": "b"}],),
        ([{"role": "user", "content": "   "}],),
        ([],),
        ([{"role": None, "content": "x"}, {"role": "robot", "content": "b"}],),
    ]
    out = ch.normalize_conversations(spark.createDataFrame(rows, f"conversations {T}")).collect()
    assert [r["invalid_reason"] for r in out] == [None, "unsupported_role", "empty_after_normalize", "empty_list", "non_string_turn"]
    assert [(t["role"], t["content"]) for t in out[0]["conversations"]] == [("user", "hi")]


def test_truncate_history_longest_fitting_suffix(spark):
    df = spark.createDataFrame([([5, 4, 3, 2], 3), ([50], 3), ([1, 1], 0)], "t array<int>, fixed int")
    got = [r[0] for r in df.select(sft.truncate_history(F.col("t"), F.col("fixed"), 0, 10)).collect()]
    # suffixes: [5,4,3,2]=14, [4,3,2]=9, ... with fixed 3 -> 9+3=12 > 10, [3,2]+3=8 fits -> keep 2
    assert got == [2, 0, 2]


def test_prepare_corpus_job(spark):
    import json as _json

    from quarry.plans.jobs import prepare_corpus

    d = _tmp()
    src = os.path.join(d, "corpus.jsonl")
    long_a = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    with open(src, "w", encoding="utf-8") as f:
        for t in ["　" + long_a + "  ", long_a, "short", "<b>" + long_a + " nu</b>", "\x01" + long_a + " xi"]:
            f.write(_json.dumps({"text": t}, ensure_ascii=False) + "\n")
        f.write("broken line\n")
    meta = prepare_corpus(spark, src, os.path.join(d, "out"), clean_html=True)
    fs = meta["filter_stats"]
    assert fs["total_raw_documents"] == 5 and fs["skipped_short"] == 1 and fs["duplicates_removed"] == 1
    assert fs["cleaned_html"] == 1 and fs["cleaned_control_chars"] == 1 and fs["total_kept"] == 3
    lines = spark.read.text(os.path.join(d, "out", "tokenizer_corpus")).collect()
    assert len(lines) == 3


def test_tokenizer_and_scoring_jobs(spark):
    from quarry.plans.jobs import score_outputs, tokenize_corpus, train_tokenizer

    d = _tmp()
    docs = spark.createDataFrame([(1, "hello hello world\n"), (2, "world wide web\n")], "doc_id long, text string")
    vocab, merges = train_tokenizer(spark, docs, os.path.join(d, "tok"), 256 + 5 + 1, ["<|endoftext|>"])
    v2, m2 = io.read_vocab(spark, os.path.join(d, "tok"))
    assert v2 == vocab and m2 == merges and len(merges) == 5
    meta = tokenize_corpus(spark, docs, os.path.join(d, "ids"), vocab, merges, ["<|endoftext|>"])
    assert meta["num_tokens"] > 0 and meta["max_token_id"] < len(vocab)

    prompts = spark.createDataFrame(
        [("p1", ["A"], ["A"], {}, '{"E": {"A": "x"}}')],
        "id string, required_fields array<string>, allowed_fields array<string>, "
        "enum_constraints map<string,array<string>>, gold_output string")
    outs = spark.createDataFrame([("m1", 0, "p1", "extraction", '{"E": {"A": "x"}}', 0.5),
                                  ("m2", 1, "p1", "extraction", "not json", 0.7)],
                                 "model string, model_ord int, id string, group string, output string, latency_s double")
    score_outputs(spark, outs, prompts, os.path.join(d, "scores"), aliases={})
    lb = spark.read.json(os.path.join(d, "scores", "leaderboard")).orderBy("rank").collect()
    assert [r["model"] for r in lb] == ["m1", "m2"] and lb[0]["schema_strict_rate"] == 1.0
