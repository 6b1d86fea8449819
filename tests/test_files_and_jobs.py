"""File formats, the instruction-extraction job and the log stream."""

import json
import os

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.operators import sft
from quarry.plans import derive as pd_
from quarry.plans import ie as pi
from quarry.plans import ie_job
from quarry.sources import io
from quarry.sources.adapters import IE_CATE_MAP, ie_src, ie_topic_schema


def read_one(spark, path):
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def test_ie_job_equals_the_queries(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    raw = ie_src(spark, SMOKE)
    for s in ("train", "valid", "test"):
        raw.filter(F.col("source") == s).drop("source").write.json(os.path.join(src, s))
    schema = {r.topic: ["name", r.fields] for r in ie_topic_schema(spark, SMOKE).collect()}
    (tmp_path / "schema.json").write_text(json.dumps(schema, ensure_ascii=False))
    meta = ie_job.run(spark, *(os.path.join(src, s) for s in ("train", "valid", "test")), str(tmp_path / "schema.json"), out,
                      target=pd_.SAMPLE_TARGET, limits=pi.IE_LIMITS, quality=pi.IE_QUALITY, cate_map=IE_CATE_MAP, seed=pd_.SEED, compat=True)
    want = {(r.id, r.split) for r in entry.queries()["chat_records"](spark, SMOKE).select("id", "split").collect()}
    got = {(r.id, s) for s in ("train", "valid") for r in spark.read.json(f"{out}/final/{s}").select("id").collect()}
    assert got == want and meta["train_samples"] + meta["valid_samples"] == len(want)
    report = json.loads(read_one(spark, f"{out}/reports/02_filter"))
    reasons = {r.reason: r["count"] for r in entry.queries()["ie_reason_counts"](spark, SMOKE).collect()}
    assert report["after_soft_filter"] == reasons.pop("kept")
    if "leak_with_valid_test" in reasons:
        reasons["leak_with_valid_test"] *= 2  # the published figures count a leak twice
    assert report["hard_filter_reasons"] | report["soft_filter_reasons"] == reasons
    text = read_one(spark, f"{out}/reports/data_report")
    assert text.startswith("# Data report") and f"| final train | {meta['train_samples']:,} |" in text
    assert json.loads(read_one(spark, f"{out}/reports/metadata"))["topic_schemas"] == meta["topic_schemas"]


def test_topic_schema(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"人物": ["x", ["父亲", "b"]], "odd": 3}, ensure_ascii=False))
    assert {r.topic: r.fields for r in io.read_topic_schema(spark, str(tmp_path / "s.json")).collect()} == {"人物": ["父亲", "b"], "odd": None}


def test_tokenizer_files_both_ways(spark, tmp_path):
    vocab = {i: bytes([i]) for i in range(256)} | {256: b"ab", 257: "é".encode()}
    merges = [(b"a", b"b"), (b"\xc3", b"\xa9")]
    v, m = str(tmp_path / "v"), str(tmp_path / "m")
    io.write_tokenizer(spark, vocab, merges, v, m)
    assert io.read_tokenizer(spark, v, m) == (vocab, merges)
    text = json.loads(read_one(spark, v))
    (tmp_path / "w.json").write_text(json.dumps({t: int(i) for i, t in text.items()}))
    (tmp_path / "m.txt").write_text("#version: 1 x\n" + read_one(spark, m) + "\n\n")
    assert io.read_tokenizer(spark, str(tmp_path / "w.json"), str(tmp_path / "m.txt")) == (vocab, merges)
    (tmp_path / "bad.json").write_text('{"a": "b"}')
    with pytest.raises(ValueError):
        io.read_tokenizer(spark, str(tmp_path / "bad.json"), m)


def test_sft_index(spark, tmp_path):
    turn = {"role": "user", "content": "hi"}
    for name, n in (("a", 3), ("b", 40)):
        (tmp_path / f"{name}.jsonl").write_text("\n\n".join(json.dumps({"conversations": [turn | {"content": f"{name}{i}"}]}) for i in range(n)) + "\n")
    got = io.sft_index(spark, str(tmp_path)).orderBy("idx").collect()
    assert [(r.idx, r.conversations[0].content) for r in got] == list(enumerate([f"a{i}" for i in range(3)] + [f"b{i}" for i in range(40)]))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "none.jsonl").write_text("\n \n")
    with pytest.raises(ValueError):
        io.sft_index(spark, str(tmp_path / "sub"))
    (tmp_path / "sub" / "bad.jsonl").write_text('{"x": 1}\n')
    with pytest.raises(Exception, match="conversations list"):
        io.sft_index(spark, str(tmp_path / "sub")).collect()


def test_left_cut_and_history(spark):
    d = spark.createDataFrame([([1, 2, 3, 4],)], "a array<int>")
    assert [d.select(sft.last(F.col("a"), F.lit(n))).first()[0] for n in (0, 2, 4)] == [[], [3, 4], [1, 2, 3, 4]]
    for tokens, want in (([5, 5, 5], 2), ([5, 50, 5], 1), ([50], 0), ([], 0)):
        t = spark.createDataFrame([(tokens,)], "t array<int>")
        assert t.select(sft.truncate_history(F.col("t"), F.lit(2), 3, 16)).first()[0] == want


def test_replayed_system_prompts_of_a_sample_file(spark, tmp_path):
    """Every line of a file, blank ones left out, draws as Python's generator
    seeded with 42 + its index does."""
    import json
    import random

    from quarry.operators import chat

    samples = [[{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": "a"}] for i in range(60)]
    for i in (3, 17):
        samples[i].insert(0, {"role": "system", "content": "own"})
    lines = [json.dumps({"conversations": s}) for s in samples]
    lines.insert(5, "   ")
    (tmp_path / "train.jsonl").write_text("\n".join(lines) + "\n")
    indexed = io.sft_index(spark, str(tmp_path / "train.jsonl"))
    for ratio, prompts in ((0.4, chat.DEFAULT_SYSTEM_PROMPTS), (1.0, ["only"]), (0.0, ["x"])):
        got = {r["idx"]: [tuple(t) for t in r["conversations"]] for r in chat.inject_system(indexed, ratio, prompts, key="idx", compat=True).collect()}
        for i, s in enumerate(samples):
            want = [(t["role"], t["content"]) for t in s]
            rng = random.Random(42 + i)
            if want[0][0] != "system" and rng.random() < ratio:
                want.insert(0, ("system", rng.choice(prompts)))
            assert got[i] == want, (ratio, i)
