"""Golden cases of behaviour that was once wrong, and of the scale-safe forms
against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import bpe, chat, logs, sft
from quarry.operators import sample as sp
from quarry.operators import scoring as sc
from quarry.operators.clean import annotate_corpus, dedup_exact, with_text
from quarry.operators.stats import order_statistic
from quarry.sources import io


def test_empty_patterns_are_refused(spark):
    for header, boundary in (([], [1]), ([1], []), ([], [])):
        with pytest.raises(ValueError):
            sft.labels_column(F.col("ids"), header, boundary, 8, 0)


def test_labels_equal_a_plain_scan(spark):
    r = random.Random(4)

    def plain(ids, header, boundary, limit, pad):
        out, at = [-100] * len(ids), 0
        starts = [i for i in range(len(ids)) if ids[i : i + len(header)] == header]
        for s in starts:
            if s < at:
                continue
            a = s + len(header)
            e = next((i for i in range(a, len(ids)) if ids[i : i + len(boundary)] == boundary), None)
            b = len(ids) if e is None else max(a, min(e + len(boundary), limit))
            for j in range(a, min(b, len(ids))):
                out[j] = -100 if ids[j] == pad else ids[j]
            at = b
        return out

    cases = [[r.randrange(4) for _ in range(r.randrange(25))] for _ in range(120)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)] + [(-1, None)], "i int, ids array<int>")
    for _ in range(10):
        args = ([r.randrange(4) for _ in range(r.randrange(1, 3))], [r.randrange(4) for _ in range(r.randrange(1, 3))], r.randrange(3, 30), 3)
        got = {x["i"]: x["labels"] for x in df.withColumn("labels", sft.labels_column(F.col("ids"), *args)).collect()}
        assert got == {i: plain(c, *args) for i, c in enumerate(cases)} | {-1: None}, args


def test_encoder_equals_lowest_rank_first():
    r = random.Random(2)
    merges, known = [], [bytes([b]) for b in b"abcd"]
    while len(merges) < 25:
        pair = (r.choice(known), r.choice(known))
        if pair not in merges and pair[0] + pair[1] not in known:
            merges.append(pair)
            known.append(pair[0] + pair[1])
    vocab = dict(enumerate([bytes([b]) for b in range(256)] + known[4:]))
    enc = bpe.Encoder(vocab, merges, ["<s>"])
    for _ in range(200):
        word = "".join(r.choice("abcd") for _ in range(r.randrange(1, 30)))
        part = [c.encode() for c in word]
        while ranked := [(merges.index(p), i) for i, p in enumerate(zip(part, part[1:])) if p in merges]:
            pair, out, i = merges[min(ranked)[0]], [], 0
            while i < len(part):
                if tuple(part[i : i + 2]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(part[i])
                    i += 1
            part = out
        assert [vocab[i] for i in enc.encode(word)] == part
    assert enc.encode("ab<s>") == [*enc.encode("ab"), len(vocab)]


def test_half_surrogates_parse(spark):
    rows = [('{"E": {"A": "\\ud83d"}}',), ('{"E": {"A": "\\ud83d\\ude00"}}',)]
    got = [r.p for r in spark.createDataFrame(rows, "t string").select(sc.parse_output(F.col("t")).alias("p")).collect()]
    assert [p.ok for p in got] == [True, True]
    assert [p.entries[0].fields[0].sval for p in got] == ["�", "😀"]


def test_text_records_keep_file_order(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "first"}\n{"text": "\\ud83d cut"}\nnot json\n')
    (tmp_path / "b.jsonl").write_text("".join('{"text": "b%d"}\n' % i for i in range(500)))
    got = [r.text for r in io.read_text_records(spark, str(tmp_path)).orderBy("line_id").collect()]
    assert got == ["first", "� cut"] + [f"b{i}" for i in range(500)]


def test_numbers_are_not_contents(spark):
    rows = [(1, '[{"role": "user", "content": 5}]'), (2, '[{"role": "user", "content": "5"}]'), (3, "{")]
    d = spark.createDataFrame(rows, "id int, conversation_json string").withColumns({"conversation_file": F.lit(None).cast("string"), "prompt": F.lit(None).cast("string")})
    got = {r.id: r.resolve_reason for r in chat.resolve_prompt(d).collect()}
    assert got == {1: "non_string_turn", 2: None, 3: "bad_json"}


def test_dedup_off_keeps_rows_that_share_an_id(spark):
    rows = [(1, "a" * 60), (1, "b" * 60), (2, "a" * 60), (3, "short")]
    a = annotate_corpus(spark.createDataFrame(rows, "doc_id long, text string"))
    assert dedup_exact(a, dedup=False).count() == 3
    kept = dedup_exact(a)
    assert sorted((r.doc_id, r.text_clean[0]) for r in with_text(kept, a).collect()) == [(1, "a"), (1, "b")]
    assert "text_clean" not in kept._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]


def test_losses_are_not_rounded_or_hidden(spark):
    rows = [("tiny", 4e-7, 2), ("tiny", 4e-7, 2), ("nan", 1.0, 2), ("nan", float("nan"), 2), ("none", 1.0, 0)]
    got = {r.run: r.weighted_loss for r in logs.weighted_loss(spark.createDataFrame(rows, "run string, loss double, weight int")).collect()}
    assert math.isclose(got["tiny"], 4e-7) and math.isnan(got["nan"]) and math.isnan(got["none"])


def test_failed_configs_and_batches_are_reported(spark):
    schema = "config string, run int, time_total_s double, completion_tokens int, ttft_s double, status string"
    rows = [("a", 0, 2.0, 4, None, "ok"), ("a", 0, 0.0, 4, None, "ok"), ("a", 1, 5.0, 0, None, "error"), ("b", 0, 1.0, 0, None, "error")]
    log = spark.createDataFrame(rows, schema)
    got = {r.config: r for r in logs.concurrency_summary(log).collect()}
    assert (got["a"].runs, got["a"].batch_max, got["a"].total_errors, got["a"].tps_min, got["a"].tps_mean) == (2, 5.0, 1, 0.0, 1.0)
    assert (got["b"].runs, got["b"].total_requests, got["b"].tps_mean) == (1, 0, None)
    got = {r.config: r for r in logs.bench_summary(log.where("time_total_s > 0")).collect()}
    assert (got["a"].status, got["a"].runs, got["a"].time_p95) == ("ok", 1, 2.0)
    assert (got["b"].status, got["b"].runs, got["b"].time_mean) == ("all_failed", 0, None)


def test_first_best_step_and_running_best(spark):
    r = random.Random(9)
    rows = [("x", s, float(r.randrange(50)), 1.0) for s in range(300)]
    log = spark.createDataFrame(rows, "run string, step long, val_loss double, loss double").repartition(4)
    low = min(v for _, _, v, _ in rows)
    got = logs.log_summary(log).collect()[0]
    assert got.best_step == next(s for _, s, v, _ in rows if v == low) and (got.first_step, got.last_step) == (0, 299)
    want = [s for _, s, v, _ in rows if all(v < u for _, t, u, _ in rows if t < s)]
    for bucket in (7, 65_536):
        assert sorted(x.step for x in logs.best_so_far(log, bucket=bucket).where("is_best").collect()) == want


def test_order_statistic_is_exact(spark):
    r = np.random.default_rng(1)
    rows = [("a", float(x)) for x in r.normal(size=5000)] + [("b", 1.0)] * 50 + [("c", 3.0)] + [("d", float(x)) for x in (2, 1)]
    got = {x.g: x.p for x in order_statistic(spark.createDataFrame(rows, "g string, v double").repartition(5), "g", "v", lambda n: F.floor(n * 0.95), 0.95, "p").collect()}
    for g in "abcd":
        own = sorted(v for k, v in rows if k == g)
        assert got[g] == own[int(len(own) * 0.95)]


def test_enum_message_and_empty_gold(spark):
    assert [r.q for r in spark.createDataFrame([("a",), ("b'x",), ('c"\'d',), ("e\\f",)], "s string").select(sc.quoted(F.col("s")).alias("q")).collect()] == [repr(x) for x in ("a", "b'x", 'c"\'d', "e\\f")]
    schema = "output string, gold_output string, required_fields array<string>, allowed_fields array<string>, enum_constraints map<string,array<string>>"
    rows = [('{"E": {"A": "z"}}', "{}", ["A"], ["A"], {"A": ["b'x", "a", "a"]}), ('{"E": {"A": "a"}}', '{"E": {"A": "a"}}', ["A"], ["A"], {"A": ["a"]})]
    bad, good = sc.score(spark.createDataFrame(rows, schema)).collect()
    assert bad.enum_violations == {"A": "got 'z', expected one of ['a', \"b'x\"]"} and bad.value_match is None
    assert good.value_match == {"A": True}


def test_leaderboard_ranks_on_shown_rates(spark):
    rows = [("late", 0.50004, 0.9, 0.0, 0.0, 0.0), ("early", 0.50001, 0.9, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, "model string, schema_strict_rate double, parseable_rate double, schema_strict_alias_rate double, missing_rate double, hallucination_rate double")
    assert [(r["rank"], r.model) for r in sc.leaderboard(d, ["early", "late"]).orderBy("rank").collect()] == [(1, "early"), (2, "late")]


def test_prefix_sums_of_dense_and_sparse_keys(spark):
    r = random.Random(6)
    for keys in (list(range(500)), sorted(r.sample(range(2**60), 500)), [7], sorted(r.sample(range(-(2**40), 2**40), 200))):
        rows = [(k, r.randrange(9)) for k in keys]
        total, want = 0, {}
        for k, v in rows:
            want[k], total = total, total + v
        got = {x.k: x.offset for x in sft.prefix_sums(spark.createDataFrame(rows, "k long, v int").repartition(4), "k", "v").collect()}
        assert got == want


def test_first_k_is_the_exact_prefix(spark):
    r = random.Random(8)
    rows = [(f"id{i}", r.choice("ab"), r.choice([0, 1, None]), r.randrange(2**60)) for i in range(400)]
    d = spark.createDataFrame(rows, "id string, g string, p int, u long").repartition(4)
    k = F.when(F.col("g") == "a", 37).otherwise(1000)
    got = {x.id for x in sp.first_k(d, ["g"], ["p"], "u", "id", k, buckets=8).collect()}
    own = sorted((x for x in rows if x[1] == "a"), key=lambda x: (x[2] is not None, x[2] or 0, x[3], x[0]))
    assert got == {x[0] for x in own[:37]} | {x[0] for x in rows if x[1] == "b"}


def test_tokens_are_counted_from_what_was_written(spark, tmp_path):
    d = spark.createDataFrame([(1, "train", [1, 2]), (2, "valid", [9])], "doc_id long, split string, ids array<int>")
    got = io.write_tokens(d, str(tmp_path / "t"), 300).collect()[0]
    assert (got.num_tokens, got.max_token_id, got.vocab_size) == (3, 9, 300)
    with pytest.raises(ValueError):
        io.write_tokens(d, str(tmp_path / "u"), 70_000)
