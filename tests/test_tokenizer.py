from collections import Counter

import regex
from pyspark.sql import functions as F

from quarry.operators import bpe, sft

TEXT = [
    "hello world, hello spark! it's 2024.\n",
    "tokenizers split <|endoftext|> on special tokens\n",
    "中文 文本 也 可以 分词 aaaa aaaa\n",
    "low lower lowest newer newest wider\n",
]
SPECIALS = ["<|endoftext|>"]


def brute_bpe(texts, vocab_size, specials):
    counts = Counter()
    pat = regex.compile(bpe.GPT2_PATTERN)
    for t in texts:
        parts = regex.split("|".join(regex.escape(s) for s in specials), t) if specials else [t]
        for p in parts:
            for w in pat.findall(p):
                counts[tuple(bytes([b]) for b in w.encode("utf-8"))] += 1
    words, merges = dict(counts), []
    for _ in range(vocab_size - 256 - len(specials)):
        pairs = Counter()
        for w, c in words.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += c
        if not pairs:
            break
        best = max(pairs.items(), key=lambda kv: (kv[1], kv[0]))[0]
        merges.append(best)
        new: dict = {}
        for w, c in words.items():
            out, i = [], 0
            while i < len(w):
                if i < len(w) - 1 and (w[i], w[i + 1]) == best:
                    out.append(w[i] + w[i + 1])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            new[tuple(out)] = new.get(tuple(out), 0) + c
        words = new
    return merges


def test_pretokens_match_python_regex(spark):
    df = spark.createDataFrame([(t,) for t in TEXT], "text string")
    got = Counter({r["token"]: r["count"] for r in bpe.pretoken_counts(df, "text", SPECIALS).collect()})
    want = Counter()
    for t in TEXT:
        for p in regex.split(regex.escape(SPECIALS[0]), t):
            want.update(w for w in regex.findall(bpe.GPT2_PATTERN, p) if w)
    assert got == want


def test_train_matches_brute_force_and_roundtrip(spark):
    df = spark.createDataFrame([(t,) for t in TEXT], "text string")
    counts = bpe.pretoken_counts(df, "text", SPECIALS)
    vocab, merges = bpe.train_bpe(counts, 256 + 30 + 1, SPECIALS, checkpoint_every=7)
    assert merges == brute_bpe(TEXT, 256 + 30 + 1, SPECIALS)
    assert vocab[len(vocab) - 1] == SPECIALS[0].encode()
    enc = df.withColumn("ids", bpe.encode_column(spark, F.col("text"), vocab, merges, SPECIALS))
    dec = enc.withColumn("back", bpe.decode_column(spark, F.col("ids"), vocab)).collect()
    assert all(r["back"] == r["text"] for r in dec)
    special_id = [k for k, v in vocab.items() if v == SPECIALS[0].encode()][0]
    assert special_id in dec[1]["ids"]


def test_batched_training_equals_one_at_a_time(spark):
    texts = TEXT * 3 + ["the then there these those theme thesis theta\n", "aaaa aaaaa aaa bbbb abab baba\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = bpe.pretoken_counts(df, "text", SPECIALS)
    want = brute_bpe(texts, 256 + 48 + 1, SPECIALS)
    for b in (4, 16):
        _, merges = bpe.train_bpe(counts, 256 + 48 + 1, SPECIALS, checkpoint_every=5, batch=b)
        assert merges == want, b


def test_train_stops_when_no_pairs(spark):
    df = spark.createDataFrame([("ab ab\n",)], "text string")
    vocab, merges = bpe.train_bpe(bpe.pretoken_counts(df, "text"), 256 + 50, ())
    assert merges == brute_bpe(["ab ab\n"], 256 + 50, [])
    assert len(vocab) == 256 + len(merges)


def test_decode_invalid_utf8_replaces(spark):
    vocab = {b: bytes([b]) for b in range(256)}
    df = spark.createDataFrame([([0xE4, 0xB8],)], "ids array<int>")
    out = df.select(bpe.decode_column(spark, F.col("ids"), vocab)).collect()[0][0]
    assert out == bytes([0xE4, 0xB8]).decode("utf-8", errors="replace")


def test_loss_labels_cases(spark):
    H, B, PAD = [9, 8], [7, 1], 7

    def labels(ids, limit, label_eos=False):
        df = spark.createDataFrame([(ids,)], "ids array<int>")
        return df.select(sft.labels_column(F.col("ids"), H, B, limit, PAD, label_eos)).first()[0]

    ids = [5, 9, 8, 3, 4, 7, 1, 9, 8, 6]  # two assistant turns, second without a boundary
    lab = labels(ids, 64)
    assert lab == [-100, -100, -100, 3, 4, -100, 1, -100, -100, 6]
    assert labels(ids, 64, True) == [-100, -100, -100, 3, 4, 7, 1, -100, -100, 6]
    assert labels([], 64) == []
    assert labels([1, 2, 3], 64) == [-100] * 3  # no header
    assert labels([9, 8, 3, 7, 1], 4) == [-100, -100, 3, -100, -100]  # cut by max_length


def test_pack_windows_shift(spark):
    L = 4
    docs = spark.createDataFrame([(0, list(range(0, 5))), (1, list(range(5, 9)))], "doc_id long, ids array<int>")
    w = {r["window"]: r for r in sft.pack_windows(docs, "doc_id", "ids", L, bucket_width=1).collect()}
    assert sorted(w) == [0, 1]  # 9 tokens across two documents: two windows with a full y
    assert w[0]["x"] == [0, 1, 2, 3] and w[0]["y"] == [1, 2, 3, 4]
    assert w[1]["x"] == [4, 5, 6, 7] and w[1]["y"] == [5, 6, 7, 8]
    docs8 = spark.createDataFrame([(0, list(range(8)))], "doc_id long, ids array<int>")
    assert sft.pack_windows(docs8, "doc_id", "ids", L).count() == 1  # 8 tokens: the second y would need a 9th
    docs2 = spark.createDataFrame([(0, list(range(L + 1)))], "doc_id long, ids array<int>")
    assert sft.pack_windows(docs2, "doc_id", "ids", L).count() == 1


def test_encoding_by_distinct_tokens_equals_the_row_wise_encoder(spark):
    texts = [*TEXT, *TEXT, "", None, "   \n\n x  ", "<|endoftext|>", "!!<|endoftext|><|endoftext|> a", "the " * 500, "日本語。" * 30, "it's 'll  it's"]
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "a long, b long, text string").repartition(3)
    vocab, merges = bpe.train_bpe(bpe.pretoken_counts(df, "text", SPECIALS), 256 + 40 + 1, SPECIALS)
    plain = bpe.Encoder(vocab, merges, SPECIALS)
    for share in (1, 20, 10**9):  # no, some and all pre-tokens are frequent
        got = {r["a"]: r["ids"] for r in bpe.encode_texts(df, "text", ["a", "b"], vocab, merges, SPECIALS, hot_share=share).collect()}
        assert got == {i: plain.encode(t) for i, t in enumerate(texts)}, share
    assert bpe.encode_texts(df.limit(0), "text", ["a"], vocab, merges, SPECIALS).count() == 0


def test_pair_index_serves_merges_of_merges(spark):
    """The index is made once for all merges, so later ones are looked up by
    the stretch they stand for."""
    texts = ["abcdefgh abcdefgh abcdefg abcdef abcde abcd abc ab\\n", "bcdefgh xabcdefghx aabbaabb aaaaaaaa ababababab\\n", *TEXT]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = bpe.pretoken_counts(df, "text")
    want = brute_bpe(texts, 256 + 70, [])
    for every in (1, 10_000):
        _, merges = bpe.train_bpe(counts, 256 + 70, (), checkpoint_every=every)
        assert merges == want


def test_sampled_windows_equal_slices_of_the_whole(spark):
    docs = spark.createDataFrame([(i, list(range(i * 100, i * 100 + n))) for i, n in enumerate([3, 0, 50, 1, 7, 0, 120, 2])], "doc_id long, ids array<int>")
    whole = [x for r in docs.orderBy("doc_id").collect() for x in r["ids"]]
    samples = spark.range(400).withColumnRenamed("id", "sample")
    for L in (1, 4, 30, len(whole) - 1):
        rows = sft.sampled_windows(docs, "doc_id", "ids", L, samples, 5).collect()
        assert sorted(r["sample"] for r in rows) == list(range(400))
        assert all(0 <= r["start"] <= len(whole) - L - 1 for r in rows)
        assert all(r["x"] == whole[r["start"] : r["start"] + L] and r["y"] == whole[r["start"] + 1 : r["start"] + L + 1] for r in rows)
        assert len({r["start"] for r in rows}) > min(100, (len(whole) - L) // 2)
    assert sft.sampled_windows(docs, "doc_id", "ids", len(whole), samples, 5).count() == 0


def test_training_rounds_are_few_and_bounded(spark, monkeypatch):
    """One round serves all merges when the stretches fit; with little room, or
    many pairs of one count, rounds take fewer pairs and merges stay the same."""
    texts = [*TEXT, "the then there these those theme thesis theta\n", "aaaa aaaaa aaa bbbb abab baba aaaaaaaa\n", "qwx zjk vfp\n"]
    counts = bpe.pretoken_counts(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    want = brute_bpe(texts, 256 + 12, [])
    rounds, sizes, trained = [], [], bpe._next_merges

    def counted(stretches, *args):
        rounds.append(len(stretches))
        sizes.append(sum(len(w) for w, _ in stretches))
        return trained(stretches, *args)

    monkeypatch.setattr(bpe, "_next_merges", counted)
    assert bpe.train_bpe(counts, 256 + 12)[1] == want
    assert len(rounds) == 1
    for batch, room in ((4096, 40), (2, 10), (1, 1)):
        sizes.clear()
        assert bpe.train_bpe(counts, 256 + 12, batch=batch, room=room)[1] == want, (batch, room)
        assert len(sizes) > 1 and max(sizes) <= max(room, 40)


def test_encoding_shuffles_no_texts(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (None, "c")], "a long, text string")
    got = bpe.encode_texts(df, "text", ["a"], {b: bytes([b]) for b in range(256)}, [])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["a"]: r["ids"] for r in got.collect()} == {1: list(b"a b a"), 2: []}


def test_copies_of_a_row_count_together(spark):
    df = spark.createDataFrame([(1, 2, "a bc"), (2, 1, "a bc")], "a long, n long, text string")
    got = bpe.encode_texts(df, "text", ["a"], {b: bytes([b]) for b in range(256)}, [], times="n")
    assert {r["a"]: bytes(r["ids"]) for r in got.collect()} == {1: b"aa bc bc", 2: b"a bc"}


def test_the_corpus_is_cleaned_once(spark):
    from conftest import SMOKE
    from quarry.plans import tokenize as tk

    assert "regexp_replace" not in tk.corpus(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()


def test_pretokens_are_counted_where_the_texts_lie(spark):
    df = spark.createDataFrame([(None, "a b a"), ("x", "b<|endoftext|>b"), ("x", None), ("x", "b")], "k string, text string").repartition(2)
    counts = bpe.pretoken_counts(df, "text", SPECIALS)
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()  # no row for an occurrence
    assert {r["token"]: r["count"] for r in counts.collect()} == {"a": 1, " b": 1, " a": 1, "b": 3}
    by = bpe.pretoken_counts(df, "text", SPECIALS, by=("k",), with_specials=True)
    assert {(r["k"], r["token"]): r["count"] for r in by.collect()} == {(None, "a"): 1, (None, " b"): 1, (None, " a"): 1, ("x", "b"): 3, ("x", SPECIALS[0]): 1}


def test_words_merged_together_equal_words_merged_alone():
    """Also where two merges give the same bytes, so that a step opens a pair
    of a lower rank, and where words are long or leave the memory at once."""
    merges = [(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"abc", b"a"), (b"a", b"bc"), (b"a", b"a"), (b"aa", b"a")]
    vocab = {b: bytes([b]) for b in range(256)}
    for left, right in merges:
        vocab[len(vocab)] = left + right
    enc = bpe.Encoder(vocab, merges, SPECIALS)
    texts = ["abcabcabc", "bcbca abca", "aaaaa aaaa a", "abc" * 100, "", None, "é中 a<|endoftext|>abc", "cab" * 30]
    for keep in (1, 10**6):
        got = [memoryview(ids).cast("i").tolist() for ids in enc.encode_all(texts, None, keep)]
        assert got == [enc.encode(t) for t in texts]
    twice = memoryview(enc.encode_all(["abc a"], [2])[0]).cast("i").tolist()
    assert twice == enc.encode("abc") * 2 + enc.encode(" a") * 2


def test_texts_cut_together_equal_the_pattern():
    """Blanks of every kind, contractions, special tokens and bounds of texts."""
    import random

    r, pattern = random.Random(1), regex.compile(bpe.GPT2_PATTERN)
    parts = ["'", "'s", "'ll", "'re", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "a", "l", "s", "é", "中", "1", "²", "Ⅷ", "_", "!", "́", "😀", "<|e|>", SPECIALS[0], "<|", "​"]
    pre = bpe.PreTokens(["<|e|>", *SPECIALS])
    for _ in range(1500):
        texts = [None if r.random() < 0.05 else "".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(r.randrange(1, 6))]
        want = [(i, k % 2 == 1, w) for i, t in enumerate(texts) if t for k, piece in enumerate(pre.pieces(t)) for w in ([piece] if k % 2 else pattern.findall(piece))]
        words, of, special = pre.flat(texts)
        assert list(zip(of.tolist(), special.tolist(), words.to_pylist())) == want, texts
    assert [len(x) for x in pre.flat([])] == [0, 0, 0]


def test_token_counts_of_rows_that_are_null_or_empty(spark):
    vocab = {b: bytes([b]) for b in range(256)}
    rows = [(0, ["a", "bc", ""]), (1, None), (2, []), (3, ["é", None])]
    df = spark.createDataFrame(rows, "a long, t array<string>").coalesce(1)
    got = df.select("a", bpe.token_counts_column(spark, F.col("t"), vocab, []).alias("c")).collect()
    assert {r["a"]: r["c"] for r in got} == {0: [1, 2, 0], 1: None, 2: [], 3: [2, 0]}


def test_few_rounds_of_training_write_the_words(spark, monkeypatch):
    texts = [*TEXT, "aaaa aaaaa aaa bbbb abab baba aaaaaaaa\n"]
    counts = bpe.pretoken_counts(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    cuts, rounds, cut, trained = [], [], bpe.cut_lineage, bpe._next_merges
    monkeypatch.setattr(bpe, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    monkeypatch.setattr(bpe, "_next_merges", lambda *a: rounds.append(1) or trained(*a))
    monkeypatch.setattr(bpe, "ROUNDS_A_CUT", 4, raising=False)
    assert bpe.train_bpe(counts, 256 + 10, checkpoint_every=1)[1] == brute_bpe(texts, 256 + 10, [])
    assert len(rounds) == 10 and len(cuts) == 1 + 2


def test_rows_of_words_hold_many():
    import numpy as np

    parts = [(np.array([1, 2, 3], np.uint8), np.array([2, 1]), np.array([5, 7])), (np.array([9, 9], np.int32), np.array([2]), np.array([2**40]))]
    ((symbols, lengths, freq),) = bpe._flat([bpe._packed(parts)])
    assert (symbols.tolist(), lengths.tolist(), freq.tolist()) == ([1, 2, 3, 9, 9], [2, 1, 2], [5, 7, 2**40])


def test_sampled_windows_shuffle_no_token_outside_a_window(spark):
    """Ids are cut where they meet their windows; copies of a document, documents
    of one token and a sample drawn twice count as before."""
    rows = [(i, [i] * (1 + i % 2)) for i in range(300)] + [(300, list(range(5000))), (301, [7, 8]), (301, [7, 8])]
    docs = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(4)
    whole = [x for _, ids in rows for x in ids]
    samples = spark.createDataFrame([(k % 150,) for k in range(200)], "sample long")
    for L in (1, 64, 6000):
        d = sft.sampled_windows(docs, "doc_id", "ids", L, samples, 5)
        got = d.collect()
        assert len(got) == (200 if len(whole) > L else 0)
        assert all(r["x"] + r["y"][-1:] == whole[r["start"] : r["start"] + L + 1] and len(r["x"]) == len(r["y"]) == L for r in got)
    plan = sft.sampled_windows(docs, "doc_id", "ids", 64, samples, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Window" in plan  # no blocks of all tokens are built
    assert not [x for x in plan.split("\n") if "Window" in x and "ids" in x]


def test_encoding_returns_only_the_columns_asked_for(spark):
    df = spark.createDataFrame([(1, "a b", 2), (2, None, 1)], "a long, text string, n long")
    vocab = {b: bytes([b]) for b in range(256)}
    got = bpe.encode_texts(df, "text", ["a"], vocab, [], (), times="n", returned=["a"])
    assert got.columns == ["a", "ids"]
    assert {r["a"]: r["ids"] for r in got.collect()} == {1: list(b"aa b b"), 2: []}
