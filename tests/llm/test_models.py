import math
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from quarry.llm import lang_id, lm_score, queries, toxicity
from quarry.llm.bpe_arrays import Vocabulary

from .helpers import SCHEMA, clashing, edge_docs

SMALL = "/root/testdata/sf0.01"


def plain_probability(pieces, table, word, col):
    s = b"\0" + word

    def rest(i):
        if i == len(s):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in pieces.strings:
                total += table[pieces.strings.index(s[i:j]), col] * rest(j)
            elif j == i + 1:
                total += table[-1, col] * rest(j)
        return total

    return rest(0)


def test_forward_sums_all_segmentations():
    pieces = lang_id.Pieces([b"\0ab", b"\0a", b"b", b"a", b"bc", b"c", b"abc", b"\0"])
    table = np.random.default_rng(1).random((9, 2))
    table[-1] = 1e-7
    words = [b"abc", b"a", b"abcabc", b"xbc", b"bb", b"c"]
    got = pieces.forward(words, table)
    for i, w in enumerate(words):
        for c in (0, 1):
            assert math.isclose(got[i, c], math.log(plain_probability(pieces, table, w, c)), rel_tol=1e-9)


def test_forward_of_long_words_is_whole():
    """Words far beyond any piece, against sums over all segmentations in exact
    arithmetic; no cut falls into them."""
    from fractions import Fraction

    pieces = lang_id.Pieces([b"\0ab", b"\0a", b"b", b"a", b"bc", b"c", b"abcab", b"cabca", b"\0"])
    table = np.random.default_rng(3).random((10, 2))
    table[-1] = 1e-7
    words = [b"abc" * 40, b"ab" * 100 + b"x", b"z" * 70, b"a", b"cab" * 150]
    got = pieces.forward(words, table)
    for i, w in enumerate(words):
        s = b"\0" + w
        for c in (0, 1):
            alpha = [Fraction(1)]
            for end in range(1, len(s) + 1):
                total = Fraction(0)
                for j in range(max(0, end - pieces.longest), end):
                    if s[j:end] in pieces.strings:
                        total += alpha[j] * Fraction(float(table[pieces.strings.index(s[j:end]), c]))
                    elif j == end - 1:
                        total += alpha[j] * Fraction(float(table[-1, c]))
                alpha.append(total)
            want = math.log(alpha[-1].numerator) - math.log(alpha[-1].denominator)
            assert math.isclose(got[i, c], want, rel_tol=1e-9)
    start = time.time()
    assert np.isfinite(pieces.forward([b"abcx" * 10_000], table)).all()
    assert time.time() - start < 20


def test_unspaced_text_is_told_apart(spark):
    """Clauses without blanks, far longer than the stretches that are learnt."""
    r = random.Random(3)
    kana, han = [chr(0x3042 + i) for i in range(40)], [chr(0x4E00 + i * 7) for i in range(300)]

    def text(letters, n=400):
        return "。".join("".join(r.choices(letters, k=r.randrange(20, 80))) for _ in range(n // 50))

    rows = [(i, text(kana) if i % 2 else text(han), "ja" if i % 2 else "zh", None, 0) for i in range(60)]
    model = lang_id.fit(spark.createDataFrame(rows, SCHEMA), P.path("piece_bpe_32k.model"))
    test = [(i, text(kana, 100) if i % 2 else text(han, 100), None, None, 0) for i in range(30)]
    got = {x.doc_id: x.lang_pred for x in lang_id.identify(spark.createDataFrame(test, SCHEMA), model).collect()}
    assert got == {i: "ja" if i % 2 else "zh" for i in range(30)}


def test_cuts_fall_between_code_points():
    import pyarrow as pa

    data, starts, ends, text, _ = lang_id.lower_words(pa.array(["é" * 100 + " ab " + "日本語" * 30, "x" * 95 + "😀" * 20, None], pa.string()))
    a, b, t = lang_id.cut_long(data, starts, ends, text)
    said = [bytes(data[i:j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    assert all(0 < len(x) <= 30 and x.decode() for x in said)
    assert b"".join(said).decode() == "é" * 100 + "ab" + "日本語" * 30 + "x" * 95 + "😀" * 20
    assert t.tolist() == sorted(t.tolist())


def test_expected_counts_are_the_gradient():
    pieces = lang_id.Pieces([b"\0a", b"b", b"a", b"ab", b"\0"])
    table = np.random.default_rng(2).random((6, 1))
    words, weight = [b"abab", b"ba"], np.array([2.0, 3.0])
    got = pieces.expected(words, np.zeros(2, int), weight, table)[:, 0]
    for k in range(6):  # d log P / d log theta = expected number of uses
        up = table.copy()
        up[k] *= 1 + 1e-6
        slope = (pieces.forward(words, up) - pieces.forward(words, table))[:, 0] @ weight / 1e-6
        assert math.isclose(got[k], slope, abs_tol=1e-4)


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    return docs, labels


def test_language_of_held_out_rows(spark, truth):
    got = queries.op5_language_id(spark, SMALL).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth[0]) and 0.25 < len(held) / len(got) < 0.42
    assert sum(r.lang_pred == truth[0][r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_rows(spark):
    train = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate([("the cat and the dog " * 9, "en"), ("der Hund und die Katze " * 9, "de"), (None, "en"), ("no label", None)])], SCHEMA)
    model = lang_id.fit(train, P.path("piece_bpe_32k.model"))
    docs = clashing(edge_docs(spark))
    got = {(r.doc_id, r.text): r for r in lang_id.identify(docs, model, keep=("doc_id", "text")).collect()}
    for (_, text), r in got.items():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    none = lang_id.fit(train.limit(0), P.path("piece_bpe_32k.model"))
    assert {r.lang_pred for r in lang_id.identify(docs, none).collect()} == {"und"}


def plain_segments(v):
    """The best segment (earliest, shortest on ties), then both sides."""
    out = []

    def go(a, b):
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += v[j]
                if total > 0 and (best is None or total > best[2] + 1e-9):
                    best = (i, j + 1, total)
        if best:
            out.append(best)
            go(a, best[0])
            go(best[1], b)

    go(0, len(v))
    return sorted(out)


def test_maximal_segments():
    r = random.Random(3)
    for _ in range(200):
        n = r.randrange(1, 25)
        at = sorted(r.sample(range(n), r.randrange(n + 1)))
        scores = [r.random() * 3 + 0.01 for _ in at]
        v = [-0.7] * n
        for p, s in zip(at, scores, strict=True):
            v[p] = s
        got = toxicity.segments(np.array(scores), np.array(at, int), 0.7)
        want = plain_segments(v)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_segments_of_a_long_falling_text_are_linear():
    n = 200_000
    rng = np.random.default_rng(1)
    at, scores = np.arange(0, 3 * n, 3), rng.random(n)
    start = time.time()
    assert len(toxicity.segments(scores, at, 5.0)) == n and len(toxicity.segments(scores, at, 0.26)) > 100
    assert len(toxicity.segments(np.where(rng.random(n) < 0.5, scores, -scores), at, 0.01)) > 100
    assert time.time() - start < 4


def test_scores_of_either_sign():
    r = random.Random(8)
    for _ in range(200):
        v = [r.choice((-0.3, 0.4)) if r.random() < 0.4 else r.uniform(-2, 2) for _ in range(r.randrange(1, 25))]
        at = [i for i, x in enumerate(v) if x != -0.3]
        got = toxicity.segments(np.array([v[i] for i in at]), np.array(at, int), 0.3)
        assert [x[:2] for x in got] == [x[:2] for x in plain_segments(v)]


def test_a_rare_class_is_learnt(spark):
    """Three toxic rows of 400, whatever their ids; repeated ids count once."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    for trial in range(3):
        toxic = set(r.sample(range(400), 3))
        text = {i: " ".join(r.choices(words, k=60)) + (" vile scum vile filth scum vile" if i in toxic else "") for i in range(400)}
        docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in text.items()] + [(1, text[1], None, None, 0)] * 50, SCHEMA)
        labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(400)], "doc_id long, toxic int")
        got = {x.doc_id: x.score for x in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
        assert min(got[i] for i in toxic) > max(got[i] for i in text if i not in toxic), trial


def test_a_rare_language_is_learnt(spark):
    common = [(i, "the cat and the dog went over the hill " * 3, "en", None, 0) for i in range(3000)]
    train = spark.createDataFrame([*common, (10_000, "der Hund und die Katze gingen über den Berg " * 3, "de", None, 0)], SCHEMA)
    model = lang_id.fit(train, P.path("piece_bpe_32k.model"), max_docs=50)
    assert model.langs == ["de", "en"]
    test = spark.createDataFrame([(1, "die Katze und der Hund über dem Berg", None, None, 0), (2, "the dog and the cat", None, None, 0)], SCHEMA)
    assert {r.doc_id: r.lang_pred for r in lang_id.identify(test, model).collect()} == {1: "de", 2: "en"}


def test_toxicity_of_held_out_rows(spark, truth):
    got = queries.op3_toxicity(spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.96
    assert sum(a * b for a, b in held) / sum(a for a, _ in held) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_edge_rows(spark):
    docs = clashing(edge_docs(spark))
    labels = spark.createDataFrame([(i, (i or 0) % 2, (i or 0) % 2) for i in (*range(20), 6, 7, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == docs.count()
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}


def test_cross_entropy_difference(spark, truth):
    got = {r.doc_id: r for r in queries.op6_lm_score(spark, SMALL).collect()}
    good = [got[i].score for i, r in truth[1].items() if r.quality == 1]
    bad = [got[i].score for i, r in truth[1].items() if r.quality == 0]
    # a labelled text is scored without its own counts, so a good one is near the background, not below it
    unlabelled = [r.score for i, r in got.items() if i not in truth[1]]
    assert abs(np.median(good)) < 0.2 and abs(np.median(good) - np.median(unlabelled)) < 0.2 < np.median(bad)
    assert np.mean([g < b for g in good for b in bad]) > 0.95


def test_counts_equal_a_plain_model(spark):
    docs = clashing(edge_docs(spark)).where("length(text) < 3000 or text is null")
    path = P.path("byte_bpe_50k.json")
    coded_docs, size = lm_score.tokenized(docs, path, keep=("doc_id", "text", "score"))
    models = lm_score.fit(coded_docs.drop("score"), docs.where("doc_id in (6, 7)").select("doc_id"), size)
    target, background, size = models
    tokens = lm_score.Tokens(Vocabulary(path))
    import pyarrow as pa

    rows = docs.collect()
    n, n_target, pairs = 0, 0, {}
    coded = []
    for r in rows:
        ids, bounds = tokens.of(pa.array([r.text], pa.string()))
        left = lm_score.before(ids, bounds, size)
        coded.append((left, ids))
        n, n_target = n + len(ids), n_target + len(ids) * (r.doc_id in (6, 7))
        for a, b in zip(left.tolist(), ids.tolist(), strict=True):
            pairs[a, b] = pairs.get((a, b), 0) + 1
    assert math.isclose(background.ones.sum(), n_target, rel_tol=1e-9) and math.isclose(target.ones.sum(), n_target)
    (a, b), most = max(pairs.items(), key=lambda x: x[1])
    assert background.pairs[lm_score.slot(np.array([a]), np.array([b]))[0]] * n / n_target >= most - 1e-3
    got = {(r.doc_id, r.text): r for r in lm_score.score(coded_docs.drop("score"), models).collect()}
    for r, (left, ids) in zip(rows, coded, strict=True):
        said = got[r.doc_id, r.text]
        assert said.n_tokens == len(ids)
        want = target.loss(left, ids, lm_score.slot(left, ids)).mean() if len(ids) else 0.0
        assert math.isclose(said.target_loss, want, rel_tol=1e-6) and math.isclose(said.score, said.target_loss - said.background_loss, abs_tol=1e-9)
    none = lm_score.fit(coded_docs, docs.limit(0).select("doc_id"), size)
    assert {round(r.score, 9) for r in lm_score.score(coded_docs.drop("score"), none).collect()} == {0.0}
    empty, size = lm_score.tokenized(docs.limit(0), path)
    assert lm_score.score(empty, lm_score.fit(empty, docs.select("doc_id"), size)).count() == 0


def packed_docs(spark, docs, size):
    rows = [(i, np.asarray(ids).astype(lm_score._kind(size)).tobytes()) for i, ids in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, ids binary").repartition(3)


def test_bigram_counts_share_nothing(spark):
    size, r = 50_000, np.random.default_rng(5)
    docs = [r.integers(0, size, 20_000) for _ in range(20)]
    coded = packed_docs(spark, docs, size)
    models = lm_score.fit(coded, coded.where("doc_id < 5").select("doc_id"), size)
    got = {x.doc_id: x for x in lm_score.score(coded, models).collect()}
    pairs = [Counter(), Counter()]
    for i, d in enumerate(docs):
        own = list(zip([size, *d[:-1].tolist()], d.tolist(), strict=True))
        pairs[1].update(own)
        pairs[0].update(own if i < 5 else [])
    for i, d in enumerate(docs):
        left, own = np.array([size, *d[:-1]]), list(zip([size, *d[:-1].tolist()], d.tolist(), strict=True))
        for m, table, said in zip(models[:2], pairs, (got[i].target_loss, got[i].background_loss), strict=True):
            scale = models[0].ones.sum() / 400_000 if table is pairs[1] else 1
            want = -np.log((np.array([table[p] * scale for p in own]) + lm_score.SMOOTH * m.single[d]) / (m.contexts[left] + lm_score.SMOOTH))
            assert math.isclose(said, want.mean(), rel_tol=1e-9)


def test_a_document_is_scored_by_the_others(spark):
    size, r = 300, np.random.default_rng(6)
    docs = [r.integers(0, size, n) for n in (400, 0, 1, 900, 30, 30, 2000)] + [np.zeros(50, int)]
    docs += [docs[4], docs[0]]  # copies: the other one still counts
    coded = packed_docs(spark, docs, size)
    good = coded.where("doc_id in (0, 2, 4, 7)").select("doc_id")
    flagged = lm_score.marked(coded, good)
    got = {x.doc_id: x for x in lm_score.score(flagged, lm_score.fit(flagged, None, size), "in_target").collect()}
    target = [0, 2, 4, 7]
    n_target, n_all = (sum(len(docs[i]) for i in own) for own in (target, range(len(docs))))
    for i, d in enumerate(docs):
        if not len(d):
            assert got[i].score == 0
            continue
        for own, scale, said in ((target, 1.0, got[i].target_loss), (range(len(docs)), n_target / n_all, got[i].background_loss)):
            others = [docs[j] for j in own if j != i and len(docs[j])]
            pairs, contexts, ones = Counter(), Counter(), Counter()
            for o in others:
                left = [size, *o[:-1].tolist()]
                pairs.update(zip(left, o.tolist(), strict=True))
                contexts.update(left)
                ones.update(o.tolist())
            total = sum(ones.values())
            single = lambda x: (ones[x] * scale + 0.5) / (total * scale + 0.5 * (size + 1))  # noqa: E731, B023
            want = [-math.log((pairs[a, b] * scale + lm_score.SMOOTH * single(b)) / (contexts[a] * scale + lm_score.SMOOTH)) for a, b in zip([size, *d[:-1].tolist()], d.tolist(), strict=True)]
            assert math.isclose(said, sum(want) / len(want), rel_tol=1e-9), i


def test_labelled_and_unlabelled_texts_of_one_source_score_alike(spark):
    size, r = 500, np.random.default_rng(7)
    coded = packed_docs(spark, [r.integers(0, size, 300) for _ in range(40)], size)
    good = coded.where("doc_id < 10").select("doc_id")
    flagged = lm_score.marked(coded, good)
    got = lm_score.score(flagged, lm_score.fit(flagged, None, size), "in_target").collect()
    a, b = ([x.score for x in got if (x.doc_id < 10) == side] for side in (True, False))
    assert abs(np.mean(a) - np.mean(b)) < 0.1 and min(a) < max(b) and min(b) < max(a)


def test_every_labelled_row_is_counted(spark):
    coded = spark.range(20_050).selectExpr("id as doc_id", "unhex('01000200') as ids")
    target, background, _ = lm_score.fit(coded, coded.select("doc_id"), 10)
    assert target.ones.sum() == background.ones.sum() == 40_100
    assert target.pairs[lm_score.slot(np.array([1, 2]), np.array([2, 1]))].tolist() == [20_050, 0]
