"""Toxic passages by maximum-scoring segments.

1. From a bounded sample of labelled documents, words get log-odds of the two
   classes under an informative Dirichlet prior (the pooled counts), shrunk
   towards zero by their own uncertainty: all of it within ``MIN_Z`` standard
   errors of zero, a quarter at twice that.
2. Every token scores its log-odds less a drift, which words that the sample
   lacks lose too; the drift makes ordinary text fall by as much as its gains.
   One linear scan finds all maximal scoring segments of a text.
3. Segment scores follow an extreme-value law on clean text: lambda solves
   E[exp(lambda s)] = 1 over the clean token scores, K is fitted on the best
   segments of clean documents.  A segment counts when its expected number by
   chance, K n exp(-lambda S), is small.
4. The document score is a logistic function of its calibrated best segment
   and of the share and number of its significant ones, fitted on the part of
   the sample that the lexicon did not see.  Each class is dealt to both parts;
   a class of fewer than ``PARTS`` documents is in both with all of them.

The lexicon part, the calibration part and the scored rows are handled in
narrow passes; only word counts meet in a shuffle.  The sample has about
``max_docs`` documents, half of them of each class where there are as many,
one text for an id; the lexicon and the calibration rows are bounded by it.

Defined cases: null text = empty text = no segment, the score of a text
without passages; no labelled rows, or one class only: score 0 for all;
several labels of one document: toxic if any is; repeated rows give repeated
results; an empty table gives an empty result; a very long text is scanned
whole in linear time; other columns are read only when named in ``keep``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.lang_id import lower_words, sampled, word_counts
from quarry.llm.ragged import slices, span_hashes, word_hashes
from quarry.llm.scan import maximal
from quarry.session import cut_lineage

#: z-score from which a word's log-odds count (more, the further above), and the least count of a word.
MIN_Z, MIN_COUNT = 1.5, 3
#: Expected number by chance below which a segment is significant.
MAX_EXPECTED = 0.05
#: Mass of the Dirichlet prior, as a share of the counted tokens.
PRIOR = 0.1
#: One of so many parts of the sample calibrates; the others make the lexicon.
PARTS = 4


def segments(scores: np.ndarray, at: np.ndarray, penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score) of a text whose
    tokens ``at`` (ascending) score ``scores``, of either sign, and all others
    -penalty."""
    steps, lost, last = [], 0.0, -1
    for i, s in zip(at.tolist(), scores.tolist(), strict=True):
        lost += penalty * (i - last - 1)
        last = i
        if s > 0:
            steps.append((i, i + 1, lost, s))
            lost = 0.0
        else:
            lost -= s
    return maximal(steps)


class Lexicon:
    def __init__(self, strings: list[bytes], odds: np.ndarray, penalty: float):
        hashes = word_hashes(strings)
        order = np.argsort(hashes)
        self.hashes, self.odds, self.penalty = hashes[order], odds[order], penalty
        self.rate, self.k = 1.0, 1.0

    def passages(self, column):
        """For each text: (number of tokens, its segments)."""
        data, starts, ends, text, bounds = lower_words(column)
        found = np.zeros(0, np.int64)
        if len(starts) and len(self.hashes):
            got = span_hashes(data, starts, ends)
            place = np.searchsorted(self.hashes, got)
            place[place == len(self.hashes)] = 0
            found = np.flatnonzero(self.hashes[place] == got)
        cut = np.searchsorted(found, bounds)
        for i in range(len(bounds) - 1):
            own = found[cut[i] : cut[i + 1]]
            n = int(bounds[i + 1] - bounds[i])
            yield n, segments(self.odds[place[own]], own - bounds[i], self.penalty) if len(own) else []

    def chance(self, score: float, n: int) -> float:
        """Expected number of segments of this score in n clean tokens."""
        return self.k * n * math.exp(-self.rate * score)

    def features(self, n: int, found) -> list[float]:
        """Constant, strength of the best segment, significant ones."""
        if not found or not n:
            return [1.0, 0.0, 0.0, 0.0]
        best = max(s for _, _, s in found)
        own = [(b - a, s) for a, b, s in found if self.chance(s, n) < MAX_EXPECTED]
        return [1.0, math.log1p(max(0.0, self.rate * best - math.log(self.k * n))), math.log1p(len(own)), sum(size for size, _ in own) / n]


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, n: int, found) -> float:
        if self.weights is None:
            return 0.0
        x = float(np.dot(self.weights, self.lexicon.features(n, found)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float):
    """Log-odds of two classes under a Dirichlet prior of the pooled counts,
    and their z-scores."""
    mass = PRIOR * (n_toxic + n_clean)
    prior = PRIOR * (toxic + clean)
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (n_toxic + mass - a)) - np.log(b / (n_clean + mass - b))
    return odds, odds / np.sqrt(1 / a + 1 / b)


def weight(z: np.ndarray) -> np.ndarray:
    """How much of a word's log-odds counts: none within its noise."""
    return np.maximum(0.0, 1 - MIN_Z**2 / np.maximum(z * z, 1e-12))


def _rate(odds: np.ndarray, share: np.ndarray, penalty: float) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1 over clean tokens."""
    rest = 1 - share.sum()

    def over(x):
        return float((share * np.exp(np.minimum(x * odds, 700))).sum() + rest * math.exp(-x * penalty) - 1)

    low, high = 1e-6, 1e-6
    while over(high) <= 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) > 0 else (middle, high)
    return high


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    hold = ridge * np.eye(x.shape[1])
    hold[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", max_docs: int = 30_000) -> Model:
    """Learn from ``labels`` (doc_id, ``label`` 0/1), about ``max_docs`` of them."""
    spark = docs.sparkSession
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max(label) > 0).cast("long").alias("label"))
    known = docs.select("doc_id").where("doc_id is not null").join(known, "doc_id").dropDuplicates(["doc_id"])
    chosen = sampled(known, "label", max_docs // 2)
    # dealt by rank within a class, so both parts get both classes
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit("part")), "doc_id")) - 1
    few = F.count(F.lit(1)).over(Window.partitionBy("label")) < PARTS
    chosen = cut_lineage(chosen.select("doc_id", "label", (rank % PARTS == 0).alias("tunes"), few.alias("few")))
    # the sample is bounded by max_docs, so only its texts are moved
    found = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "tunes", "few").agg(F.max_by("text", F.xxhash64("text")).alias("text"))
    rows = found.select("label", (F.col("few") | F.col("tunes")).alias("tunes"), (F.col("few") | ~F.col("tunes")).alias("teaches"), "text").persist()
    counts = word_counts(rows.where("teaches"), "label", "text").groupBy("word").agg(F.sum(F.when(F.col("label") > 0, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") > 0, 0).otherwise(F.col("n"))).alias("clean")).persist()
    n = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = float(n[0] or 0), float(n[1] or 0)
    if not n_toxic or not n_clean:
        return Model(Lexicon([], np.zeros(0), 1.0), None)
    likely = counts.where(F.col("toxic") + F.col("clean") >= MIN_COUNT).toPandas()  # words of the bounded sample
    toxic, clean = likely.toxic.to_numpy(float), likely.clean.to_numpy(float)
    odds, z = log_odds(toxic, clean, n_toxic, n_clean)
    odds = odds * weight(z)
    keep = odds != 0
    odds, share = odds[keep], (clean[keep] + 0.5) / (n_clean + 1)
    # ordinary text loses twice what chance words gain
    gains = np.maximum(odds, 0.0)
    penalty = max(0.02, 2 * float((gains * share).sum()))
    scores = np.where(odds > 0, odds, odds - penalty)  # a gain is not lessened: the drift already weighs it
    lexicon = Lexicon([bytes(w) for w in likely.word[keep]], scores, penalty)
    lexicon.rate = _rate(scores, share, penalty) if (odds > 0).any() else 1.0
    held = spark.sparkContext.broadcast(lexicon)

    def best(batches):
        for part in slices(batches, "text"):
            y = part.column("label").to_pylist()
            said = list(held.value.passages(part.column("text")))
            top = [max((s for _, _, s in found), default=0.0) for _, found in said]
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int64()), pa.array([k for k, _ in said], pa.int64()), pa.array(top, pa.float64())], ["label", "n", "top"])

    other = rows.where("tunes")
    tops = other.mapInArrow(best, "label long, n long, top double").toPandas()  # at most max_docs rows
    ordinary = tops[(tops.label == 0) & (tops.n > 0)]
    if len(ordinary):  # K from the mean of K n exp(-lambda S), which is 1 for the best segment
        lexicon.k = float(np.clip(1 / max(1e-12, (ordinary.n * np.exp(-lexicon.rate * ordinary.top)).median()), 1e-9, 10))
    tuned = spark.sparkContext.broadcast(lexicon)

    def described(batches):
        for part in slices(batches, "text"):
            x = [tuned.value.features(k, found) for k, found in tuned.value.passages(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    data = other.mapInArrow(described, "label long, x array<double>").toPandas()
    rows.unpersist()
    counts.unpersist()
    if not len(data) or data.label.nunique() < 2:
        return Model(lexicon, None)
    return Model(lexicon, logistic(np.array(data.x.tolist()), data.label.to_numpy(float)))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` and ``passages``: the significant segments
    (first token, end exclusive, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    schema = chosen.select(*keep).withColumns({"score": F.lit(0.0), "passages": F.array().cast("array<struct<start:long,end:long,score:double>>")}).schema

    def run(batches):
        model = shared.value
        for part in slices(batches, "__text"):
            said = list(model.lexicon.passages(part.column("__text")))
            scores = [model.score(n, found) for n, found in said]
            own = [[{"start": a, "end": b, "score": s} for a, b, s in found if model.lexicon.chance(s, n) < MAX_EXPECTED] for n, found in said]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(scores, pa.float64()), pa.array(own, kind)], [*keep, "score", "passages"])

    return chosen.mapInArrow(run, schema)
