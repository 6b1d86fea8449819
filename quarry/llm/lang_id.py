"""Language identification with segmentation-marginalised unigrams.

Every language has its own probabilities over the pieces of one fixed public
vocabulary.  A word's probability is the sum over all ways to cut it into
pieces, by a forward pass over its bytes; the probabilities are learned by
expectation-maximisation (forward-backward expected counts) on word counts.
A text's score for a language is its words' log probabilities plus the
language's prior; the answer is the most likely language.

Learning reads a bounded sample of each language's rows (about ``max_docs``, by
a hash of the id), so a rare language is learnt too; scoring reads every row in one narrow pass.  Only piece
counts (pieces x languages) come back to the driver.

Defined cases: null text, or text without a letter: ``und`` with score 0; no
labelled rows: every text is ``und``; ties go to the first language in
alphabetical order; words of any length are scored whole (a clause of a script
without blanks is one word), but learnt in stretches of ``_WORD`` bytes, cut
between code points; repeated rows give repeated results; an empty table gives
an empty result; other columns are read only when named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.ragged import Hashes, byte_class, flat, slices, span_hashes, word_hashes, words
from quarry.session import cut_lineage

#: Bytes of a word: a-z and every non-ASCII byte, after lower-casing.
LETTER = byte_class(lambda b: b >= 0x80 or 97 <= b <= 122)
_WORD = 30
_START = b"\0"  # stands before a word, as the vocabulary's word mark does
#: Probability of a byte that no piece covers.
FALLBACK = 1e-7
ROUNDS = 3


def lower_words(column):
    """Words of a text column: (bytes, starts, ends, text, bounds)."""
    data, offsets = flat(pc.utf8_lower(column))
    starts, ends, text, bounds = words(data, offsets, LETTER)
    return data, starts, ends, text, bounds


def cut_long(data, starts, ends, text):
    """Words of at most ``_WORD`` bytes each, cut before a code point."""
    if not len(starts) or int((ends - starts).max()) <= _WORD:
        return starts, ends, text
    whole = ends - starts <= _WORD
    a, b, t = [starts[whole]], [ends[whole]], [text[whole]]
    begin, stop, own = starts[~whole], ends[~whole], text[~whole]
    while len(begin):
        cut = np.minimum(begin + _WORD, stop)
        for _ in range(3):  # a code point has three bytes at most after its first
            inside = (cut < stop) & (data[np.minimum(cut, len(data) - 1)] & 0xC0 == 0x80)
            cut = cut - inside
        a, b, t = [*a, begin], [*b, cut], [*t, own]
        more = cut < stop
        begin, stop, own = cut[more], stop[more], own[more]
    starts, ends, text = np.concatenate(a), np.concatenate(b), np.concatenate(t)
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], text[order]


class Pieces:
    """Sorted hashes of the pieces that lower-case words can hold."""

    def __init__(self, strings: list[bytes]):
        hashes = word_hashes(strings)
        order = np.argsort(hashes)
        self.hashes, self.longest = hashes[order], max(map(len, strings), default=1)
        self.strings = [strings[i] for i in order]

    @classmethod
    def of(cls, path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = set()
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                piece = model.id_to_piece(i)
                raw = piece.removeprefix("▁").encode()
                if LETTER[np.frombuffer(raw, np.uint8)].all() and len(raw) <= _WORD and piece == piece.lower():
                    found.add((_START if piece.startswith("▁") else b"") + raw)
        return cls(sorted(found - {b""}))

    def lattice(self, strings: list[bytes]):
        """Words with their start mark as a matrix: for each end and length,
        (words, end, length, piece or -1 for a lone byte)."""
        own = [_START + s for s in strings]
        size = np.array([len(s) for s in own], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        data = np.frombuffer(b"".join(own[i] for i in order), np.uint8)
        first = np.cumsum(size) - size
        return order, size, first, Hashes(data)

    def edges(self, size, first, hashes):
        """(end, length, number of words, pieces) in order of the end; words
        come longest first, so those that reach an end are a prefix."""
        for end in range(1, int(size[0]) + 1 if len(size) else 0):
            n = int(np.searchsorted(-size, -end, side="right"))
            for length in range(1, min(end, self.longest) + 1):
                got = hashes.of(first[:n] + end - length, first[:n] + end)
                at = np.searchsorted(self.hashes, got)
                at[at == len(self.hashes)] = 0
                yield end, length, n, np.where(self.hashes[at] == got, at, -1)

    def forward(self, strings: list[bytes], table: np.ndarray) -> np.ndarray:
        """log P(word) under each column of ``table`` (pieces + 1 rows; the
        last row is the lone byte), over all segmentations of the whole word.

        One pass over the ends of all words at once.  Only the last ``longest``
        places are kept, and they are scaled as they go, so a word may have any
        length."""
        order, size, first, hashes = self.lattice(strings)
        m, k, ring = len(strings), table.shape[1], self.longest + 1
        alpha, scale = np.zeros((m, ring, k)), np.zeros((m, k))
        alpha[:, 0] = 1
        out = np.empty((m, k))
        lengths = np.arange(1, self.longest + 1)
        for end in range(1, int(size[0]) + 1 if m else 0):
            n = int(np.searchsorted(-size, -end, side="right"))
            own = lengths[: min(end, self.longest)]
            got = hashes.of(first[:n, None] + end - own, np.broadcast_to(first[:n, None] + end, (n, len(own))))
            at = np.searchsorted(self.hashes, got)
            at[at == len(self.hashes)] = 0
            met = self.hashes[at] == got
            piece = np.where(met, at, len(table) - 1)
            met[:, 0] = True  # a lone byte always fits
            word, j = np.nonzero(met)
            value = alpha[word, (end - own[j]) % ring] * table[piece[word, j]]
            now = np.add.reduceat(value, np.flatnonzero(np.diff(word, prepend=-1)), axis=0)
            alpha[:n, end % ring] = now
            if end % 16 == 0:
                alpha[:n] /= now[:, None]
                scale[:n] += np.log(now)
                now = np.ones_like(now)
            done = int(np.searchsorted(-size, -end, side="left"))
            out[order[done:n]] = np.log(now[done:n]) + scale[done:n]
        return out

    def expected(self, strings: list[bytes], column: np.ndarray, weight: np.ndarray, table: np.ndarray):
        """Expected piece counts (pieces + 1 rows) of weighted words, each
        under its own column of ``table``."""
        order, size, first, hashes = self.lattice(strings)
        column, weight = column[order], weight[order]
        m, wide = len(strings), int(size[0]) + 1
        alpha, beta = np.zeros((m, wide)), np.zeros((m, wide))
        alpha[:, 0] = 1
        beta[np.arange(m), size] = 1
        held = []
        for end, length, n, piece in self.edges(size, first, hashes):
            at = np.arange(n) if length == 1 else np.flatnonzero(piece >= 0)
            if len(at):
                p = table[piece[at], column[at]]
                alpha[at, end] += alpha[at, end - length] * p
                held.append((end, length, at, piece[at], p))
        out = np.zeros_like(table)
        scale = weight / alpha[np.arange(m), size]
        for end, length, at, piece, p in reversed(held):
            value = beta[at, end] * p
            beta[at, end - length] += value
            np.add.at(out, (piece, column[at]), value * alpha[at, end - length] * scale[at])
        return out


def sampled(ids: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class of ``ids`` (doc_id, ``label``),
    all of a class that has no more: those whose hash of the id lies below the
    class's share.  A rare class is learnt from as many rows as a frequent one."""
    sizes = ids.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    unit = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return ids.join(sizes, label).where(unit * F.col("__n") < per_class).drop("__n")


def word_counts(docs: DataFrame, label: str, text: str) -> DataFrame:
    """(label, word, n) of the words of ``docs``."""

    def run(batches):
        for part in slices(batches, text):
            data, starts, ends, owner, _ = lower_words(part.column(text))
            starts, ends, owner = cut_long(data, starts, ends, owner)
            if not len(starts):
                continue
            marks = part.column(label).dictionary_encode()
            key = span_hashes(data, starts, ends) ^ (marks.indices.to_numpy()[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            raw = data.tobytes()
            said = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([marks.dictionary.take(pa.array(marks.indices.to_numpy()[owner[first]])), pa.array(said, pa.binary()), pa.array(n)], [label, "word", "n"])

    kind = docs.schema[label].dataType.simpleString()
    counts = docs.select(label, text).mapInArrow(run, f"{label} {kind}, word binary, n long")
    return counts.groupBy(label, "word").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, langs: list[str], prior: np.ndarray, table: np.ndarray, pieces: Pieces):
        self.langs, self.prior, self.table, self.pieces = langs, prior, table, pieces


def fit(labelled: DataFrame, vocabulary: str, lang: str = "lang", text: str = "text", max_docs: int = 4_000) -> Model:
    """Learn from ``labelled`` (doc_id, ``lang``, ``text``): about ``max_docs``
    documents of each language, one text for an id and language."""
    spark = labelled.sparkSession
    some = labelled.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    ids = sampled(some.select("doc_id", "lang").dropDuplicates(), "lang", max_docs)
    ids = F.broadcast(ids)  # bounded by max_docs of each language, so only the sample's texts are moved
    met = some.join(ids, (some.doc_id.eqNullSafe(ids.doc_id)) & (some.lang == ids.lang), "left_semi")
    chosen = met.groupBy("doc_id", "lang").agg(F.max_by("text", F.xxhash64("text")).alias("text")).select("lang", "text")
    frequent = {r.lang: r.n for r in some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # the model has a column for each language
    counts = cut_lineage(word_counts(chosen, "lang", "text"))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    pieces = Pieces.of(vocabulary)
    table = np.full((len(pieces.strings) + 1, max(1, len(langs))), 1 / (len(pieces.strings) + 1))
    table[-1] = FALLBACK
    place = {name: i for i, name in enumerate(langs)}
    shared = spark.sparkContext.broadcast(pieces)

    for _ in range(ROUNDS if langs else 0):
        now = spark.sparkContext.broadcast(table)

        def run(batches, now=now):
            out = np.zeros_like(now.value)
            for batch in batches:
                column = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
                if len(column):
                    out += shared.value.expected(batch.column("word").to_pylist(), column, batch.column("n").to_numpy().astype(float), now.value)
            piece, column = np.nonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(column.astype(np.int32)), pa.array(out[piece, column])], ["piece", "lang", "n"])

        gathered = counts.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        table = np.full_like(table, 0.01)  # every piece keeps a small share in every language
        np.add.at(table, (gathered.piece.to_numpy(), gathered.lang.to_numpy()), gathered.n.to_numpy())
        table /= table.sum(axis=0)
        table[-1] = FALLBACK
    prior = np.log(np.array([frequent[x] for x in langs], float) / sum(frequent[x] for x in langs)) if langs else np.zeros(1)
    return Model(langs, prior, table, pieces)


class _Scores:
    """Log probabilities of the words met so far, emptied when full."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros((0, model.table.shape[1]))

    def of(self, hashes, raw, starts, ends):
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        out = np.empty((len(hashes), self.rows.shape[1]))
        out[~new] = self.rows[at[~new]]
        if new.any():
            strings = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            step = max(256, 32_768 // self.rows.shape[1])
            fresh = np.concatenate([self.model.pieces.forward(strings[i : i + step], self.model.table) for i in range(0, len(strings), step)])
            out[new] = fresh
            if len(self.hashes) + len(fresh) > self.limit:
                self.hashes, self.rows = self.hashes[:0], self.rows[:0]
                at = np.zeros(len(hashes), np.int64)
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.rows = np.insert(self.rows, at[new], fresh, axis=0)
        return out


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (its posterior)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    schema = chosen.select(*keep).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches):
        model = shared.value
        known = _Scores(model)
        names = np.array([*model.langs, "und"], object)
        for part in slices(batches, "__text"):
            data, starts, ends, text_of, _ = lower_words(part.column("__text"))
            total = np.tile(model.prior, (part.num_rows, 1))
            if len(starts) and model.langs:
                hashes, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
                rows = known.of(hashes, data.tobytes(), starts[first], ends[first])
                for k in range(rows.shape[1]):
                    total[:, k] += np.bincount(text_of, rows[back, k], part.num_rows)
            best = total.argmax(axis=1)
            score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            some = part.column("__letter").to_numpy(zero_copy_only=False).astype(bool) & bool(model.langs)
            said = names[np.where(some, best, len(model.langs))]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(said, pa.string()), pa.array(np.where(some, score, 0.0))], [*keep, "lang_pred", "score"])

    return chosen.mapInArrow(run, schema)
