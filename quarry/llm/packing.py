"""Packing of documents into sequences of a fixed number of tokens.

A document is its tokens and an end token.  Whole sequences are cut off its
front; what is left over (shorter than a sequence) is packed by a cutting-stock
plan made from the histogram of the left-over lengths (``cutting_stock``):
patterns of lengths that fill a sequence without padding, each used a whole
number of times.  Documents of one length are ranked, and the patterns' places
for that length are handed out by rank.  Left-overs that no whole pattern
takes form a stream, by length and rank, which is cut wherever a sequence
ends; its last tokens go to sequences of powers of two.

Ranks need no window over a length: a task numbers its own rows of each
length, and the counts of (task, length) give every task its first rank.  The
ids are written once to the shared folder, so a lost executor does not change
ranks.  The driver holds the histogram, which the sequence length bounds.

Defined cases: null text = empty text = the end token alone; repeated rows are
documents of their own; a very long text gives many whole sequences; ties in
length go by the order of the written rows; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.bpe_arrays import byte_symbols
from quarry.llm.cutting_stock import Plan, Prices, rounded
from quarry.llm.ragged import slices
from quarry.llm.stored import Scratch
from quarry.llm.token_counts import splitter
from quarry.llm.word_bpe import SETTLED


class Coder:
    """Ids of a text as the ``tokenizers`` library gives them.  Texts of long
    settled code points, without added tokens, take the faster library with
    the same vocabulary; it needs ids that ascend with the merges."""

    def __init__(self, spec: str, pattern: str):
        said = json.loads(spec)
        ids = said["model"]["vocab"]
        self.special = splitter({t["content"]: t["id"] for t in said.get("added_tokens", [])})
        self.library = Tokenizer.from_str(spec)
        byte = {c: b for b, c in enumerate(byte_symbols())}
        names = {t["content"] for t in said.get("added_tokens", [])}
        ranks = {bytes(map(byte.__getitem__, s)): i for s, i in ids.items() if s not in names}
        made = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in said["model"]["merges"]]
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if made == sorted(made) else None

    def __call__(self, s: str) -> list[int]:
        if self.fast is None or not SETTLED.fullmatch(s) or (self.special is not None and self.special.search(s)):
            return self.library.encode(s, add_special_tokens=False).ids
        return self.fast.encode_ordinary(s)


_CODERS: dict = {}


def coder_of(key: str, spec: str, pattern: str) -> Coder:
    """The worker's coder, kept between tasks."""
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(spec, pattern)
    return _CODERS[key]


def width(spec: str, end: int) -> str:
    """The narrowest stored kind of id: two bytes where the vocabulary allows."""
    said = json.loads(spec)
    largest = max([end, *said["model"]["vocab"].values(), *(t["id"] for t in said.get("added_tokens", []))])
    return "<u2" if largest < 1 << 16 else "<u4"


def tokenized(docs: DataFrame, spec: str, pattern: str, size: int, end: int, key: str, text: str) -> DataFrame:
    """Ids (little-endian, as wide as :func:`width` says, with the end token),
    the task, and how many rows of the same left-over length, and whole
    sequences of such rows, the task had before."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # a vocabulary file: bounded
    name, kind = uuid.uuid4().hex, width(spec, end)
    each = int(kind[2])
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    zero = F.lit(0).cast("long")
    schema = chosen.select("key", F.lit(0).alias("part"), F.lit(0).alias("rest"), zero.alias("nth"), zero.alias("whole"), zero.alias("doc_tokens"), F.lit(b"").cast("binary").alias("ids")).schema
    tail = int(end).to_bytes(each, "little")

    def run(batches):
        from quarry.llm.packing import coder_of  # the worker's module, whose coder stays

        code, part = coder_of(name, shared.value, pattern), TaskContext.get().partitionId()
        rows_of, whole_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in slices(batches, "text"):
            ids = [np.array(code(s) if s else [], kind).tobytes() + tail for s in batch.column("text").to_pylist()]
            tokens = np.array([len(b) // each for b in ids], np.int64)
            rest, nth, whole = tokens % size, np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            for i, (r, n) in enumerate(zip(rest.tolist(), (tokens // size).tolist(), strict=True)):
                nth[i], whole[i] = rows_of[r], whole_of[r]
                rows_of[r] += 1
                whole_of[r] += n
            columns = [batch.column("key"), pa.array(np.full(len(ids), part, np.int32)), pa.array(rest.astype(np.int32)), pa.array(nth), pa.array(whole), pa.array(tokens), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "part", "rest", "nth", "whole", "doc_tokens", "ids"])

    return chosen.mapInArrow(run, schema)


class Places:
    """Where the left-over of a (length, rank) lies, from a plan."""

    def __init__(self, plan: Plan, histogram: dict[int, int]):
        self.size = plan.size
        rank, rows, first = {i: 0 for i in histogram}, [], 0
        for copies, lengths in zip(plan.copies, plan.patterns, strict=True):
            offset = 0
            for i, each in lengths.items():
                rows.append((i << 52 | rank[i], each, first, offset))
                rank[i] += copies * each
                offset += each * i
            first += copies
        table = np.array(sorted(rows) or [(-1, 1, 0, 0)], np.int64)
        self.keys, self.each, self.first, self.offset = table.T
        self.covered, self.stream = np.zeros(plan.size, np.int64), np.zeros(plan.size, np.int64)
        at = 0
        for i in sorted(plan.left):
            self.covered[i], self.stream[i] = rank[i], at
            at += plan.left[i] * i
        # ends of the stream's sequences: full ones, then powers of two
        self.n_patterns, self.n_full = first, at // plan.size
        bits = [1 << b for b in reversed(range(plan.size.bit_length())) if (at % plan.size) >> b & 1]
        self.tail = self.n_full * plan.size + np.cumsum([0, *bits])
        self.sequences = first + self.n_full + len(bits)

    def of(self, rest: np.ndarray, rank: np.ndarray):
        """(in a pattern?, sequence, offset) or the place in the stream."""
        at = np.maximum(np.searchsorted(self.keys, rest << 52 | rank, side="right") - 1, 0)
        step = rank - (self.keys[at] & ((1 << 52) - 1))
        inside = rank < self.covered[rest]
        sequence = np.where(inside, self.first[at] + step // self.each[at], 0)
        place = np.where(inside, self.offset[at] + step % self.each[at] * rest, self.stream[rest] + (rank - self.covered[rest]) * rest)
        return inside, sequence, place

    def cuts(self, start: int, length: int):
        """(sequence, offset, length) of a stretch of the stream."""
        out, end = [], start + length
        while start < end:
            if start < self.tail[0]:
                k, begin = start // self.size, start // self.size * self.size
                stop = begin + self.size
            else:
                j = int(np.searchsorted(self.tail, start, side="right")) - 1
                k, begin, stop = self.n_full + j, int(self.tail[j]), int(self.tail[j + 1])
            stop = min(stop, end)
            out.append((self.n_patterns + k, start - begin, stop - start))
            start = stop
        return out


def pack(docs: DataFrame, vocabulary: str, pattern: str, size: int = 1024, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of a document: ``key``, ``start`` (its document's
    tokens before it), ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset``."""
    scratch = Scratch(docs.sparkSession, "packing")
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    kind = width(spec, end)
    coded = scratch.write(tokenized(docs, spec, pattern, size, end, key, text), "tokens")
    counts = coded.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.call_function("div", "doc_tokens", F.lit(size))).alias("w"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "rest", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_first") for c in ("n", "w")])
    totals = counts.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect()  # one row for each length
    histogram = {r["rest"]: r["n"] for r in totals if r["rest"]}
    places = Places(rounded(histogram, Prices(size)), histogram)
    own = np.zeros(size, np.int64)  # first whole sequence of each left-over length
    own[[r["rest"] for r in totals]] = [r["w"] for r in totals]
    own = places.sequences + np.cumsum(own) - own
    plan = docs.sparkSession.sparkContext.broadcast((places, own))  # bounded by the sequence length

    zero = F.lit(0).cast("long")
    schema = coded.select("key", zero.alias("start"), zero.alias("length"), "ids", "doc_tokens", zero.alias("sequence_id"), zero.alias("offset")).schema

    def cut(batches):
        places, own = plan.value
        for batch in slices(batches, "ids"):
            rest = batch.column("rest").to_numpy().astype(np.int64)
            inside, sequence, place = places.of(rest, (batch.column("nth").to_numpy() + batch.column("n_first").to_numpy()))
            whole = own[rest] + batch.column("whole").to_numpy() + batch.column("w_first").to_numpy()
            row, made = [], []
            for i, (b, r, fits, s, p, w) in enumerate(zip(batch.column("ids").to_pylist(), rest.tolist(), inside.tolist(), sequence.tolist(), place.tolist(), whole.tolist(), strict=True)):
                ids = np.frombuffer(b, kind).astype("<u4")
                full = len(ids) - r
                pieces = [(w + k, 0, size) for k in range(full // size)]
                if r:
                    pieces += [(s, p, r)] if fits else places.cuts(p, r)
                start = 0
                for sequence_id, offset, length in pieces:
                    row.append(i)
                    made.append((start, length, ids[start : start + length].tobytes(), sequence_id, offset))
                    start += length
            starts, lengths, pieces_ids, sequences, offsets = zip(*made, strict=True)
            keep = pa.array(row, pa.int64())
            columns = [batch.column("key").take(keep), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(pieces_ids, pa.binary()), batch.column("doc_tokens").take(keep), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = coded.join(firsts, ["part", "rest"]).select("key", "rest", "nth", "whole", "n_first", "w_first", "doc_tokens", "ids")
    return placed.mapInArrow(cut, schema).withColumnRenamed("key", key)
