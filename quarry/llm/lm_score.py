"""Cross-entropy difference scores of documents.

Two n-gram models share one fixed public vocabulary: the target model counts
the documents that labels call good, the background model all documents.  Both
have the same order, the same smoothing and, by scaling the background counts
to the target's number of tokens, the same size; so a document's per-token
loss difference (target minus background, lower is closer to the target)
measures its text and not the sizes of the models.

Texts are cut into tokens once, and the ids are written to the shared folder.
Bigrams are counted exactly: a slice of documents passes on its distinct
bigrams and their numbers, packed by part (a hash of the bigram), and each part
is summed and written as one sorted row.  Scoring asks the same parts: a slice
sends its distinct bigrams, a part answers with their counts, and the answers
meet the slice again.  A bigram is at most one entry of a slice, so a frequent
one loads its part no more than any other; the number of parts follows the
number of tokens, so a part stays small.  Only counts of single tokens, which
the vocabulary bounds, go to the driver and to every task.

The target model counts every labelled row, the background model every row.  A
document is scored by the models of all others: a slice knows its documents'
own bigrams and takes them out.

Defined cases: an empty table gives an empty result; a very long text is one
slice of its own; null text = empty text = no tokens, losses and score 0; no
labelled rows: the target equals the background, all scores 0; repeated rows
count and are scored each; columns named like the results are replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe_arrays import Vocabulary
from quarry.llm.ragged import NOT_BLANK, flat, mix, ranges, slices, span_hashes, words
from quarry.session import checkpoint_dir

#: Tokens whose bigrams share a part, and the least number of parts.
PART_TOKENS, LEAST_PARTS = 1 << 22, 64
#: Bytes of token ids in a slice, and token ids in a row of gathered counts.
SLICE_IDS, BLOCK = 1 << 22, 1 << 12
#: Weight of the unigram estimate in a bigram's, in tokens.
SMOOTH = 20.0


class Tokens:
    """Token ids of texts: blank-led words, merged by a public byte-level
    vocabulary; ids of words met before are kept until the table is full."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 400_000):
        self.vocabulary, self.limit = vocabulary, limit
        self._clear()

    def _clear(self):
        self.hashes, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0

    def of(self, column):
        """(ids of all texts, bounds of each text)."""
        data, offsets = flat(column)
        starts, ends, _, bounds = words(data, offsets, NOT_BLANK)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        hashes, at, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != hashes[inside]
        if new.any() and len(self.hashes) + int(new.sum()) > self.limit:
            self._clear()
            new[:], place = True, np.zeros(len(hashes), np.int64)
        if new.any():
            raw, pick = data.tobytes(), at[new]
            ids, cut = self.vocabulary.merge([b" " + raw[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.first = np.insert(self.first, place[new], self.used + cut[:-1])
            self.count = np.insert(self.count, place[new], np.diff(cut))
            self.used += len(ids)
            place = np.searchsorted(self.hashes, hashes)
        first, count = self.first[place][back], self.count[place][back]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.ids[ranges(first, count)], total[bounds]


def before(ids: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
    """The token before each one; ``start`` at the beginning of a text."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    begin = bounds[:-1]
    out[begin[begin < bounds[1:]]] = start
    return out


def slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The key of a bigram, its own."""
    return (left.astype(np.int64) << 32) | right.astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, so that equal high bytes compress."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return packed(np.diff(keys, prepend=0))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def by_part(keys: np.ndarray, parts: int):
    """(order that groups sorted keys by part, each part's first place)."""
    own = part_of(keys, parts)
    own = own.astype(np.uint16) if parts <= 1 << 16 else own  # short integers are sorted by radix
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(parts + 1))


def tokenized(docs: DataFrame, vocabulary_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)):
    """(``keep`` columns and ``ids`` of every text as packed integers, size of
    the vocabulary).  Written once to the shared folder: counting and scoring
    read the ids, and no text is cut into tokens a second time."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(vocabulary_path)
    size = max(vocabulary.tokens) + 1
    shared, kind = spark.sparkContext.broadcast(vocabulary), _kind(size)
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    schema = chosen.select(*keep).withColumn("ids", F.lit(b"").cast("binary")).schema

    def run(batches):
        tokens = Tokens(shared.value)
        for part in slices(batches, "__text"):
            ids, bounds = tokens.of(part.column("__text"))
            raw, at = ids.astype(kind).tobytes(), (bounds * kind.itemsize).tolist()
            packed = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(packed, pa.binary())], [*keep, "ids"])

    path = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    chosen.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path), size


def _kind(size: int) -> np.dtype:
    return np.dtype("<u2" if size < 1 << 16 else "<u4")


def _ids(column, size: int):
    """(ids of all texts, bounds of each text) of packed ids."""
    data, offsets = flat(column)
    kind = _kind(size)
    return np.frombuffer(data.tobytes(), kind).astype(np.int32), offsets // kind.itemsize


TABLE = "part long, keys binary, n_all binary, n_target binary"


def counted(coded: DataFrame, chosen: DataFrame, size: int, parts: int) -> DataFrame:
    """The written table of exact bigram counts of ``coded`` and ``chosen``:
    one row for each part, keys sorted."""

    def cut(kind):
        def run(batches):
            for piece in slices(batches, "ids", SLICE_IDS):
                ids, bounds = _ids(piece.column("ids"), size)
                keys, n = np.unique(slot(before(ids, bounds, size), ids), return_counts=True)
                order, first = by_part(keys, parts)
                own = np.flatnonzero(np.diff(first))
                rows = [order[first[k] : first[k + 1]] for k in own.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array([kind] * len(own), pa.int32()), pa.array([packed_keys(keys[r]) for r in rows], pa.binary()), pa.array([packed(n[r]) for r in rows], pa.binary())],
                    ["part", "kind", "keys", "n"],
                )

        return run

    def summed(rows):
        """One part: (keys, numbers of all rows, numbers of the target's)."""
        keys = np.concatenate([unpacked_keys(k) for _, k, _ in rows])
        n = np.concatenate([unpacked(x) for _, _, x in rows])
        target = np.repeat([kind for kind, _, _ in rows], [len(k) // 8 for _, k, _ in rows]).astype(bool)
        order = np.argsort(keys, kind="stable")
        keys, n, target = keys[order], n[order], target[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.add.reduceat(np.where(target, 0, n), first), np.add.reduceat(np.where(target, n, 0), first)

    def add(batches):
        now, rows = None, []

        def out():
            keys, a, b = summed(rows)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), *(pa.array([x], pa.binary()) for x in (packed_keys(keys), packed(a), packed(b)))], ["part", "keys", "n_all", "n_target"])

        for batch in batches:
            for part, kind, keys, n in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "keys", "n")), strict=True):
                if part != now and rows:
                    yield out()
                    rows = []
                now = part
                rows.append((kind, keys, n))
        if rows:
            yield out()

    spark, row = coded.sparkSession, "part long, kind int, keys binary, n binary"
    cuts = coded.select("ids").mapInArrow(cut(0), row).union(chosen.select("ids").mapInArrow(cut(1), row))
    path = f"{checkpoint_dir(spark)}/bigrams-{uuid.uuid4().hex}"
    cuts.repartition("part").sortWithinPartitions("part").mapInArrow(add, TABLE).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(TABLE).parquet(path)


def gathered(table: DataFrame, size: int) -> np.ndarray:
    """Four rows of counts by token id: tokens and contexts of all rows, tokens
    and contexts of the target's."""
    length = -(-(size + 1) // BLOCK) * BLOCK

    def count(batches):
        sums = np.zeros((4, length), np.int64)
        for batch in batches:
            for raw, *numbers in zip(*(batch.column(c).to_pylist() for c in ("keys", "n_all", "n_target")), strict=True):
                keys = unpacked_keys(raw)
                for k, n in enumerate(map(unpacked, numbers)):
                    sums[2 * k] += np.bincount(keys & 0xFFFFFFFF, n, length).astype(np.int64)
                    sums[2 * k + 1] += np.bincount(keys >> 32, n, length).astype(np.int64)
        if sums.any():
            cells = [sums[:, i : i + BLOCK].tobytes() for i in range(0, length, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells, pa.binary())], ["block", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "counts"])

    out = np.zeros((4, length), np.int64)
    blocks = table.mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    for r in blocks.toLocalIterator():
        out[:, r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(bytes(r.counts), np.int64).reshape(4, -1)
    return out[:, : size + 1]


class Pairs:
    """Scaled bigram counts, looked up in the written table."""

    def __init__(self, table: DataFrame, parts: int, column: str, scale: float):
        self.table, self.parts, self.column, self.scale = table, parts, column, scale

    def __getitem__(self, keys):
        """For a few keys; documents are scored by :func:`score`."""
        asked = np.asarray(keys, np.int64)
        some, back = np.unique(asked, return_inverse=True)
        own = self.table.where(F.col("part").isin(np.unique(part_of(some, self.parts)).tolist()))
        out = np.zeros(len(some))
        for r in own.select("keys", F.col(self.column).alias("n")).toLocalIterator():
            out += looked_up(unpacked_keys(bytes(r["keys"])), unpacked(bytes(r["n"])), some)
        return (out * self.scale)[back].reshape(asked.shape)


def looked_up(keys: np.ndarray, n: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The numbers of ``asked``; 0 for keys that are not there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, n[at], 0)


class Own:
    """For each token: how often its text holds its bigram, its context and the
    token itself, and how many tokens the text has.

    One sort by (text, bigram) does it: bigrams are numbered by context first,
    so those of one context lie together, and a token is the context of the
    next one, but for the last of a text."""

    def __init__(self, n: np.ndarray, pair: np.ndarray, left: np.ndarray, ids: np.ndarray):
        text = np.repeat(np.arange(len(n)), n)
        order = np.argsort(text * (int(pair.max(initial=0)) + 1) + pair)

        def repeats(values):
            t, v = text[order], values[order]
            first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])])) if len(t) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(t)))
            out = np.empty(len(t), np.int64)
            out[order] = np.repeat(size, size)
            return out

        self.pair, self.context, self.tokens = repeats(pair), repeats(left), n[text]
        ends = np.cumsum(n)[n > 0] - 1  # the last token of each text
        is_end = ids == np.repeat(ids[ends], n[n > 0])
        self.single = np.append(self.context[1:], 0) + is_end
        self.single[ends] = np.bincount(text, is_end, len(n)).astype(np.int64)[n > 0]


class Singles:
    """Scaled counts of tokens and contexts."""

    def __init__(self, ones: np.ndarray, contexts: np.ndarray, scale: float):
        self.ones, self.contexts, self.scale = ones * scale, contexts * scale, scale
        self.single = (self.ones + 0.5) / (self.ones.sum() + 0.5 * len(ones))

    def of(self, seen: np.ndarray, left: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """-log P(token | token before it), seen together so many scaled times."""
        return -np.log((seen + SMOOTH * self.single[ids]) / (self.contexts[left] + SMOOTH))

    def without(self, seen: np.ndarray, left: np.ndarray, ids: np.ndarray, own: Own, counted: np.ndarray) -> np.ndarray:
        """The same under the model of all other texts: what a text itself was
        ``counted`` for (0 or 1, for each token's text) is taken out."""
        take = counted * self.scale
        single = (self.ones[ids] - own.single * take + 0.5) / (self.ones.sum() - own.tokens * take + 0.5 * len(self.ones))
        return -np.log((np.maximum(seen - own.pair * take, 0.0) + SMOOTH * single) / (np.maximum(self.contexts[left] - own.context * take, 0.0) + SMOOTH))


class Ngrams(Singles):
    """Smoothed bigram probabilities from counts."""

    def __init__(self, ones: np.ndarray, contexts: np.ndarray, pairs: Pairs):
        super().__init__(ones, contexts, pairs.scale)
        self.pairs = pairs

    def loss(self, left: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """-log P(token | token before it), for a few tokens."""
        return self.of(self.pairs[at], left, ids)

    def singles(self) -> Singles:
        return Singles(self.ones / self.scale, self.contexts / self.scale, self.scale)


def marked(coded: DataFrame, target_ids: DataFrame, name: str = "in_target") -> DataFrame:
    """``coded`` with a flag for the documents of ``target_ids`` (doc_id),
    written once: counting and scoring both need it."""
    spark = coded.sparkSession
    ids = target_ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn(name, F.lit(True))
    rows = coded.join(ids.hint("merge"), "doc_id", "left")  # labels have no bound: the same plan at any size
    path = f"{checkpoint_dir(spark)}/marked-{uuid.uuid4().hex}"
    rows.withColumn(name, F.coalesce(name, F.lit(False))).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fit(coded: DataFrame, target_ids: DataFrame | None, size: int, flag: str = "in_target"):
    """(target model, background model, size) of :func:`tokenized` rows;
    ``target_ids``: the doc_id of the documents that the target model counts,
    or None for the rows that ``flag`` of :func:`marked` names."""
    if target_ids is None:
        chosen = coded.where(F.col(flag))
    else:
        ids = target_ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        chosen = coded.select("doc_id", "ids").join(ids.hint("merge"), "doc_id", "left_semi")  # labels have no bound: the same plan at any size
    tokens = (coded.agg(F.sum(F.octet_length("ids").cast("long"))).first()[0] or 0) // _kind(size).itemsize
    parts = max(LEAST_PARTS, -(-tokens // PART_TOKENS))
    table = counted(coded, chosen, size, parts)
    ones, contexts, target_ones, target_contexts = gathered(table, size)
    column, n_target = "n_target", target_ones.sum()
    if not n_target:
        column, n_target, target_ones, target_contexts = "n_all", ones.sum(), ones, contexts
    scale = n_target / max(1, ones.sum()) if n_target else 1.0  # the background counts at the target's size
    return Ngrams(target_ones, target_contexts, Pairs(table, parts, column, 1.0)), Ngrams(ones, contexts, Pairs(table, parts, "n_all", scale)), size


def score(coded: DataFrame, models, flag: str | None = None) -> DataFrame:
    """The columns of ``coded`` without the ids, ``n_tokens``, ``target_loss``,
    ``background_loss`` (nats a token) and ``score``, their difference.

    ``flag``: a column that tells the rows the target model counted.  A row is
    then scored by the models of all other rows: its own counts are taken out
    of the background, and of the target if it was counted there, so a score
    tells what a text is like and not whether it was labelled."""
    every = models[0].pairs.column == "n_all"  # no target rows: both models count all
    target, background, size = models
    spark, parts = coded.sparkSession, target.pairs.parts
    shared = spark.sparkContext.broadcast((target.singles(), background.singles()))
    keep = [c for c in coded.columns if c not in ("ids", "n_tokens", "target_loss", "background_loss", "score")]
    schema = coded.select(*keep).withColumns({"n_tokens": F.lit(0).cast("long"), "target_loss": F.lit(0.0), "background_loss": F.lit(0.0), "score": F.lit(0.0)}).schema
    kept = coded.select(*keep).withColumn("n_tokens", F.lit(0).cast("long"))
    # written once: questions and answers of a slice must be about the same rows
    bundle = kept.select(F.lit(0).cast("long").alias("slice"), F.array(F.struct(*kept.columns)).alias("rows"), F.lit(b"").cast("binary").alias("ids")).schema

    def tied(batches):
        number = TaskContext.get().partitionId() << 32
        for piece in slices(batches, "ids", SLICE_IDS):
            data, offsets = flat(piece.column("ids"))
            rows = pa.StructArray.from_arrays([*[piece.column(c) for c in keep], pa.array(np.diff(offsets) // _kind(size).itemsize)], [*keep, "n_tokens"])
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([data.tobytes()], pa.binary())], ["slice", "rows", "ids"])
            number += 1

    def cut(raw, n):
        ids = np.frombuffer(raw, _kind(size)).astype(np.int32)
        bounds = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        return ids, before(ids, bounds, size)

    def ask(batches):
        for batch in batches:
            for number, n, raw in zip(*(batch.column(c).to_pylist() for c in ("slice", "n", "ids")), strict=True):
                ids, left = cut(raw, n)
                keys = np.unique(slot(left, ids))
                order, first = by_part(keys, parts)
                own = np.flatnonzero(np.diff(first))
                asked = [packed_keys(keys[order[first[k] : first[k + 1]]]) for k in own.tolist()]
                none = pa.nulls(len(own), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([number] * len(own), pa.int64()), pa.array(asked, pa.binary()), none, none], ["part", "slice", "keys", "n_target", "n_all"])

    def answer(batches):
        now, held = None, None
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            out = []
            for part, number, raw, a, b in zip(*(batch.column(c).to_pylist() for c in ("part", "slice", "keys", "n_target", "n_all")), strict=True):
                keys = unpacked_keys(raw)
                if part != now:
                    now, held = part, (nothing, nothing, nothing)
                if number is None:
                    held = (keys, unpacked(a), unpacked(b))
                else:
                    out.append((number, part, packed(looked_up(held[0], held[1], keys)), packed(looked_up(held[0], held[2], keys))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["slice", "part", "n_target", "n_all"])

    def judge(batches):
        models, held, answers = shared.value, None, []

        def out():
            rows, raw = held
            n = rows.field("n_tokens").to_numpy(zero_copy_only=False)
            ids, left = cut(raw, n)
            keys, back = np.unique(slot(left, ids), return_inverse=True)
            order, _ = by_part(keys, parts)
            text_of, losses = np.repeat(np.arange(len(n)), n), []
            own = Own(n, back, left, ids) if flag else None
            for k, m in enumerate(models):
                seen = np.zeros(len(keys))
                seen[order] = np.concatenate([unpacked(x[k]) for x in answers]) if answers else 0
                if own is None:
                    loss = m.of(seen[back] * m.scale, left, ids)
                else:
                    counted = np.ones(len(n)) if k or every else rows.field(flag).to_numpy(zero_copy_only=False).astype(float)
                    loss = m.without(seen[back] * m.scale, left, ids, own, counted[text_of])
                losses.append(np.bincount(text_of, loss, len(n)) / np.maximum(n, 1))
            a, b = losses
            return pa.RecordBatch.from_arrays([*[rows.field(c) for c in keep], pa.array(n), pa.array(a), pa.array(b), pa.array(a - b)], [*keep, "n_tokens", "target_loss", "background_loss", "score"])

        for batch in batches:
            numbers, all_rows = batch.column("part").to_pylist(), batch.column("rows")
            for i, part in enumerate(numbers):
                if part is None:
                    if held:
                        yield out()
                    held, answers = (all_rows[i].values, batch.column("ids")[i].as_py()), []
                else:
                    answers.append((batch.column("n_target")[i].as_py(), batch.column("n_all")[i].as_py()))
        if held:
            yield out()

    path = f"{checkpoint_dir(spark)}/slices-{uuid.uuid4().hex}"
    coded.select(*keep, "ids").mapInArrow(tied, bundle).write.option("compression", "zstd").parquet(path)
    tied_rows = spark.read.schema(bundle).parquet(path)
    question = "part long, slice long, keys binary, n_target binary, n_all binary"
    asked = tied_rows.select("slice", F.col("rows.n_tokens").alias("n"), "ids").mapInArrow(ask, question)
    table = target.pairs.table.select("part", F.lit(None).cast("long").alias("slice"), "keys", F.col(target.pairs.column).alias("n_target"), "n_all")
    met = asked.union(table).repartition("part").sortWithinPartitions("part", F.col("slice").asc_nulls_first())
    answers = met.mapInArrow(answer, "slice long, part long, n_target binary, n_all binary")
    both = tied_rows.unionByName(answers, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", F.col("part").asc_nulls_first())
    return both.mapInArrow(judge, schema)
