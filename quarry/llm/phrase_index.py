"""Benchmark decontamination with a distributed positional inverted index.

:func:`index` makes the index: a row holds the postings of one slice of
documents, its distinct words with their hashes, sorted, and the ascending
positions of each.  Documents are sharded, as in document-sharded search
engines, so no posting is ever shuffled and a frequent term stays spread over
all tasks.  Written as a table it serves any number of test sets; ``find``
without a stored index makes the same rows on the fly.

A test phrase starts from the postings of its rarest term in the shard; the
offset-adjusted lists of its other terms are intersected in order of rarity.  A
term counts only if the shard's word is the term's, not by its hash alone.
Proximity matches ask only that the rarest distinct terms of a phrase lie close
together; rarity is counted over all documents (from the words and counts of
the index, without postings), so a match does not depend on the other documents
of a shard, and words that no document holds (replaced ones) are not asked for.

The test set is a stated query set: it is handled in blocks of a fixed number
of words, one after the other, each broadcast to one narrow pass over all
documents; what a pass found is written before the next block is read, so
neither the driver nor a task holds more than a block.

Defined cases: a null text has no words; an item without words matches
nothing; an item shorter than the phrase length is one phrase; repeated items
or item ids count once by id, ids of any type; an item whose id is null is left
out of the item lists but its words are hit; an empty test set hits nothing, an
empty table gives an empty result; a very long text is a slice of its own; a
``keep`` column named like a result is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.ragged import ALNUM, LOWER, flat, ranges, slices, span_hashes, word_hashes, words
from quarry.llm.stored import Scratch

#: Words of the test set in one broadcast block.
BLOCK_WORDS = 2_000_000
#: Counted words in a row of gathered counts.
BLOCK = 1 << 12
#: Terms of a phrase that a proximity match asks for, and the span they share.
NEAR_TERMS, NEAR_SPAN = 4, 24


def _text_words(text: str | None) -> list[bytes]:
    data, offsets = flat(pa.array([text], pa.string()))
    data = LOWER[data]
    raw = data.tobytes()
    starts, ends, _, _ = words(data, offsets, ALNUM)
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Phrases:
    """The phrases of one block of items, as arrays over a sorted vocabulary."""

    def __init__(self, items: list[tuple[int, str | None]], size: int):
        cut = [(i, _text_words(t)) for i, t in items]
        cut = [(i, ws) for i, ws in cut if ws]
        vocabulary = sorted({w for _, ws in cut for w in ws})
        hashes = word_hashes(vocabulary)
        order = np.argsort(hashes)
        self.words, self.hashes = [vocabulary[i] for i in order], hashes[order]
        place = {w: i for i, w in enumerate(self.words)}
        seen: dict[tuple, int] = {}
        owners: list[list] = []
        for item, ws in cut:
            terms = [place[w] for w in ws]
            for k in range(max(1, len(ws) - size + 1)):
                phrase = tuple(terms[k : k + size])
                if phrase not in seen:
                    seen[phrase] = len(owners)
                    owners.append([])
                owners[seen[phrase]].append(item)
        self.owners = [sorted({o for o in own if o is not None}) for own in owners]
        self.length = np.array([len(p) for p in seen], np.int64)
        self.terms = np.full((len(seen), size), -1, np.int64)
        for i, p in enumerate(seen):
            self.terms[i, : len(p)] = p

    def rank(self, frequency: np.ndarray, terms: int):
        """``asked``: the ``terms`` rarest distinct terms of each phrase that
        occur at all (all of a shorter phrase), rarest first, -1 where there are
        fewer; a phrase with too few asks for none and matches nothing."""
        never = np.iinfo(np.int64).max
        often = np.where(self.terms >= 0, np.append(frequency, 0)[self.terms], 0)
        distinct = self.terms >= 0
        for k in range(1, self.terms.shape[1]):
            distinct[:, k] &= (self.terms[:, :k] != self.terms[:, k : k + 1]).all(axis=1)
        often = np.where(distinct & (often > 0), often, never)
        order = np.argsort(often, axis=1, kind="stable")[:, :terms]
        self.asked = np.where(np.take_along_axis(often, order, 1) < never, np.take_along_axis(self.terms, order, 1), -1)
        self.asked[(often < never).sum(axis=1) < np.minimum(terms, distinct.sum(axis=1))] = -1


#: Columns of an index row beside ``rows``: the first word of each document;
#: hashes of the distinct words, sorted, with their numbers, bytes and ends; and
#: the positions of each, ascending.
POSTINGS = ("bounds", "terms", "counts", "lexicon", "ends", "postings")


def _built(batches, keep: tuple[str, ...]):
    """Index rows of record batches with the columns ``keep`` and ``__text``."""
    for part in slices(batches, "__text"):
        data, offsets = flat(part.column("__text"))
        data = LOWER[data]
        starts, ends, _, bounds = words(data, offsets, ALNUM)
        hashes = span_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.diff(hashes[order], prepend=hashes[order[:1]] + np.uint64(1))) if len(order) else order
        shown = order[first]
        size = ends[shown] - starts[shown]
        arrays = (bounds.astype("<i8"), hashes[shown].astype("<u8"), np.diff(np.append(first, len(order))).astype("<i4"), data[ranges(starts[shown], size)], np.cumsum(size).astype("<i8"), order.astype("<i4"))
        rows = pa.StructArray.from_arrays([*[part.column(c) for c in keep], pa.nulls(part.num_rows, FOUND)], [*keep, FOUND_NAME])
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), rows), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)], ["rows", *POSTINGS])


class Shard:
    """Positional postings of one slice of documents, of the terms that the
    phrases ask for."""

    def __init__(self, row: dict[str, bytes], phrases: Phrases):
        held = {c: np.frombuffer(row[c], kind) for c, kind in zip(POSTINGS, ("<i8", "<u8", "<i4", "u1", "<i8", "<i4"), strict=True)}
        self.bounds = held["bounds"].astype(np.int64)
        self.text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        self.span = len(self.text) + 1
        known, terms = phrases.hashes, held["terms"]
        at = np.searchsorted(terms, known)
        at[at == len(terms)] = 0
        some = np.flatnonzero(terms[at] == known) if len(terms) else np.zeros(0, np.int64)
        raw, ends = row["lexicon"], held["ends"].tolist()
        good = [raw[ends[k - 1] if k else 0 : ends[k]] == phrases.words[i] for i, k in zip(some.tolist(), at[some].tolist(), strict=True)]
        some = some[np.array(good, bool)]
        counts = held["counts"].astype(np.int64)
        starts = np.cumsum(counts) - counts
        self.frequency = np.zeros(len(known), np.int64)
        self.frequency[some] = counts[at[some]]
        self.first = np.concatenate([[0], np.cumsum(self.frequency)])
        self.postings = held["postings"][ranges(starts[at[some]], counts[at[some]])].astype(np.int64)
        self.keys = np.repeat(some, counts[at[some]]) * self.span + self.postings  # sorted by term, then position

    def has(self, term, position):
        """Membership of offset-adjusted positions in the postings of ``term``."""
        key = term * self.span + position
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return (position >= 0) & (position < self.span - 1) & (self.keys[at] == key)

    def rarest_first(self, phrases: Phrases):
        often = np.where(phrases.terms >= 0, np.append(self.frequency, 0)[phrases.terms], np.iinfo(np.int64).max)
        return np.argsort(often, axis=1, kind="stable"), often

    def exact(self, phrases: Phrases):
        """(phrase, first word) of every occurrence within one document."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or not len(phrases.length):
            return none, none
        order, often = self.rarest_first(phrases)
        live = np.flatnonzero(often.min(axis=1) > 0)  # every term occurs in the shard
        if not len(live):
            return none, none
        rare = order[live, 0]
        counts = often[live, rare]
        phrase = np.repeat(live, counts)
        start = self.postings[ranges(self.first[phrases.terms[live, rare]], counts)] - np.repeat(rare, counts)
        inside = (start >= 0) & (start + phrases.length[phrase] < self.span)
        phrase, start = phrase[inside], start[inside]
        for k in range(1, phrases.terms.shape[1]):
            step = order[phrase, k]
            term = phrases.terms[phrase, step]
            ok = (term < 0) | self.has(np.maximum(term, 0), start + step)
            phrase, start = phrase[ok], start[ok]
            if not len(phrase):
                break
        same = self.text[start] == self.text[start + phrases.length[phrase] - 1] if len(start) else np.zeros(0, bool)
        return phrase[same], start[same]

    def near(self, phrases: Phrases, span: int):
        """(phrase, text): the asked terms of the phrase lie within ``span``
        words on either side of the rarest, in one document."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or not len(phrases.length):
            return none, none
        asked = phrases.asked
        live = np.flatnonzero((asked[:, 0] >= 0) & ((asked < 0) | (self.frequency[asked] > 0)).all(axis=1))
        if not len(live):
            return none, none
        rare = asked[live, 0]
        counts = self.frequency[rare]
        phrase = np.repeat(live, counts)
        centre = self.postings[ranges(self.first[rare], counts)]
        for k in range(1, asked.shape[1]):
            term = asked[phrase, k]
            text = self.text[centre]
            low = np.maximum(centre - span, self.bounds[text])
            high = np.minimum(centre + span, self.bounds[text + 1] - 1)
            at = np.searchsorted(self.keys, term * self.span + low)
            ok = (term < 0) | (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= term * self.span + high)
            phrase, centre = phrase[ok], centre[ok]
        return phrase, self.text[centre]


FOUND_NAME = "__found"
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
#: What the blocks so far found in a document: spans, and places of items in their lists.
FOUND = pa.struct([("spans", pa.list_(SPAN)), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])
FOUND_DDL = f"{FOUND_NAME} struct<spans:array<struct<start:long,end:long>>,items:array<string>,near_items:array<string>>"


def _chosen(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    return docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))


def _index_schema(chosen: DataFrame) -> T.StructType:
    """The schema of index rows over ``chosen``."""
    row = T.StructType([*chosen.drop("__text").schema.fields, *T.StructType.fromDDL(FOUND_DDL)])
    return T.StructType([T.StructField("rows", T.ArrayType(row)), *[T.StructField(c, T.BinaryType()) for c in POSTINGS]])


def index(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The positional index of all documents, with their ``keep`` columns, one
    row for a slice of documents; write it to use it for several test sets."""
    chosen = _chosen(docs, text, keep)
    return chosen.mapInArrow(lambda batches: _built(batches, keep), _index_schema(chosen))


def frequencies(source: DataFrame, build, hashes: np.ndarray) -> np.ndarray:
    """How often the words with these sorted hashes occur in all documents.
    ``build`` makes index rows of the batches of ``source``."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    shared = source.sparkSession.sparkContext.broadcast(hashes)  # a block's words
    length = -(-len(hashes) // BLOCK) * BLOCK

    def count(batches):
        known, sums = shared.value, np.zeros(length, np.int64)
        for batch in build(batches):
            for raw, n in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                terms = np.frombuffer(raw, "<u8")
                at = np.searchsorted(terms, known)
                at[at == len(terms)] = 0
                if len(terms):
                    sums[: len(known)] += np.where(terms[at] == known, np.frombuffer(n, "<i4")[at], 0)
        cells = sums.reshape(-1, BLOCK)
        some = np.flatnonzero(cells.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([cells[k].tobytes() for k in some.tolist()], pa.binary())], ["block", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "counts"])

    row, out = "block int, counts binary", np.zeros(length, np.int64)
    for r in source.mapInArrow(count, row).repartition("block").mapInArrow(add, row).toLocalIterator():
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(bytes(r.counts), np.int64)
    shared.unpersist()
    return out[: len(hashes)]


RESULTS = ("n_words", "spans", "items", "near_items")


def find(docs: DataFrame | None, items: DataFrame, size: int = 13, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = ("doc_id",), block_words: int = BLOCK_WORDS, stored: DataFrame | None = None) -> DataFrame:
    """``keep`` columns of every document, ``n_words``, ``spans`` (maximal runs
    of hit words, end exclusive), ``items`` (ids with an exact phrase match)
    and ``near_items`` (ids with a proximity match).

    ``stored``: a written :func:`index` of the documents, whose rows have the
    ``keep`` columns; without it the rows of ``docs`` are made on the fly."""
    if clash := set(keep) & {*RESULTS, FOUND_NAME, "__text"}:
        raise ValueError(f"keep columns named like results: {sorted(clash)}")
    spark = items.sparkSession
    scratch, kind = Scratch(spark, "phrases"), items.schema[item_id].dataType
    source = _chosen(docs, text, keep) if stored is None else stored.select("rows", *POSTINGS)
    schema = _index_schema(source) if stored is None else source.schema
    # an id travels as text and gets its own type back at the end
    items = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0  # a word has a character at least
    blocks = max(1, -(-int(total) // (2 * block_words)))
    for b in range(blocks):
        build = (lambda batches: _built(batches, keep)) if stored is None and b == 0 else iter
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b)
        phrases = Phrases([tuple(r) for r in part.toLocalIterator()], size)
        counted, bare = (source.select("__text"), lambda batches: _built(batches, ())) if build is not iter else (source.select("terms", "counts"), iter)
        phrases.rank(frequencies(counted, bare, phrases.hashes), NEAR_TERMS)
        block = spark.sparkContext.broadcast(phrases)
        last = b == blocks - 1
        if last:
            row = schema["rows"].dataType.elementType
            result = T.StructType([*[row[c] for c in keep], T.StructField("n_words", T.LongType()), row[FOUND_NAME]])
            out = source.mapInArrow(_passed(build, block, keep, True), result)
        else:  # written, so that this block can go before the next one comes
            source = scratch.write(source.mapInArrow(_passed(build, block, keep, False), schema), f"block-{b}")
            block.unpersist()
            if b:
                scratch.drop(f"block-{b - 1}")
    found = F.col(FOUND_NAME)
    ids = {c: F.array_sort(F.transform(found[c], lambda i: i.cast(kind))).alias(c) for c in ("items", "near_items")}
    return out.select(*keep, "n_words", found["spans"].alias("spans"), ids["items"], ids["near_items"])


def _passed(build, block, keep, last: bool):
    """One narrow pass: what ``block`` matches in every slice is added to what
    earlier blocks found; the last pass gives the documents one by one."""

    def run(batches):
        phrases = block.value
        for batch in build(batches):
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in POSTINGS}
                rows = batch.column("rows")[i].values
                shard = Shard(row, phrases)
                found = _found(shard, phrases, rows.field(FOUND_NAME))
                kept = [rows.field(c) for c in keep]
                if last:
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(shard.bounds)), found], [*keep, "n_words", FOUND_NAME])
                else:
                    made = pa.StructArray.from_arrays([*kept, found], [*keep, FOUND_NAME])
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made), *(pa.array([row[c]], pa.binary()) for c in POSTINGS)], ["rows", *POSTINGS])

    return run


def _found(shard: Shard, phrases: Phrases, earlier: pa.StructArray) -> pa.StructArray:
    """What the phrases and earlier blocks hit, for each document of a slice."""
    phrase, start = shard.exact(phrases)
    hit = np.zeros(shard.span, np.int64)
    np.add.at(hit, start, 1)
    np.add.at(hit, start + phrases.length[phrase], -1)
    before = earlier.to_pylist()
    for i, old in enumerate(before):
        for s in old["spans"] if old else []:
            hit[shard.bounds[i] + s["start"]] += 1
            hit[shard.bounds[i] + s["end"]] -= 1
    covered = np.cumsum(hit)[:-1] > 0
    near, near_text = shard.near(phrases, NEAR_SPAN)
    lists = [_owners(phrases, p, t, [old[c] if old else [] for old in before]) for c, p, t in (("items", phrase, shard.text[start]), ("near_items", near, near_text))]
    return pa.StructArray.from_arrays([_spans(covered, shard), *lists], ["spans", "items", "near_items"])


def _spans(covered: np.ndarray, shard: Shard) -> pa.Array:
    n = len(covered)
    first = np.zeros(n + 1, bool)
    first[shard.bounds] = True
    before = np.concatenate([[False], covered[:-1]]) if n else covered
    after = np.concatenate([covered[1:], [False]]) if n else covered
    starts = np.flatnonzero(covered & (~before | first[:-1]))
    ends = np.flatnonzero(covered & (~after | first[1:])) + 1
    text = shard.text[starts]
    pairs = pa.StructArray.from_arrays([pa.array(starts - shard.bounds[text]), pa.array(ends - shard.bounds[text])], ["start", "end"])
    bounds = np.searchsorted(text, np.arange(len(shard.bounds)))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pairs)


def _owners(phrases: Phrases, phrase: np.ndarray, text: np.ndarray, earlier: list) -> pa.Array:
    found: dict[int, set] = {}
    pairs = np.unique(text * max(1, len(phrases.length)) + phrase)
    for i, p in zip((pairs // max(1, len(phrases.length))).tolist(), (pairs % max(1, len(phrases.length))).tolist(), strict=True):
        found.setdefault(i, set()).update(phrases.owners[p])
    return pa.array([sorted(found.get(i, set()) | set(old)) for i, old in enumerate(earlier)], pa.list_(pa.string()))


def n_hit():
    """Words inside the spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(hit, n_words):
    """A twentieth of the words, and one at least, are hit."""
    return (hit > 0) & (20 * hit >= n_words)
