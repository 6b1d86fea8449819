"""Repeated byte strings across documents, with anchored suffix arrays.

A string of ``length`` bytes is judged by the smallest-hash ``gram`` inside it
(its anchor, leftmost on ties): equal strings have equal anchors at equal
places, so all occurrences of a string meet under its anchor and no suffix of
the corpus has to be sorted against any other.  For one anchor occurrence the
strings that choose it form one *context*, a byte range around it.

1. A narrow pass writes the contexts as (anchor hash, digest, place); their
   bytes stay behind.  Equal contexts are folded by count before anything
   meets, so a group of copies of any size is one row.
2. Anchors with one occurrence are done.  A context that occurs twice repeats
   in whole.  Only different contexts under one anchor need their bytes, which
   are cut from the representative's document.
3. Under one anchor the suffixes that start there are sorted (a suffix array
   with one entry per context) with their common prefixes; a stack scan walks
   the interval tree bottom up.  Each interval merges its members' reversed
   left sides, and where left extensions differ the group is a maximal repeat;
   all occurrences are kept, not neighbours only.
4. An anchor with more than ``GROUP`` different contexts is not put into one
   task: its strings are counted one by one by digest, an exact aggregate that
   can be spread.
5. The repeats are carried back to every occurrence and merged per document.

Chunks bound the memory of very long texts: strings, not documents, are the
unit, so a chunk carries ``length - 1`` bytes of the next.

Defined cases: null text = empty text; texts shorter than ``length`` have no
string; a string that repeats inside one document counts; rows that share a
doc_id are different documents only if their texts differ; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.ragged import Hashes, flat, slices
from quarry.session import cut_lineage

#: Strings of one text judged at once.
CHUNK = 1 << 19
#: Different contexts of one anchor that a task compares.
GROUP = 4096
_SIZE_BITS = 12  # of a context's length and of its anchor's place in it


def contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For every anchor occurrence: (text, first byte in it, anchor's place in
    the context, length of the context, anchor hash, context digest, and the
    context's place in ``data``)."""
    width = length - gram + 1  # grams of one string
    n = len(data) - length + 1
    if n < 1:
        return None
    grams = np.arange(len(data) - gram + 1)
    hashes = Hashes(data).of(grams, grams + gram)
    key = (hashes >> np.uint64(24) << np.uint64(24)) | grams.astype(np.uint64)  # ties: leftmost
    low, step = key, 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[: n], low[width - step : width - step + n])
    anchor = (low[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    # strings lie within one text
    inside = np.zeros(len(data) + 1, np.int32)
    a, b = offsets[:-1], offsets[1:] - length + 1
    some = b > a
    np.add.at(inside, a[some], 1)
    np.add.at(inside, b[some], -1)
    valid = np.cumsum(inside)[:n] > 0
    first = valid.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    starts_text = offsets[:-1][some]
    first[starts_text[starts_text < n]] = True
    begin = np.flatnonzero(first)
    if not len(begin):
        return None
    last = valid.copy()
    last[:-1] &= first[1:] | ~valid[1:]
    end = np.flatnonzero(last) + length
    at = anchor[begin]
    lead = at - begin
    text = np.searchsorted(offsets, begin, side="right") - 1
    raw = data.tobytes()
    digest = xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(raw[x:y], k) for x, y, k in zip(begin.tolist(), end.tolist(), lead.tolist(), strict=True)), np.uint64, len(begin))
    return text, begin - offsets[text], lead, end - begin, hashes[at], digests, begin


def _chunks(data, offsets, length):
    """(first text, first byte of it, data, offsets) of bounded pieces."""
    if len(data) <= 4 * CHUNK or len(offsets) > 2:
        yield 0, 0, data, offsets
        return
    for at in range(0, len(data) - length + 1, CHUNK):
        piece = data[at : at + CHUNK + length - 1]
        yield 0, at, piece, np.array([0, len(piece)])


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Rows are told apart by their id and a hash of their text."""
    return docs.select(F.col("doc_id"), F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("mark"), F.col(text).alias("__text"))


def _scan(batches, length, gram):
    """All contexts of the texts: a dict of arrays for each piece."""
    for part in slices(batches, "__text"):
        data, offsets = flat(part.column("__text"))
        ids, marks = part.column("doc_id"), part.column("mark")
        for _, base, piece, bounds in _chunks(data, offsets, length):
            found = contexts(piece, bounds, length, gram)
            if found is not None:
                text, first, lead, size, anchor, digest, place = found
                yield {"ids": ids, "marks": marks, "text": text, "place": ((first + base) << (2 * _SIZE_BITS)) | (lead << _SIZE_BITS) | size, "anchor": anchor.view(np.int64), "digest": digest.view(np.int64), "data": piece, "at": place, "lead": lead, "size": size}


_FOLDED = "anchor long, digest long, n long, doc_id long, mark int, place long"
#: Contexts that a task folds before it passes them on.
FOLD = 1 << 18


def _folded(length, gram):
    """(anchor, digest) with their number and one place, folded per task."""

    def run(batches):
        held, n = [], 0
        for c in _scan(batches, length, gram):
            pick = pa.array(c["text"])
            held.append((c["anchor"], c["digest"], c["ids"].take(pick).to_numpy(zero_copy_only=False), c["marks"].take(pick).to_numpy(zero_copy_only=False), c["place"]))
            n += len(c["anchor"])
            if n >= FOLD:
                yield from fold(held)
                held, n = [], 0
        yield from fold(held)

    def fold(held):
        if held:
            anchor, digest, ids, marks, place = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((digest, anchor))
            anchor, digest = anchor[order], digest[order]
            first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])]))
            n = np.diff(np.append(first, len(order)))
            at = order[first]
            cols = [anchor[first], digest[first], n, ids[at], marks[at], place[at]]
            yield pa.RecordBatch.from_arrays([pa.array(x, from_pandas=True, type=t) for x, t in zip(cols, [pa.int64()] * 4 + [pa.int32(), pa.int64()], strict=True)], ["anchor", "digest", "n", "doc_id", "mark", "place"])

    return run


#: Bits of the map of anchors that a later pass looks at (16 MB; a wrong hit
#: only costs a row that the exact join then drops).
MAP_BITS = 1 << 27


def _bitmap(spark, anchors: DataFrame):
    bit = F.pmod(F.col("anchor"), F.lit(MAP_BITS)).cast("long") + 1  # the functions number bits from 1
    parts = anchors.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(MAP_BITS // 8 + 8192, np.uint8)
    for r in parts.toLocalIterator():
        at = (r.bucket - 1) * len(r.bits)
        out[at : at + len(r.bits)] |= np.frombuffer(bytes(r.bits), np.uint8)
    return spark.sparkContext.broadcast(out)


def _marked(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    at = anchor.view(np.uint64) & np.uint64(MAP_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _bytes_of(bits, length, gram):
    """(anchor, digest, lead, bytes) of contexts whose anchor is marked."""

    def run(batches):
        for c in _scan(batches, length, gram):
            hit = np.flatnonzero(_marked(bits.value, c["anchor"]))
            raw = c["data"].tobytes()
            at, size = c["at"][hit].tolist(), c["size"][hit].tolist()
            own = [raw[a : a + n] for a, n in zip(at, size, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c["anchor"][hit]), pa.array(c["digest"][hit]), pa.array(c["lead"][hit].astype(np.int32)), pa.array(own, pa.binary())], ["anchor", "digest", "lead", "bytes"])

    return run


def _places_of(bits, length, gram):
    """(anchor, digest, doc_id, mark, place) of contexts whose anchor is marked."""

    def run(batches):
        for c in _scan(batches, length, gram):
            hit = np.flatnonzero(_marked(bits.value, c["anchor"]))
            pick = pa.array(c["text"][hit])
            yield pa.RecordBatch.from_arrays([pa.array(c["anchor"][hit]), pa.array(c["digest"][hit]), c["ids"].take(pick).cast(pa.int64()), c["marks"].take(pick), pa.array(c["place"][hit])], ["anchor", "digest", "doc_id", "mark", "place"])

    return run


def common(strings: list[bytes]) -> np.ndarray:
    """Common prefix of each string with the one before it (first: 0)."""
    m = len(strings)
    size = np.array([len(s) for s in strings], np.int64)
    wide = int(size.max(initial=0))
    out = np.zeros(m, np.int64)
    if m < 2 or not wide:
        return out
    table = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8).reshape(m, wide)
    other = table[1:] != table[:-1]
    first = np.where(other.any(axis=1), other.argmax(axis=1), wide)
    out[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    return out


class _LeftOrder:
    """Common left extensions of any two members, from their sorted order."""

    def __init__(self, near: np.ndarray):
        self.levels = [near]
        while 2 << (len(self.levels) - 1) <= len(near):
            k, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-k], last[k:]))

    def shared(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For ranks low < high."""
        span = high - low
        level = np.log2(span).astype(np.int64)
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at] + 1], self.levels[k][high[at] + 1 - (1 << k)])
        return out


def stack_scan(right: np.ndarray, rank: np.ndarray, left: _LeftOrder, length: int):
    """Walk the interval tree of the sorted suffixes bottom up.

    ``right[k]``: common prefix of suffixes k-1 and k; ``rank``: place of each
    suffix in the order of the left sides.  Joining two child intervals at
    depth d, a member shares d bytes to the right with all of the other child;
    its left extension is diverse, so the repeat is maximal, exactly as far as
    the best left match there.  Returns for each suffix the longest and the
    shortest left part of its repeated strings (longest < shortest: none)."""
    m = len(right)
    far, close = np.full(m, -1, np.int64), np.full(m, length + 1, np.int64)
    groups: list[np.ndarray] = []
    depths: list[int] = []

    def join():
        b, a, depth = groups.pop(), groups.pop(), depths.pop()
        depths.pop()
        members = np.concatenate([a, b])
        order = np.argsort(rank[members], kind="stable")
        members, side = members[order], (order >= len(a))
        ranks, k = rank[members], np.arange(len(members))
        best = np.zeros(len(members), np.int64)
        for own in (False, True):  # nearest member of the other child on both sides
            before = np.maximum.accumulate(np.where(side != own, k, -1))
            after = np.minimum.accumulate(np.where(side != own, k, len(k))[::-1])[::-1]
            at = np.flatnonzero((side == own) & (before >= 0))
            best[at] = np.maximum(best[at], left.shared(ranks[before[at]], ranks[at]))
            at = np.flatnonzero((side == own) & (after < len(k)))
            best[at] = np.maximum(best[at], left.shared(ranks[at], ranks[after[at]]))
        good = best >= length - depth
        hit = members[good]
        far[hit] = np.maximum(far[hit], best[good])
        close[hit] = np.minimum(close[hit], length - depth)
        return members

    for k in range(m):
        while len(groups) > 1 and depths[-1] > right[k]:
            below = depths[-2]
            groups.append(join())
            depths.append(below)
        groups.append(np.array([k]))
        depths.append(int(right[k]))
    while len(groups) > 1:
        below = depths[-2]
        groups.append(join())
        depths.append(below)
    return far, close


def repeated_parts(anchor: np.ndarray, lead: list[int], own: list[bytes], length: int):
    """(first, end) byte of the repeated part of each context, compared with
    the other contexts of its anchor; end 0: nothing repeats.  ``anchor`` is
    sorted."""
    m = len(own)
    rights = [s[k:] for s, k in zip(own, lead, strict=True)]
    lefts = [s[:k][::-1] for s, k in zip(own, lead, strict=True)]
    group = np.cumsum(np.concatenate([[0], anchor[1:] != anchor[:-1]])) if m else anchor
    number = group.tolist()
    by_right = sorted(range(m), key=lambda i: (number[i], rights[i]))
    by_left = sorted(range(m), key=lambda i: (number[i], lefts[i]))
    right, near = common([rights[i] for i in by_right]), common([lefts[i] for i in by_left])
    rank = np.empty(m, np.int64)
    rank[by_left] = np.arange(m)
    rank = rank[by_right]
    far, close = np.full(m, -1, np.int64), np.full(m, length + 1, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(begin, m))
    pair = begin[size == 2]
    good = pair[near[pair + 1] >= length - right[pair + 1]]
    for at in (good, good + 1):
        far[at], close[at] = near[good + 1], length - right[good + 1]
    for a, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        far[a : a + n], close[a : a + n] = stack_scan(np.concatenate([[0], right[a + 1 : a + n]]), rank[a : a + n] - a, _LeftOrder(near[a : a + n]), length)
    leads = np.array(lead, np.int64)[by_right]
    some = far >= close
    first, end = np.zeros(m, np.int64), np.zeros(m, np.int64)
    first[by_right] = np.where(some, leads - far, 0)
    end[by_right] = np.where(some, leads - close + length, 0)
    return first, end


_PARTS = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "digest", "first", "end")])


def _compared(length):
    names = ["anchor", "digest", "lead", "bytes"]

    def made(rows):
        anchor = rows.column("anchor").to_numpy()
        first, end = repeated_parts(anchor, rows.column("lead").to_pylist(), rows.column("bytes").to_pylist(), length)
        some = end > 0
        return pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (anchor, rows.column("digest").to_numpy(), first, end)], _PARTS.names)

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch.select(names)]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch.select(names)])])
            rows = rows.combine_chunks()
            anchor = rows.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0  # the last group may go on
            if cut:
                yield made(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None and len(held):
            yield made(held)

    return run


def _strings(length):
    """Every string of a context: (anchor, digest, left part, string digests)."""

    def run(batches):
        for batch in batches:
            anchor, digest, left, one, two = [], [], [], [], []
            for a, d, lead, s in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "lead", "bytes")), strict=True):
                for k in range(len(s) - length + 1):
                    h = xxhash.xxh3_128_intdigest(s[k : k + length])
                    anchor.append(a)
                    digest.append(d)
                    left.append(lead - k)
                    one.append((h & (2**64 - 1)) - 2**63)
                    two.append((h >> 64) - 2**63)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchor, digest, left, one, two)], ["anchor", "digest", "left", "one", "two"])

    return run


def _counted(rows: DataFrame, length: int) -> DataFrame:
    """The parts of contexts whose anchor has too many for one task."""
    strings = rows.mapInArrow(_strings(length), "anchor long, digest long, left long, one long, two long")
    key = ["anchor", "left", "one", "two"]
    twice = strings.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    parts = strings.join(twice, key).groupBy("anchor", "digest").agg(F.max("left").alias("far"), F.min("left").alias("close"))
    back = rows.select("anchor", "digest", "lead").join(parts, ["anchor", "digest"])
    return back.select("anchor", "digest", (F.col("lead") - F.col("far")).alias("first"), (F.col("lead") - F.col("close") + length).alias("end"))


def repeated(docs: DataFrame, length: int = 200, gram: int = 64, text: str = "text") -> DataFrame:
    """(doc_id, mark, spans): the bytes of each document covered by a string of
    ``length`` bytes that also starts elsewhere, as pieces that may overlap."""
    spark = docs.sparkSession
    keyed = _keyed(docs, text)
    folded = keyed.mapInArrow(_folded(length, gram), _FOLDED).repartition("anchor")
    each = folded.groupBy("anchor", "digest").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "mark", "place")).alias("rep"))
    own = Window.partitionBy("anchor")
    again = each.withColumns({"kinds": F.count("*").over(own), "total": F.sum("n").over(own)}).where("total > 1")
    again = cut_lineage(again.select("anchor", "digest", "n", "kinds", F.col("rep.place").bitwiseAND(F.lit((1 << _SIZE_BITS) - 1)).alias("size")))
    several = again.where("kinds > 1")
    held = keyed.mapInArrow(_bytes_of(_bitmap(spark, several), length, gram), "anchor long, digest long, lead int, bytes binary")
    held = held.groupBy("anchor", "digest").agg(F.min(F.struct("lead", "bytes")).alias("c"))
    held = held.join(several.select("anchor", "digest", "kinds"), ["anchor", "digest"]).select("anchor", "digest", "c.lead", "c.bytes", "kinds")
    small = held.where(F.col("kinds") <= GROUP).drop("kinds").repartition("anchor").sortWithinPartitions("anchor")
    parts = small.mapInArrow(_compared(length), _PARTS).union(_counted(held.where(F.col("kinds") > GROUP).drop("kinds"), length))
    whole = again.where("n > 1").select("anchor", "digest", F.lit(0).cast("long").alias("first"), F.col("size").alias("end"))
    # a context may be whole and also meet others: the widest part holds all
    parts = cut_lineage(whole.union(parts).groupBy("anchor", "digest").agg(F.min("first").alias("first"), F.max("end").alias("end")))
    places = keyed.mapInArrow(_places_of(_bitmap(spark, parts), length, gram), "anchor long, digest long, doc_id long, mark int, place long")
    start = F.shiftright("place", 2 * _SIZE_BITS)
    spans = places.join(parts, ["anchor", "digest"]).select("doc_id", "mark", F.struct((start + F.col("first")).alias("start"), (start + F.col("end")).alias("end")).alias("s"))
    return spans.groupBy("doc_id", "mark").agg(F.collect_list("s").alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, ``spans`` (maximal removed runs, end exclusive) and
    ``kept`` (binary: the remaining bytes) of every row of ``docs``."""
    keyed = _keyed(docs, text)
    found = repeated(docs, length, gram, text).withColumnsRenamed({"doc_id": "i", "mark": "m"})
    rows = keyed.join(found, keyed.doc_id.eqNullSafe(found.i) & (keyed.mark == found.m), "left").select("doc_id", "__text", "spans")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for part in slices(batches, "__text"):
            data, offsets = flat(part.column("__text"))
            raw = data.tobytes()
            runs = [merged(s) for s in part.column("spans").to_pylist()]
            kept = []
            for i, own in enumerate(runs):
                s, at, bits = raw[offsets[i] : offsets[i + 1]], 0, []
                for a, b in own:
                    bits.append(s[at:a])
                    at = b
                kept.append(b"".join([*bits, s[at:]]))
            spans = [[{"start": a, "end": b} for a, b in own] for own in runs]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    schema = keyed.select("doc_id").withColumns({"n_bytes": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<start:long,end:long>>"), "kept": F.lit(b"").cast("binary")}).schema
    return rows.mapInArrow(run, schema)
