"""SimHash near-duplicates with pivot distance tables.

1. One narrow pass makes a 64-bit fingerprint per document.
2. Equal fingerprints are folded first, so a group of copies of any size is
   one row.  Each distinct fingerprint carries its Hamming distances to many
   fixed reference fingerprints (its pivot table row).
3. Fingerprints meet in buckets of two equal segments out of six (two
   fingerprints at distance 4 or less differ in at most four segments, so they
   share a bucket for certain).  In a bucket a pair is discarded when any
   coordinate of the two pivot rows differs by more than the maximum distance
   (the triangle inequality), and survivors are verified on all bits.
4. A bucket returns a spanning forest of its links, never all pairs; a bucket
   above ``BLOCK`` rows is cut into blocks and each pair of blocks is one
   group, so no task holds more than two blocks.
5. Components come from star rounds over the links (``components``).

Defined cases: null text = empty text = no words = fingerprint 0, linked like
any other; fewer words than a shingle: the whole sequence is the one shingle;
repeated rows share their component; a null doc_id never is a component id
unless all ids of a component are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.components import components
from quarry.llm.ragged import LOWER, NOT_BLANK, flat, slices, words
from quarry.session import cut_lineage

SEED = 42
#: Reference fingerprints of the pivot table (fixed, pseudo-random).
PIVOTS = np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, 0) for i in range(24)], np.uint64)
#: Shingles whose bits are counted at once.
_SHINGLES = 1 << 17
#: Rows of one bucket that a task compares at once.
BLOCK = 8192


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a long) of every row."""
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    schema = chosen.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for part in slices(batches, "__text"):
            fp = simhash(*flat(part.column("__text")), shingle)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(fp.view(np.int64))], [*keep, "fp"])

    return chosen.mapInArrow(run, schema)


def simhash(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    data = LOWER[data]
    starts, ends, text, bounds = words(data, offsets, NOT_BLANK)
    n, texts = len(starts), len(offsets) - 1
    if not n:
        return np.zeros(texts, np.uint64)
    # words joined by one blank each, in one buffer
    size = ends - starts
    to = np.cumsum(size + 1) - size - 1
    joined = np.full(int(to[-1] + size[-1] + 1), 0x20, np.uint8)
    inside = NOT_BLANK[data]
    joined[np.repeat(to - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))] = data[inside]
    raw = joined.tobytes()
    last = np.minimum(np.arange(n) + shingle - 1, bounds[text + 1] - 1)
    whole = np.arange(n) + shingle <= bounds[text + 1]
    first = whole | (np.arange(n) == bounds[text])  # a short text is one shingle
    at, stop, owner = to[first], (to + size)[last[first]], text[first]
    number = np.bincount(owner, minlength=texts)
    ones = np.zeros((texts, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(at), _SHINGLES):
        own = owner[i : i + _SHINGLES]
        spans = zip(at[i : i + _SHINGLES].tolist(), stop[i : i + _SHINGLES].tolist(), strict=True)
        h = np.fromiter((digest(raw[a:b], SEED) for a, b in spans), np.uint64, len(own))
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    major = np.packbits(2 * ones > number[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(major).view(np.uint64).ravel()


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances to every reference fingerprint (rows x pivots)."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS).astype(np.int8)


def _near(fp, table, i, j, distance):
    """Which of the index pairs survive the pivot table, then all bits."""
    for p in range(table.shape[1]):
        ok = np.abs(table[i, p] - table[j, p]) <= distance
        if not ok.all():
            i, j = i[ok], j[ok]
    ok = np.bitwise_count(fp[i] ^ fp[j]) <= distance
    return i[ok], j[ok]


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each component of one bucket: every fingerprint is
    compared with those not reached yet."""
    table = pivot_table(fp)
    rest = np.arange(len(fp))
    a, b, queue = [], [], []
    while len(rest) > 1 or (queue and len(rest)):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
        at = queue.pop()
        near = np.abs(table[rest, 0] - table[at, 0]) <= distance
        near[near] = (np.abs(table[rest[near]] - table[at]) <= distance).all(axis=1)
        near[near] = np.bitwise_count(fp[rest[near]] ^ fp[at]) <= distance
        found = rest[near]
        if len(found):
            a.append(np.full(len(found), at))
            b.append(found)
            queue.extend(found.tolist())
            rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


#: Runs up to this length are compared by shifting the whole batch.
_SHORT = 24


def _bucket_links(bucket: np.ndarray, fp: np.ndarray, distance: int):
    """Links of all buckets of one batch sorted by bucket."""
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(begin, len(bucket)))
    a, b = [], []
    short = np.repeat((size > 1) & (size <= _SHORT), size)
    if short.any():
        f, k = fp[short], bucket[short]
        table = pivot_table(f)
        for d in range(1, _SHORT):
            i = np.flatnonzero(k[:-d] == k[d:]) if len(k) > d else np.zeros(0, int)
            if not len(i):
                break
            i, j = _near(f, table, i, i + d, distance)
            a.append(f[i])
            b.append(f[j])
    for s, n in zip(begin[size > _SHORT].tolist(), size[size > _SHORT].tolist(), strict=True):
        own = np.unique(fp[s : s + n])
        i, j = forest(own, distance)
        a.append(own[i])
        b.append(own[j])
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def links(distinct: DataFrame, distance: int = 4, segments: int = 6) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join every pair
    within ``distance`` bits, directly or through others of the same bucket."""
    equal = segments - distance
    if equal < 1:
        raise ValueError("more segments than differing bits are needed")
    bounds = np.linspace(0, 64, segments + 1).astype(int).tolist()

    def mask(chosen):
        m = sum(((1 << (bounds[s + 1] - bounds[s])) - 1) << bounds[s] for s in chosen)
        return m - (1 << 64) if m >= 1 << 63 else m

    from itertools import combinations

    masks = [mask(c) for c in combinations(range(segments), equal)]
    buckets = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)]))
    rows = distinct.select("fp", buckets.alias("k")).select("fp", F.xxhash64("k.c", "k.v").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > BLOCK).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    # a row of block i of a large bucket belongs to the groups (min(i, j), max(i, j))
    spread = rows.join(large, "bucket").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    spread = spread.select("fp", "bucket", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    spread = spread.select("fp", F.xxhash64("bucket", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"))
    normal = rows.join(large.select("bucket"), "bucket", "left_anti").select("fp", "bucket")
    met = normal.union(spread).repartition("bucket").sortWithinPartitions("bucket", "fp")

    def run(batches):
        held_b, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            bucket = np.concatenate([held_b, batch.column("bucket").to_numpy()])
            fp = np.concatenate([held_f, batch.column("fp").to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0  # the last bucket may go on
            yield from _linked(bucket[:cut], fp[:cut], distance)
            held_b, held_f = bucket[cut:], fp[cut:]
        yield from _linked(held_b, held_f, distance)

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return met.select("bucket", "fp").mapInArrow(run, schema)


def _linked(bucket, fp, distance):
    if len(bucket):
        a, b = _bucket_links(bucket, fp, distance)
        if len(a):
            pairs = np.unique(np.stack([a.view(np.int64), b.view(np.int64)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text") -> DataFrame:
    """doc_id, fp (long) and component_id of every row of ``docs``."""
    marked = cut_lineage(fingerprints(docs, shingle, text))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    joined = components(links(distinct.select("fp"), distance))
    roots = distinct.join(joined, distinct.fp == joined.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    # written, so that the join below reads both sides from plain exchanges and a hot root can be split
    lowest = cut_lineage(roots.groupBy("root").agg(F.min("low").alias("component_id")))
    named = roots.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
