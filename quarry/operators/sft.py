"""Token-level training data: SFT samples with loss labels, prefix-masked
labels, batch padding, packed next-token windows, history truncation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.draw import draw
from quarry.functions.jsonfmt import let

IGNORE = -100


def occurrences(ids: Column, n: Column, pattern: list) -> Column:
    """Every place (from 0) where ``pattern`` starts in ``ids`` of ``n`` entries."""
    here = lambda i: reduce(and_, (F.get(ids, i + k) == F.lit(int(v)) for k, v in enumerate(pattern)))
    some = F.filter(F.sequence(F.lit(0), F.greatest(n - len(pattern), F.lit(0))), here)
    return F.when(n >= len(pattern), some).otherwise(F.array().cast("array<int>"))


def answer_spans(ids: Column, n: Column, header: list, boundary: list, max_length: int) -> Column:
    """(start, end) of each assistant answer: from after a header through the
    next boundary, or to the end; a header inside an answer opens none.

    One fold from the right gives every header its next boundary, one from the
    left keeps the headers outside answers."""
    # a header counts by the place after it; of ties the boundary comes first from the right
    heads = F.transform(occurrences(ids, n, header), lambda i: F.struct((i + len(header)).alias("at"), F.lit(0).alias("end")))
    ends = F.transform(occurrences(ids, n, boundary), lambda i: F.struct(i.alias("at"), F.lit(1).alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def next_end(acc, e):
        met = F.array(F.struct(e["at"].alias("start"), acc["next"].alias("end")))
        return F.when(e["end"] == 1, F.struct(e["at"].alias("next"), acc["heads"].alias("heads"))).otherwise(F.struct(acc["next"].alias("next"), F.concat(met, acc["heads"]).alias("heads")))

    def outside(acc, h):
        end = F.when(h["end"].isNull(), F.greatest(n, h["start"])).otherwise(F.greatest(h["start"], F.least(h["end"] + len(boundary), F.lit(max_length))))
        opened = F.struct(end.alias("free"), F.concat(acc["spans"], F.array(F.struct(h["start"].alias("start"), end.alias("end")))).alias("spans"))
        return F.when(h["start"] - len(header) >= acc["free"], opened).otherwise(acc)

    from_right = F.aggregate(F.reverse(F.array_sort(F.concat(ends, heads))), F.struct(F.lit(None).cast("int").alias("next"), none.alias("heads")), next_end, lambda acc: acc["heads"])
    return F.aggregate(from_right, F.struct(F.lit(0).alias("free"), none.alias("spans")), outside, lambda acc: acc["spans"])


def labels_column(ids: Column, header: list, boundary: list, max_length: int, pad_id: int, label_eos: bool = False) -> Column:
    """Labels are the ids inside the answers, else -100.  Pad positions (pad =
    EOS id) are never targets unless ``label_eos``.  Native: the answers become
    one array of flags as long as the ids."""
    header, boundary = list(header), list(boundary)
    if not header or not boundary:
        raise ValueError("header and boundary must not be empty")

    def flags(spans, n):
        def stretch(s, j):
            before = F.coalesce(F.get(spans, j - 1)["end"], F.lit(0))
            return F.concat(F.array_repeat(F.lit(False), s["start"] - before), F.array_repeat(F.lit(True), F.least(s["end"], n) - F.least(s["start"], n)))

        end = F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0))
        return F.concat(F.flatten(F.transform(spans, stretch)), F.array_repeat(F.lit(False), n - end))

    def labelled(a):
        n = F.size(a)
        chosen = let(answer_spans(a, n, header, boundary, max_length), lambda spans: flags(spans, n))
        return F.zip_with(a, chosen, lambda x, inside: F.when(inside & (F.lit(label_eos) | (x != pad_id)), x).otherwise(F.lit(IGNORE)))

    return F.when(ids.isNotNull(), let(ids, labelled))


def pad_truncate(ids: Column, max_length: int, pad_id: int) -> Column:
    """``ids[:max_length]`` right-padded with ``pad_id`` to ``max_length``."""
    cut = F.slice(ids, 1, max_length)
    return F.concat(cut, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(0), F.lit(max_length) - F.size(cut))))


def prefix_labels(full: Column, prefix_len: Column, max_length: int) -> Column:
    """-100 for the first ``prefix_len`` positions, then the ids; cut to
    ``max_length`` (no check that the prefix really matches)."""
    lab = F.concat(F.array_repeat(F.lit(IGNORE), prefix_len), F.slice(full, prefix_len + 1, F.greatest(F.size(full) - prefix_len, F.lit(0))))
    return F.slice(lab, 1, max_length)


def target_weight(labels: Column) -> Column:
    """Number of next-token targets: labels[1:] that are not -100."""
    return F.size(F.filter(F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: x != IGNORE))


def pad_batches(df: DataFrame, order: str, batch_size: int, pad_id: int, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Batch = floor(index / B) in ``order`` (a dense 0-based index column);
    pad ids with ``pad_id`` and labels with -100 to the batch maximum, plus a
    boolean attention mask.  Batches are bounded by B, so the window per batch
    never holds more than B rows."""
    b = df.withColumn("batch_id", F.floor(F.col(order) / batch_size))
    mx = F.max(F.size(ids)).over(W.partitionBy("batch_id"))
    b = b.withColumn("_mx", mx).withColumn("_pad", F.col("_mx") - F.size(ids))
    return b.select(
        "*",
        F.concat(F.col(ids), F.array_repeat(F.lit(pad_id), F.col("_pad"))).alias("padded_ids"),
        F.concat(F.col(labels), F.array_repeat(F.lit(IGNORE), F.col("_pad"))).alias("padded_labels"),
        F.concat(F.array_repeat(F.lit(True), F.size(ids)), F.array_repeat(F.lit(False), F.col("_pad"))).alias("attention_mask"),
    ).drop("_mx", "_pad")


#: Rows that one window partition of :func:`prefix_sums` should hold.
BUCKET_ROWS = 4096


def prefix_sums(df: DataFrame, order: str, value: str, bucket_width: int | None = None, name: str = "offset") -> DataFrame:
    """Exclusive running sum of ``value`` in ``order`` (a numeric key) without
    a single-partition window.

    Rows are ranged into buckets of about ``BUCKET_ROWS`` rows, whatever the
    density of the keys (the width comes from their range and number unless it
    is given), and buckets into groups of as many.  Each level sums inside its
    own partitions; one row for ``BUCKET_ROWS`` squared rows meets in one place."""
    if bucket_width is None:
        low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
        bucket_width = min(2**62, max(1, -(-(int(high) - int(low) + 1) * BUCKET_ROWS // int(n)))) if n else 1

    def before(frame, by, keys, v, out):
        w = W.partitionBy(*keys).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return frame.withColumn(out, F.coalesce(F.sum(v).over(w), F.lit(0)))

    x = df.withColumn("_b", F.floor(F.col(order) / bucket_width))
    fine = x.groupBy("_b").agg(F.sum(value).alias("_t")).withColumn("_c", F.floor(F.col("_b") / BUCKET_ROWS))
    coarse = before(fine.groupBy("_c").agg(F.sum("_t").alias("_ct")), "_c", [], "_ct", "_co").select("_c", "_co")
    fine = before(fine, "_b", ["_c"], "_t", "_bo").join(coarse, "_c").select("_b", (F.col("_bo") + F.col("_co")).alias("_bo"))
    x = before(x, order, ["_b"], value, "_in")
    return x.join(fine, "_b").withColumn(name, (F.col("_bo") + F.col("_in")).cast("bigint")).drop("_b", "_bo", "_in")


def pack_windows(docs: DataFrame, order: str, ids: str, length: int, bucket_width: int | None = None) -> DataFrame:
    """Concatenate all token ids in ``order`` and cut them into windows:
    ``x = t[wL : wL+L]``, ``y = t[wL+1 : wL+L+1]`` for every window with a full
    ``y`` (window w needs the L + 1 tokens at positions wL .. wL+L).

    Each document emits one *slice* per window it overlaps (about n/L + 2
    rows, not one row per token); the regrouping by window is the only
    data-sized shuffle and every group holds at most L + 1 tokens."""
    L = length
    g = token_blocks(docs, order, ids, L, 1, bucket_width).filter(F.size("tokens") == L + 1)
    return g.select(F.col("block").alias("window"), F.slice("tokens", 1, L).alias("x"), F.slice("tokens", 2, L).alias("y"))


def token_blocks(docs: DataFrame, order: str, ids: str, width: int, more: int = 0, bucket_width: int | None = None) -> DataFrame:
    """All token ids in ``order``, cut into blocks of ``width``: ``(block,
    tokens)``, each with up to ``more`` tokens of the next block."""
    d = docs.withColumn("_n", F.size(ids))
    d = prefix_sums(d, order, "_n", bucket_width, "_off").filter(F.col("_n") > 0)
    off, n = F.col("_off"), F.col("_n")
    first = F.greatest(F.floor((off - more) / width), F.lit(0))
    last_one = F.floor((off + n - 1) / width)

    def piece(w):
        lo = F.greatest(w * width, off)
        hi = F.least(w * width + width + more - 1, off + n - 1)
        return F.struct(w.alias("block"), lo.alias("start"),
                        F.slice(F.col(ids), (lo - off + 1).cast("int"), F.greatest(hi - lo + 1, F.lit(0)).cast("int")).alias("piece"))

    # slices are cut inside the array, so exploded rows carry only their slice
    pieces = d.select(F.explode(F.transform(F.sequence(first, last_one), piece)).alias("p")).select("p.*")
    pieces = pieces.filter(F.size("piece") > 0)
    g = pieces.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("_p"))
    return g.select("block", F.flatten(F.transform("_p", lambda s: s["piece"])).alias("tokens"))


def sampled_windows(docs: DataFrame, order: str, ids: str, length: int, samples: DataFrame, seed: int, bucket_width: int | None = None) -> DataFrame:
    """Next-token windows at random starts: for each row of ``samples`` (column
    ``sample``) a start i drawn uniformly from [0, n - L - 1] of all n tokens in
    ``order``, ``x = t[i : i+L]`` and ``y = t[i+1 : i+L+1]``.  None if there are
    fewer than L + 1 tokens.

    Only the places of documents meet the windows, by blocks of places; each
    document's ids then meet its own windows and are cut there, so no token
    outside a window leaves its row and memory follows the longest document."""
    L, width = length, 4 * (length + 1)
    # rows are told apart by key and digest; copies of a row have the same tokens
    own = docs.select(F.col(order).alias("_key"), F.xxhash64(ids).alias("_hash"), F.col(ids).alias("_ids"))
    total = docs.agg(F.sum(F.size(ids)).cast("long").alias("n")).scalar()
    starts = samples.select("sample", F.pmod(draw(seed, F.col("sample"), "window"), F.nullif(F.greatest(total - L, F.lit(0)), F.lit(0))).alias("start"))
    starts = starts.filter(F.col("start").isNotNull())

    def over(first, last_one):  # the blocks of a stretch
        return F.explode(F.sequence(F.floor(first / width), F.floor(last_one / width))).alias("block")

    sizes = own.select("_key", "_hash", F.size("_ids").alias("_n"))
    off, end = F.col("_off"), F.col("_off") + F.col("_n") - 1
    places = prefix_sums(sizes, "_key", "_n", bucket_width, "_off").filter(F.col("_n") > 0).select("_key", "_hash", "_n", "_off", over(off, end))
    start, stop = F.col("start"), F.col("start") + L
    met = starts.select("start").distinct().select("start", over(start, stop)).join(places, "block")
    # both may lie in several blocks: the first that they share counts
    met = met.filter((off <= stop) & (end >= start) & (F.col("block") == F.floor(F.greatest(off, start) / width)))
    low = F.greatest(off, start)
    cuts = met.select("_key", "_hash", "start", low.alias("low"), (low - off + 1).cast("int").alias("at"), (F.least(end, stop) - low + 1).cast("int").alias("n"))
    pieces = own.join(cuts.hint("shuffle_hash"), ["_key", "_hash"]).select("start", F.struct("low", F.slice("_ids", F.col("at"), F.col("n")).alias("piece")).alias("p"))
    tokens = pieces.groupBy("start").agg(F.sort_array(F.collect_set("p")).alias("_p")).select("start", F.flatten(F.transform("_p", lambda p: p["piece"])).alias("tokens"))
    return starts.join(tokens, "start").select("sample", "start", F.slice("tokens", 1, L).alias("x"), F.slice("tokens", 2, L).alias("y"))


def last(values: Column, n: Column) -> Column:
    """The last ``n`` entries of an array (left cut)."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def truncate_history(turn_tokens: Column, system_tokens: Column, fixed_tokens: int, budget: int) -> Column:
    """Number of dialogue turns kept: the longest suffix whose tokens plus the
    system prompt and the fixed generation marker fit ``budget`` (per-turn
    counts add up because a rendered turn always ends with a newline).  One
    fold from the end, which stops counting at the first turn that is too much."""
    start = F.struct(system_tokens.cast("long").alias("used"), F.lit(0).alias("kept"), F.lit(True).alias("open"))

    def step(acc, t):
        used = acc["used"] + t
        fits = acc["open"] & (used + fixed_tokens <= budget)
        return F.struct(used.alias("used"), F.when(fits, acc["kept"] + 1).otherwise(acc["kept"]).alias("kept"), fits.alias("open"))

    return F.aggregate(F.reverse(F.transform(turn_tokens, lambda t: t.cast("long"))), start, step, lambda acc: acc["kept"])
