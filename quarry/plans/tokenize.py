"""Tokenizer and token-level training-data queries.

Pre-tokens, pair counts and the round trip have oracle SQL.  Training has none:
a recursive query would count all pairs of all words anew for each of 6,143
merges.  What rests on the merges is checked by unit tests against brute-force
implementations.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.draw import draw, draw_sql
from quarry.operators import bpe
from quarry.operators import chat as ch
from quarry.operators import sft
from quarry.operators.clean import dedup_exact, with_text
from quarry.operators.sample import global_index
from quarry.plans.chat import normalized as conv_normalized
from quarry.plans.corpus import annotated
from quarry.session import cut_lineage
from quarry.sources.tables import read_table

EOS = ch.EOS_TOKEN
SPECIALS = [EOS]
VOCAB_SIZE = 6400  # 256 bytes, 6,143 merges and the special token
MAX_LENGTH = 512
WINDOW = 64
CONTEXT, MAX_NEW = 256, 64
SEED = 42

_MODELS: dict = {}


def corpus(spark, sf_dir):
    """Kept, cleaned documents; each ends with a newline as in the tokenizer
    corpus file (per-document pre-tokenization then equals whole-file)."""
    # cleaned once: the keys of the dedup and the texts are read from one checkpoint
    a = cut_lineage(annotated(spark, sf_dir).select("doc_id", "doc_hash", "drop_reason", "split", "n_chars", "text_clean"))
    return with_text(dedup_exact(a), a).select("doc_id", "doc_hash", "split", F.concat(F.col("text_clean"), F.lit("\n")).alias("text"))


def model(spark, sf_dir, docs=None):
    """Trained (vocab, merges) for this table set, kept while the application
    runs and the files of the table stay the same.  ``docs``: its corpus, if
    that is at hand."""
    files = read_table(spark, sf_dir, "documents").select("_metadata.*")
    state = files.agg(F.max("file_modification_time"), F.max("file_size"), F.count(F.lit(1))).first()
    key = (spark.sparkContext.applicationId, sf_dir, VOCAB_SIZE, tuple(state))
    if key not in _MODELS:
        counts = bpe.pretoken_counts(corpus(spark, sf_dir) if docs is None else docs, "text", SPECIALS)
        _MODELS[key] = bpe.train_bpe(counts, VOCAB_SIZE, SPECIALS)
    return _MODELS[key]


def byte_model(spark, sf_dir, docs=None):
    """The vocabulary before any merge: 256 bytes and the special token.  With
    it every token-level result has SQL."""
    vocab = {b: bytes([b]) for b in range(256)} | {256 + i: s.encode() for i, s in enumerate(SPECIALS)}
    return vocab, []


def id_hash(ids):
    """A digest of an id array, so that results show the ids themselves."""
    return F.sha2(F.array_join(ids, ","), 256)


def q_pretoken_counts(spark, sf_dir):
    return bpe.pretoken_counts(corpus(spark, sf_dir), "text", SPECIALS)


def q_pair_counts(spark, sf_dir):
    words = q_pretoken_counts(spark, sf_dir).select(bpe.byte_symbols(F.col("token")).alias("syms"), F.col("count").alias("freq"))
    return bpe.pair_counts(words).select(F.hex("left").alias("left"), F.hex("right").alias("right"), "freq")


def q_bpe_train(spark, sf_dir):
    _, merges = model(spark, sf_dir)
    return bpe.merges_frame(spark, merges).select("rank", F.hex("left").alias("left"), F.hex("right").alias("right"), "line")


def q_bpe_vocab(spark, sf_dir):
    vocab, _ = model(spark, sf_dir)
    return bpe.vocab_frame(spark, vocab, SPECIALS).select("id", "text", "is_special")


def encoded(spark, sf_dir, trained=model, returned=None):
    """Documents with their ids and the columns ``returned`` (all)."""
    docs = corpus(spark, sf_dir)
    vocab, merges = trained(spark, sf_dir, docs)
    # rows that are copies of each other count together, as they always have: each has
    # every pre-token once for each copy (the join of the texts left them side by side)
    copies = docs.withColumn("copies", F.count(F.lit(1)).over(W.partitionBy("doc_id", "doc_hash")))
    return bpe.encode_texts(copies, "text", ["doc_id"], vocab, merges, SPECIALS, times="copies", returned=returned)


def q_corpus_encode(spark, sf_dir, trained=model):
    e = encoded(spark, sf_dir, trained)
    return e.select("doc_id", "split", F.size("ids").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_hash"))


def q_token_stats(spark, sf_dir, trained=model):
    """Needs no ids per document: the distinct pre-tokens of a split, their
    numbers and their ids say it all."""
    c = corpus(spark, sf_dir)
    vocab, merges = trained(spark, sf_dir, c)
    counts = bpe.pretoken_counts(c, "text", SPECIALS, by=("split",), with_specials=True)
    t = bpe.coded_tokens(counts, vocab, merges, SPECIALS).groupBy("split").agg(
        F.sum(F.col("count") * F.size("ids")).alias("num_tokens"), F.max(F.array_max("ids")).alias("max_token_id"))
    return c.groupBy("split").agg(F.count(F.lit(1)).alias("documents")).join(t, "split", "left").withColumn("vocab_size", F.lit(len(vocab)))


def q_roundtrip(spark, sf_dir, trained=model):
    e = encoded(spark, sf_dir, trained)
    vocab, _ = trained(spark, sf_dir)
    e = e.withColumn("decoded", bpe.decode_column(spark, F.col("ids"), vocab))
    return e.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("decoded") != F.col("text")).alias("mismatches"))


def q_clip_ids(spark, sf_dir, trained=model):
    e = encoded(spark, sf_dir, trained)
    limit = len(trained(spark, sf_dir)[0]) * 3 // 4  # a model with fewer embeddings
    return e.select("doc_id", F.size("ids").alias("n_tokens"), F.size(ch.clip_ids(F.col("ids"), limit)).alias("n_kept"), id_hash(ch.clip_ids(F.col("ids"), limit)).alias("ids_hash"))


def sft_samples(spark, sf_dir, trained=model):
    vocab, merges = trained(spark, sf_dir)
    enc = bpe.Encoder(vocab, merges, SPECIALS)
    header = enc.encode(ch.ROLE_MARKERS["assistant"])
    boundary = enc.encode(EOS + "\n")
    pad = enc.ids[EOS.encode("utf-8")]
    n = conv_normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    r = n.withColumn("rendered", ch.render_chat(F.col("conversations")))
    r = r.withColumn("_ids", bpe.encode_column(spark, F.col("rendered"), vocab, merges, SPECIALS))
    r = r.withColumn("input_ids", sft.pad_truncate(F.col("_ids"), MAX_LENGTH, pad))
    return r.withColumn("labels", sft.labels_column(F.col("input_ids"), header, boundary, MAX_LENGTH, pad)), pad


def q_sft_labels(spark, sf_dir, trained=model):
    s, _ = sft_samples(spark, sf_dir, trained)
    return s.select("conv_id", F.size("_ids").alias("n_tokens"), F.size("input_ids").alias("length"), id_hash("labels").alias("labels_hash"),
                    F.size(F.filter("labels", lambda x: x != sft.IGNORE)).alias("n_labelled"),
                    sft.target_weight(F.col("labels")).alias("target_weight"))


def q_prefix_labels(spark, sf_dir, trained=model):
    vocab, merges = trained(spark, sf_dir)
    n = conv_normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    n = n.filter(F.try_element_at("conversations", F.lit(-1))["role"] == "assistant")
    conv = F.col("conversations")
    prefix = F.slice(conv, 1, F.size(conv) - 1)
    d = n.select("conv_id",
                 bpe.encode_column(spark, ch.render_chat(conv), vocab, merges, SPECIALS).alias("full"),
                 bpe.encode_column(spark, ch.render_chat(prefix, generation=True), vocab, merges, SPECIALS).alias("prefix"))
    d = d.filter(F.size("full") >= 2)
    lab = sft.prefix_labels(F.col("full"), F.size("prefix"), MAX_LENGTH)
    return d.select("conv_id", F.size(F.slice("full", 1, MAX_LENGTH)).alias("n_input"), F.size(F.filter(lab, lambda x: x != sft.IGNORE)).alias("n_labelled"))


def q_pad_batches(spark, sf_dir, trained=model):
    s, pad = sft_samples(spark, sf_dir, trained)
    s = s.select("conv_id", F.slice("_ids", 1, MAX_LENGTH).alias("input_ids"), F.slice("labels", 1, F.least(F.size("_ids"), F.lit(MAX_LENGTH))).alias("labels"))
    s = s.withColumn("_d", draw(SEED, F.col("conv_id"), "batch"))
    idx = global_index(s, [], "_d", [F.col("conv_id")], "idx")
    b = sft.pad_batches(idx, "idx", 4, pad)
    return b.select("conv_id", "batch_id", F.size("padded_ids").alias("padded_len"), id_hash("padded_ids").alias("ids_hash"),
                    id_hash("padded_labels").alias("labels_hash"), F.size(F.filter("attention_mask", lambda x: x)).alias("n_real"))


def q_packed_windows(spark, sf_dir, trained=model):
    # encoded once; offsets and slices both read the written ids, of both splits
    e = cut_lineage(encoded(spark, sf_dir, trained).select("doc_id", "split", "ids"))
    parts = [sft.pack_windows(e.filter(F.col("split") == s), "doc_id", "ids", WINDOW).withColumn("split", F.lit(s)) for s in ("train", "valid")]
    w = parts[0].union(parts[1])
    return w.select("split", "window", id_hash("x").alias("x_hash"), id_hash("y").alias("y_hash"), F.size("x").alias("n"), F.try_element_at("x", F.lit(1)).alias("x_first"),
                    F.try_element_at("y", F.lit(1)).alias("y_first"),
                    F.forall(F.arrays_zip(F.slice("x", 2, WINDOW - 1).alias("a"), F.slice("y", 1, WINDOW - 1).alias("b")),
                             lambda z: z["a"] == z["b"]).alias("shift_ok"))


def q_sampled_windows(spark, sf_dir, trained=model):
    """As many windows as a split has documents, at random starts."""
    e = cut_lineage(encoded(spark, sf_dir, trained, ["doc_id", "split"]).select("doc_id", "split", "ids"))
    out = []
    for s in ("train", "valid"):
        own = e.filter(F.col("split") == s)
        samples = own.select(F.col("doc_id").alias("sample"))
        w = sft.sampled_windows(own.select("doc_id", "ids"), "doc_id", "ids", WINDOW, samples, SEED)
        out.append(w.select(F.lit(s).alias("split"), "sample", "start", id_hash("x").alias("x_hash"), id_hash("y").alias("y_hash")))
    return out[0].union(out[1])


def q_history_truncate(spark, sf_dir, trained=model):
    """Chat-history truncation: keep the system turn, then the longest suffix
    of dialogue turns whose tokens fit ``context - max_new - 16``; hard cut of
    the prompt to ``context - max_new`` tokens."""
    vocab, merges = trained(spark, sf_dir)
    n = conv_normalized(spark, sf_dir).filter(F.col("invalid_reason").isNull())
    conv = F.col("conversations")
    has_sys = F.try_element_at(conv, F.lit(1))["role"] == "system"
    system = F.when(has_sys, F.slice(conv, 1, 1)).otherwise(F.array().cast(f"array<{ch.TURN}>"))
    dialogue = F.when(has_sys, F.slice(conv, 2, F.greatest(F.size(conv) - 1, F.lit(1)))).otherwise(conv)
    pieces = F.concat(F.array(ch.render_chat(system)), F.transform(dialogue, lambda t: ch.render_chat(F.array(t))),
                      F.array(F.lit(ch.ROLE_MARKERS["assistant"])))
    d = n.select("conv_id", system.alias("system"), dialogue.alias("dialogue"), bpe.token_counts_column(spark, pieces, vocab, merges, SPECIALS).alias("c"))
    m = F.size("c")
    fixed = F.element_at("c", 1) + F.element_at("c", -1)
    turns = F.slice("c", 2, F.greatest(m - 2, F.lit(0)))
    budget = CONTEXT - MAX_NEW - 16
    d = d.withColumn("kept_turns", sft.truncate_history(turns, fixed, 0, budget))
    kept = F.concat("system", sft.last(F.col("dialogue"), F.col("kept_turns")))
    d = d.withColumn("kept", kept).withColumn("ids", bpe.encode_column(spark, ch.render_chat(F.col("kept"), generation=True), vocab, merges, SPECIALS))
    prompt = sft.last(F.col("ids"), F.least(F.size("ids"), F.lit(CONTEXT - MAX_NEW)))
    return d.select("conv_id", F.size("dialogue").alias("n_turns"), "kept_turns", F.size(prompt).alias("prompt_tokens"), id_hash(prompt).alias("ids_hash"),
                    F.sha2(F.array_join(F.transform("kept", lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\n"), 256).alias("kept_hash"))


QUERIES = {
    "pretoken_counts": q_pretoken_counts,
    "pair_counts": q_pair_counts,
    "bpe_train": q_bpe_train,
    "bpe_vocab": q_bpe_vocab,
    "corpus_encode": q_corpus_encode,
    "token_stats": q_token_stats,
    "roundtrip": q_roundtrip,
    "clip_ids": q_clip_ids,
    "sft_labels": q_sft_labels,
    "prefix_labels": q_prefix_labels,
    "pad_batches": q_pad_batches,
    "packed_windows": q_packed_windows,
    "sampled_windows": q_sampled_windows,
    "history_truncate": q_history_truncate,
}
#: The same queries over the vocabulary without merges.
BYTES = ("corpus_encode", "token_stats", "clip_ids", "sft_labels", "prefix_labels", "pad_batches", "packed_windows", "sampled_windows", "history_truncate")
QUERIES |= {f"byte_{name}": partial(QUERIES[name], trained=byte_model) for name in BYTES}


def _pretokens_sql() -> str:
    """The pre-tokens in RE2, which has no look-ahead: a marker goes before the
    last blank of every run of blanks that text follows, the text is split
    there, and the pattern without its look-ahead cuts the pieces."""
    from quarry.plans.corpus import annotated_sql

    blank = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    mark = "chr(57344)"
    cut = rf"''(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{blank}\p{{L}}\p{{N}}]+|[{blank}]+"
    return rf"""{annotated_sql()},
piece AS (SELECT unnest(string_split(text_clean || chr(10), '{EOS}')) AS s FROM kept),
seg AS (SELECT unnest(string_split(regexp_replace(s, '([{blank}]+)([{blank}])([^{blank}])', '\1' || {mark} || '\2\3', 'g'), {mark})) AS s FROM piece),
token AS (SELECT unnest(regexp_extract_all(s, '{cut}')) AS token FROM seg),
words AS (SELECT token, count(*) AS count FROM token WHERE length(token) > 0 GROUP BY token)"""


def _byte_sql() -> dict:
    """Token-level results over the vocabulary of bytes (EOS: id 256)."""
    from quarry.plans.chat import CONV_SQL, MARKER_SQL
    from quarry.plans.corpus import annotated_sql

    def ids(text: str) -> str:
        one = "list_transform(regexp_extract_all(hex(encode(p)), '..'), lambda h: ('0x' || h)::INTEGER)"
        return f"list_reduce(list_transform(string_split({text}, '{EOS}'), lambda p: {one}), lambda a, b: a || [256] || b)"

    def hashed(x: str) -> str:
        return f"sha256(array_to_string({x}, ','))"

    def rendered(turns: str) -> str:
        return f"array_to_string(list_transform({turns}, lambda x: {MARKER_SQL} || x.content || chr(10) || CASE WHEN x.role = 'assistant' THEN '{EOS}' || chr(10) ELSE '' END), '')"

    head = ch.ROLE_MARKERS["assistant"].encode()
    marker = f"'{ch.ROLE_MARKERS['assistant'].rstrip(chr(10))}' || chr(10)"
    docs = f"""{annotated_sql()},
e AS (SELECT doc_id, split, {ids("text_clean || chr(10)")} AS ids FROM kept)"""
    # a place is labelled if a header ends before it and the next boundary after
    # that header has not ended: headers of a rendered chat never lie in answers
    samples = f"""{CONV_SQL},
s0 AS (SELECT conv_id, {ids('body')} AS all_ids FROM rendered WHERE invalid_reason IS NULL),
s AS (SELECT *, list_resize(all_ids[1:{MAX_LENGTH}], {MAX_LENGTH}, 256) AS input_ids FROM s0),
places AS (SELECT conv_id, unnest(range(1, {MAX_LENGTH} + 1)) AS i, unnest(input_ids) AS id, input_ids FROM s),
heads AS (SELECT conv_id, i + {len(head)} AS a FROM places WHERE id = {head[0]} AND input_ids[i:i + {len(head) - 1}] = {list(head)}),
ends AS (SELECT conv_id, i AS e FROM places WHERE id = 256 AND input_ids[i + 1] = 10),
spans AS (SELECT h.conv_id, a, coalesce(min(e) + 2, {MAX_LENGTH} + 1) AS z FROM heads AS h LEFT JOIN ends ON ends.conv_id = h.conv_id AND e >= a GROUP BY h.conv_id, a),
flags AS (SELECT p.conv_id, p.i, any_value(p.id) AS id, count(a) > 0 AS inside FROM places AS p LEFT JOIN spans ON spans.conv_id = p.conv_id AND p.i >= a AND p.i < z GROUP BY p.conv_id, p.i),
labelled AS (SELECT conv_id, list(CASE WHEN inside AND id <> 256 THEN id ELSE -100 END ORDER BY i) AS labels FROM flags GROUP BY conv_id),
samples AS (SELECT s.*, labels FROM s JOIN labelled USING (conv_id))"""
    used = CONTEXT - MAX_NEW - 16
    return {
        "corpus_encode": f"WITH {docs} SELECT doc_id, split, len(ids)::INTEGER AS n_tokens, {hashed('ids')} AS ids_hash FROM e",
        "token_stats": f"WITH {docs} SELECT split, count(*) AS documents, sum(len(ids))::BIGINT AS num_tokens, max(list_max(ids)) AS max_token_id, 257 AS vocab_size FROM e GROUP BY split",
        "clip_ids": f"""WITH {docs}, c AS (SELECT doc_id, ids, list_filter(ids, lambda x: x < {257 * 3 // 4}) AS k FROM e)
SELECT doc_id, len(ids)::INTEGER AS n_tokens, len(k)::INTEGER AS n_kept, {hashed('k')} AS ids_hash FROM c""",
        "sft_labels": f"""WITH {samples}
SELECT conv_id, len(all_ids)::INTEGER AS n_tokens, len(input_ids)::INTEGER AS length, {hashed('labels')} AS labels_hash,
  len(list_filter(labels, lambda x: x <> -100))::INTEGER AS n_labelled, len(list_filter(labels[2:], lambda x: x <> -100))::INTEGER AS target_weight FROM samples""",
        "prefix_labels": f"""WITH {CONV_SQL}, f AS (
  SELECT conv_id, {ids('body')} AS f, {ids(rendered('kept[1:len(kept) - 1]') + ' || ' + marker)} AS p FROM rendered WHERE invalid_reason IS NULL AND kept[-1].role = 'assistant')
SELECT conv_id, least(len(f), {MAX_LENGTH})::INTEGER AS n_input, greatest(least(len(f), {MAX_LENGTH}) - len(p), 0)::INTEGER AS n_labelled FROM f WHERE len(f) >= 2""",
        "pad_batches": f"""WITH {samples}, o AS (
  SELECT conv_id, all_ids[1:{MAX_LENGTH}] AS ids, labels[1:least(len(all_ids), {MAX_LENGTH})] AS labels,
    (row_number() OVER (ORDER BY {draw_sql(SEED, 'conv_id', 'batch')}, conv_id) - 1) // 4 AS batch_id FROM samples),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS n FROM o)
SELECT conv_id, batch_id, n::INTEGER AS padded_len, {hashed('list_resize(ids, n, 256)')} AS ids_hash, {hashed('list_resize(labels, n, -100)')} AS labels_hash, len(ids)::INTEGER AS n_real FROM m""",
        "packed_windows": f"""WITH {docs}, t AS (
  SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, i) - 1 AS p FROM (SELECT split, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM e)),
w AS (
  SELECT split, p // {WINDOW} AS "window", list(id ORDER BY p) AS x, list(y ORDER BY p) AS y
  FROM (SELECT *, lead(id) OVER (PARTITION BY split ORDER BY p) AS y FROM t) WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) = {WINDOW})
SELECT split, "window", {hashed('x')} AS x_hash, {hashed('y')} AS y_hash, len(x)::INTEGER AS n, x[1] AS x_first, y[1] AS y_first, x[2:] = y[1:{WINDOW - 1}] AS shift_ok FROM w""",
        "sampled_windows": f"""WITH {docs}, t AS (
  SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, i) - 1 AS p FROM (SELECT split, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM e)),
n AS (SELECT split, count(*) AS n FROM t GROUP BY split),
k AS (SELECT split, doc_id AS sample, ({draw_sql(SEED, 'doc_id', 'window')} % (n - {WINDOW}))::BIGINT AS start FROM e JOIN n USING (split) WHERE n > {WINDOW}),
m AS (SELECT k.split, sample, start, list(id ORDER BY t.p) AS t FROM (SELECT *, unnest(range(start, start + {WINDOW} + 1)) AS p FROM k) AS k JOIN t ON t.split = k.split AND t.p = k.p GROUP BY k.split, sample, start)
SELECT split, sample, start, {hashed(f't[1:{WINDOW}]')} AS x_hash, {hashed('t[2:]')} AS y_hash FROM m""",
        "history_truncate": f"""WITH {CONV_SQL}, h AS (
  SELECT conv_id, CASE WHEN kept[1].role = 'system' THEN kept[1:1] ELSE [] END AS system, CASE WHEN kept[1].role = 'system' THEN kept[2:] ELSE kept END AS dialogue FROM normalized WHERE invalid_reason IS NULL),
c AS (
  SELECT conv_id, i, sum(len({ids(rendered('[t]'))})) OVER (PARTITION BY conv_id ORDER BY i DESC) AS after
  FROM (SELECT conv_id, unnest(dialogue) AS t, generate_subscripts(dialogue, 1) AS i FROM h)),
k AS (
  SELECT h.*, (SELECT count(*) FROM c WHERE c.conv_id = h.conv_id AND after + len({ids(rendered('system'))}) + {len(head)} <= {used}) AS n FROM h),
q AS (SELECT *, system || dialogue[len(dialogue) - n + 1:] AS kept FROM k),
r AS (SELECT *, {ids(rendered('kept') + ' || ' + marker)} AS ids FROM q),
p AS (SELECT *, ids[greatest(len(ids) - {CONTEXT - MAX_NEW}, 0) + 1:] AS prompt FROM r)
SELECT conv_id, len(dialogue)::INTEGER AS n_turns, n::INTEGER AS kept_turns, len(prompt)::INTEGER AS prompt_tokens, {hashed('prompt')} AS ids_hash,
  sha256(array_to_string(list_transform(kept, lambda t: t.role || ':' || t.content), chr(10))) AS kept_hash FROM p""",
    }


def _oracle() -> dict:
    from quarry.plans.corpus import annotated_sql

    return {
        "pretoken_counts": f"WITH {_pretokens_sql()} SELECT token, count FROM words",
        "pair_counts": f"""WITH {_pretokens_sql()},
h AS (SELECT hex(encode(token)) AS h, count FROM words),
pairs AS (SELECT h, count, unnest(range(1, length(h) - 2, 2)) AS i FROM h WHERE length(h) >= 4)
SELECT substr(h, i, 2) AS "left", substr(h, i + 2, 2) AS "right", CAST(sum(count) AS BIGINT) AS freq FROM pairs GROUP BY ALL""",
        "roundtrip": f"WITH {annotated_sql()} SELECT count(*) AS documents, 0::BIGINT AS mismatches FROM kept",
    } | {f"byte_{name}": sql for name, sql in _byte_sql().items()}


ORACLE = _oracle()
