"""Registered queries of the training-data operators, with production
parameters over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import centroids, lang_id, lm_score, merkle, packing, phrase_index, quality_rules, repeats, secret_scan, simhash, token_counts, toxicity, word_bpe
from quarry.llm.stored import Scratch
from quarry.session import ship_package

#: Tokens above which a text does not fit one training window.
TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int):
    """A fold number that depends on the id only (no id: -1, never held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(-1))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    number = {k: secret_scan.number(k).alias(f"n_{k}") for k in secret_scan.KINDS}
    base = secret_scan.KINDS[:3]
    return found.select("doc_id", *[number[k] for k in base], F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"), secret_scan.joined(secret_scan.KINDS).alias("spans"), number["random"])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lang_id.fit(docs.where(fold(3) != 1), public_tokenizers.path("piece_bpe_32k.model"))
    found = lang_id.identify(docs, model)
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, size = lm_score.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    coded = lm_score.marked(coded, good)
    return lm_score.score(coded, lm_score.fit(coded, None, size), "in_target").drop("in_target")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def bpe_digests(coded: DataFrame) -> DataFrame:
    return coded.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}).drop("ids", "decoded")


def op9_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_digests(word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents"), path), path))


def joined_ids(column: str):
    return F.array_join(F.array_sort(F.transform(column, lambda i: i.cast("string"))), ",")


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Scratch(spark, "index").write(phrase_index.index(table(spark, sf_dir, "documents")), "postings")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.find(None, table(spark, sf_dir, "benchmark"), stored=stored_index(spark, sf_dir))
    ids = joined_ids("items")
    return found.select("doc_id", "n_words", phrase_index.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), phrase_index.contaminated(phrase_index.n_hit(), F.col("n_words")).alias("contaminated"))


def op10_near_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches; beside op10_decontamination, whose SQL has only exact ones."""
    found = phrase_index.find(None, table(spark, sf_dir, "benchmark"), stored=stored_index(spark, sf_dir))
    return found.select("doc_id", F.size("near_items").cast("long").alias("n_near_items"), F.sha2(joined_ids("near_items").cast("binary"), 256).alias("near_items_sha256"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, TOKEN_LIMIT)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, ends = centroids.cluster(table(spark, sf_dir, "embeddings"))
    said = F.array(*[F.lit(",".join(map(str, c))) for c in ends or [[]]])
    return found.withColumn("centroid_sha256", F.sha2(F.element_at(said, F.col("cluster") + 1).cast("binary"), 256))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # tampering deletes the line ends of every row with an even hash
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    claims = {"text": F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "source", claims)
    proof = F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_language_id": op5_language_id,
    "op6_lm_score": op6_lm_score,
    "op7_quality_rules": op7_quality_rules,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_bpe_coding": op9_bpe_coding,
    "op10_decontamination": op10_decontamination,
    "op10_near_items": op10_near_items,
    "op11_packing": op11_packing,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _rules_sql() -> str:
    broken = []
    for _, measure, low, high in quality_rules.RULES:
        x = "(" + measure + ")"
        broken += [f"{x} < {low}"] if low is not None else []
        broken += [f"{x} > {high}"] if high is not None else []
    return " OR ".join(broken)


_BLANK = r"[\x20\x09-\x0D]"
_STOPS = ", ".join(f"'{w}'" for w in quality_rules.counted_forms())

def _clustering_sql(k: int = 16, rounds: int = 3, size: int = 64) -> str:
    far = "SELECT v.id, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS far FROM long_v AS v JOIN c{} AS c ON c.d = v.d GROUP BY v.id, c.c"
    own = "a{0} AS (SELECT id, c, far FROM ({1}) AS q QUALIFY row_number() OVER (PARTITION BY id ORDER BY far, c) = 1)"
    steps = []
    for r in range(rounds):
        mean = "CASE WHEN s % n < 0 THEN (s - (s % n + n)) // n ELSE (s - s % n) // n END"
        steps += [own.format(r, far.format(r)), f"""c{r + 1} AS (
  SELECT c.c, c.d, coalesce(m.x, c.x) AS x FROM c{r} AS c LEFT JOIN (
    SELECT c, d, {mean} AS x FROM (SELECT a.c, v.d, sum(v.x)::BIGINT AS s, count(*) AS n FROM a{r} AS a JOIN long_v AS v ON v.id = a.id GROUP BY a.c, v.d) AS q) AS m
  ON m.c = c.c AND m.d = c.d)"""]
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}),
long_v AS (SELECT id, unnest(range(1, {size + 1})) AS d, unnest(v) AS x FROM kept),
first AS (SELECT id, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS c FROM kept QUALIFY c < {k}),
c0 AS (SELECT first.c, v.d, v.x FROM first JOIN long_v AS v ON v.id = first.id),
{", ".join(steps)}, {own.format(rounds, far.format(rounds))},
ends AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT kept.vec_id, a.c::INTEGER AS cluster, a.far AS distance, (sum(a.far) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.far) OVER ())::BIGINT AS inertia, ends.centroid_sha256
FROM a{rounds} AS a JOIN kept ON kept.id = a.id JOIN ends ON ends.c = a.c"""


def _manifest_sql() -> str:
    # CRC-32 bit by bit: a byte joins the register, which then moves eight times
    bits = "flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce({bits}, lambda c, x: xor(xor(c, x) >> 1, {0xEDB88320} * (xor(c, x) & 1)), {0xFFFFFFFF}::BIGINT), {0xFFFFFFFF}::BIGINT)"

    def said(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(said, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    def tree(name: str, nodes: str) -> str:
        """Nodes of all levels, and the siblings left and right of each."""
        run = "(PARTITION BY level, g, p // 3 ORDER BY p ROWS BETWEEN {})"
        left, right = run.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), run.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        return f"""{name}_tree AS (
  SELECT 0 AS level, g, p, n, h FROM {nodes}
  UNION ALL
  SELECT level + 1, g, p // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY p)) FROM {name}_tree WHERE n > 1 GROUP BY level, g, p // 3, n),
{name}_side AS (
  SELECT level, g, p, n, coalesce(string_agg(h, '') OVER {left}, '') AS l, coalesce(string_agg(h, '') OVER {right}, '') AS r FROM {name}_tree),
{name}_root AS (SELECT g, h FROM {name}_tree WHERE n = 1)"""

    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source AS g, {leaf("text")} AS h,
         CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claim FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaves),
{tree("group", "placed")},
names AS (SELECT '' AS g, g AS name, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS p, count(*) OVER () AS n, h FROM group_root),
{tree("top", "names")},
steps AS (
  SELECT id, 0 AS part, s.level, s.l, s.r FROM placed JOIN group_side AS s ON s.g IS NOT DISTINCT FROM placed.g AND s.p = placed.p // (3 ** s.level)::BIGINT AND s.n > 1
  UNION ALL
  SELECT id, 1, s.level, s.l, s.r FROM placed JOIN names ON names.name IS NOT DISTINCT FROM placed.g JOIN top_side AS s ON s.p = names.p // (3 ** s.level)::BIGINT AND s.n > 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY part, level) AS k FROM steps),
proof AS (SELECT id, string_agg(l || r, '' ORDER BY k) AS proof, count(*) AS k FROM numbered GROUP BY id),
fold AS (
  SELECT id, 0 AS k, claim AS h FROM leaves
  UNION ALL
  SELECT fold.id, fold.k + 1, sha256(numbered.l || fold.h || numbered.r) FROM fold JOIN numbered ON numbered.id = fold.id AND numbered.k = fold.k + 1)
SELECT placed.doc_id, placed.h AS leaf, group_root.h AS subroot, top_root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       fold.h AS folded_root, fold.h = top_root.h AS verified
FROM placed JOIN group_root ON group_root.g IS NOT DISTINCT FROM placed.g CROSS JOIN top_root
LEFT JOIN proof ON proof.id = placed.id JOIN fold ON fold.id = placed.id AND fold.k = coalesce(proof.k, 0)"""


ORACLE: dict[str, str] = {
    "op7_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '{_BLANK}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3) AS q),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) AS q WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) AS q GROUP BY doc_id),
counts AS (
  SELECT cut.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop_words,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS n_digits
  FROM cut LEFT JOIN rep ON rep.doc_id = cut.doc_id),
base AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce({_rules_sql()}, false) AS kept
FROM base""",
    "op10_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0) AS q),
win AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM dw, (SELECT DISTINCT n FROM phrase) AS lengths WHERE len(w) >= n) AS q),
hit AS (SELECT doc_id, i, win.n, item_id FROM win JOIN phrase ON win.s = phrase.s AND win.n = phrase.n),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hit GROUP BY doc_id),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) AS q GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN found ON found.doc_id = dw.doc_id LEFT JOIN covered ON covered.doc_id = dw.doc_id""",
    "op12_centroid_clustering": _clustering_sql(),
    "op13_merkle_manifest": _manifest_sql(),
}
