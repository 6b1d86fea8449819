"""Adapters from the given test tables to the reference's input shapes.

Each adapter has a DataFrame definition here and an identical DuckDB SQL
definition in :mod:`quarry.plans.oracle_views`, so every query can be checked
against an independent engine.  They transform every row (no row subsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import read_table


def dirty_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with injected dirt so every cleaning flag fires:
    id%97=0 -> spaces only; id%11=0 -> char(1) after position 10;
    id%13=0 -> wrapped in <p>..</p>; id%17=0 -> four newlines, two spaces, 'x'
    appended; id%7=0 -> U+3000 and a tab prepended."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    i = F.col("doc_id")

    def on(m, s):
        return F.when(i % m == 0, F.lit(s)).otherwise(F.lit(""))

    # each step references the previous text once, so the optimizer never
    # duplicates the chain when it inlines projections
    t = F.when(i % 97 == 0, F.lit("    ")).otherwise(F.col("text"))
    t = F.overlay(t, on(11, "\x01"), F.lit(11), F.lit(0))
    t = F.concat(on(13, "<p>"), t, on(13, "</p>"))
    t = F.concat(t, on(17, "\n\n\n\n  x"))
    t = F.concat(on(7, "\u3000\t"), t)
    return d.select("doc_id", t.alias("text"), "lang", "source")


# ---- IE records from the star schema --------------------------------------
# fixed adapter values
IE_CATE_MAP = {"HOUSEHOLD": "HOME"}
IE_NO_SCHEMA_TOPIC = "MACHINERY"
IE_UNUSED_FIELD = "WARRANTY"


def ie_source_of(key) -> "F.Column":
    return F.when(key % 20 == 0, F.lit("valid")).when(key % 20 == 1, F.lit("test")).otherwise(F.lit("train"))


#: Line items whose records one task takes about.
ITEMS_A_TASK = 250_000


def record_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for the shuffles of whole records by the number of line items;
    none if those of the session are as many, which AQE may merge and split."""
    n = -(-read_table(spark, sf_dir, "lineitem").count() // ITEMS_A_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(df: DataFrame, parts: int | None, key: str) -> DataFrame:
    return df if parts is None else df.repartition(parts, key)


def ie_relations(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Per order: the ordered relation array (head=p_brand, relation=p_type,
    tail=p_name), ordered by (l_linenumber, l_partkey, l_suppkey, l_quantity).

    Sorting structs whose leading fields are the sort keys gives the order
    without a window."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    j = _dealt(li, parts, "l_partkey").join(_dealt(p, parts, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    item = F.struct(
        F.col("l_linenumber").alias("k1"), F.col("l_partkey").alias("k2"), F.col("l_suppkey").alias("k3"),
        F.col("l_quantity").alias("k4"), F.col("p_brand").alias("head"), F.col("p_type").alias("relation"),
        F.col("p_name").alias("tail"),
    )
    return _dealt(j, parts, "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(item)).alias("_items"))


def ie_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cate, source)`` of the records of :func:`ie_src`."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("cate"), ie_source_of(F.col("o_orderkey")).alias("source"))


def ie_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw IE records, one per order (left join: orders without lines get an
    empty relation list). ``input`` = segment + ' order: ' + '; '-joined
    'head tail' of the first four relations; ``source`` by o_orderkey % 20."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parts = record_partitions(spark, sf_dir)
    rel = ie_relations(spark, sf_dir, parts)
    oc = _dealt(o, parts, "o_custkey").join(_dealt(c, parts, "c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    items = F.coalesce(F.col("_items"), F.array())
    first4 = F.slice(items, 1, 4)
    relation = F.transform(
        items,
        lambda x: F.struct(
            x["head"].alias("head"), x["relation"].alias("relation"), x["tail"].alias("tail"),
            F.lit("").alias("head_type"), F.lit("").alias("tail_type"),
        ),
    )
    return (
        _dealt(oc, parts, "o_orderkey")
        .join(rel, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("c_mktsegment").alias("cate"),
            F.lit(None).cast("string").alias("text"),
            F.concat(
                F.col("c_mktsegment"), F.lit(" order: "),
                F.array_join(F.transform(first4, lambda x: F.concat_ws(" ", x["head"], x["tail"])), "; "),
            ).alias("input"),
            relation.alias("relation"),
            ie_source_of(F.col("o_orderkey")).alias("source"),
        )
    )


def ie_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with the optional fields of raw input: ``text`` beside
    ``input`` (padded; empty; missing, by id % 3), and entity types on every
    fourth record, missing on every second relation."""
    d = ie_src(spark, sf_dir)
    key = F.col("id").cast("bigint")
    text = F.when(key % 3 == 0, F.concat(F.lit(" \u3000T: "), "input", F.lit("\u00a0\t"))).when(key % 3 == 1, F.lit(""))
    typed = F.transform("relation", lambda r, i: F.struct(
        r["head"].alias("head"), r["relation"].alias("relation"), r["tail"].alias("tail"),
        F.when((key % 4 == 0) & (i % 2 == 0), F.upper(F.substring(r["head"], 1, 5))).alias("head_type"),
        F.when(key % 4 == 0, F.substring(r["tail"], 1, 3)).alias("tail_type")))
    return d.withColumns({"text": text, "relation": typed})


def ie_topic_schema_from(normalized: DataFrame, cate_map: dict) -> DataFrame:
    """The same topic schema as :func:`ie_topic_schema`, computed from
    normalized IE records (categories renamed back to the segment names the
    schema is kept under), so no second pass over the line items is needed."""
    inverse = {new: old for old, new in cate_map.items()}
    topic = F.col("cate")
    if inverse:
        m = F.create_map(*[F.lit(x) for kv in inverse.items() for x in kv])
        topic = F.coalesce(F.try_element_at(m, F.col("cate")), F.col("cate"))
    rel = normalized.select(topic.alias("topic"), F.explode("relation").alias("r"))
    return (
        rel.filter(F.col("topic") != IE_NO_SCHEMA_TOPIC)
        .groupBy("topic")
        .agg(F.array_sort(F.collect_set("r.relation")).alias("_f"))
        .select("topic", F.concat(F.col("_f"), F.array(F.lit(IE_UNUSED_FIELD))).alias("fields"))
    )


def ie_topic_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(topic, fields)``: per segment the sorted distinct relation types plus
    one unused field; no entry for one segment (exercises the skip path).
    Kept under the *un-renamed* topic names (exercises the reverse lookup)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    return (
        j.filter(F.col("c_mktsegment") != IE_NO_SCHEMA_TOPIC)
        .groupBy(F.col("c_mktsegment").alias("topic"))
        .agg(F.array_sort(F.collect_set("p_type")).alias("_f"))
        .select("topic", F.concat(F.col("_f"), F.array(F.lit(IE_UNUSED_FIELD))).alias("fields"))
    )


# ---- conversations ----------------------------------------------------------

def conv_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` with injected irregularities: every turn = 3 (mod 5)
    gets an upper-case, space-padded role; (7 * conv_id + turn) % 13 = 0
    blanks the text; conv_id % 17 = 5 gets an unknown role at turn 1."""
    c = read_table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    role = (
        F.when((cid % 17 == 5) & (turn == 1), F.lit("narrator"))
        .when(turn % 5 == 3, F.concat(F.lit("  "), F.upper("role"), F.lit(" ")))
        .otherwise(F.col("role"))
    )
    text = F.when((cid * 7 + turn) % 13 == 0, F.lit("   ")).otherwise(F.col("text"))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"))


# ---- structured-output evaluation fixtures ----------------------------------
# fixed adapter values
EVAL_MODELS = ["base", "adapted", "small"]
EVAL_GROUPS = ["extraction", "schema_constraint", "format_following"]
EVAL_ENUM_FIELD = "ECONOMY"
EVAL_ALIASES = {"LARGE": ["BIG", "HUGE"], "SMALL": ["TINY", "BIG"]}
EVAL_RENAMES = [("LARGE", "BIG"), ("SMALL", "TINY")]
EVAL_UNKNOWN_FIELD = ("COLOR", "red")
EVAL_UNKNOWN_HEAD = "Brand#0"  # the entity that gets it when there is no relation
EVAL_INSTRUCTIONS = {
    "extraction": "Extract every entity and its relations from the text as JSON.",
    "schema_constraint": "Use only the fields of the given schema; answer in JSON.",
    "format_following": "Output only a JSON object, nothing else.",
}


def eval_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prompt per order: required = its first two distinct relation types
    (one, if it has no second); allowed = the segment's schema fields (the
    order's own types when the segment has none); enum = the ECONOMY field
    limited to tails that occur among the first four relations (those in the
    text); gold = the grouped relations JSON; group by key % 3."""
    # schema from the same records (identical sub-plans: Spark reuses their exchanges)
    return with_allowed(eval_records(spark, sf_dir), eval_schema(ie_src(spark, sf_dir)))


def eval_schema(records: DataFrame) -> DataFrame:
    """Schema fields by segment, from ``cate`` and ``relation`` of the records."""
    return ie_topic_schema_from(records, {}).withColumnRenamed("topic", "cate")


def with_allowed(prompts: DataFrame, schema: DataFrame) -> DataFrame:
    """The allowed fields of prompts of :func:`eval_records`.  The schema, one
    row for each segment, is broadcast: by a shuffle all prompts of a segment
    would meet in one task."""
    allowed = F.coalesce(F.col("fields"), F.array_sort("_types")).alias("allowed_fields")
    return prompts.join(F.broadcast(schema), "cate", "left").select(*[c for c in prompts.columns if c not in ("cate", "_types")], allowed)


def eval_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that the prompts of :func:`eval_records` are made from but their input:
    ``id``, ``cate`` and the relations without types."""
    triples = F.transform("relation", lambda r: F.struct(r["head"].alias("head"), r["relation"].alias("relation"), r["tail"].alias("tail")))
    return ie_src(spark, sf_dir).select("id", "cate", triples.alias("relation"))


def by_id(spark: SparkSession, sf_dir: str, records: DataFrame) -> DataFrame:
    """Records dealt by id into partitions by the number of line items, so that
    what is made of them meets by id where it lies."""
    n = -(-read_table(spark, sf_dir, "lineitem").count() // ITEMS_A_TASK)
    return records.repartition(max(n, spark.sparkContext.defaultParallelism), "id")


def eval_records(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """The prompts of :func:`eval_prompts` with their segment (``cate``) and own
    types in place of the many allowed fields; without ``input`` if they are made
    from a ``source`` that has none (:func:`eval_source`)."""
    from quarry.functions.jsonfmt import relations_json

    rel = F.col("relation") if source is not None else F.transform("relation", lambda r: F.struct(r["head"].alias("head"), r["relation"].alias("relation"), r["tail"].alias("tail")))
    types = F.array_distinct(F.transform(rel, lambda r: r["relation"]))
    first4 = F.slice(rel, 1, 4)
    enum_vals = F.array_sort(F.array_distinct(F.transform(F.filter(first4, lambda r: r["relation"] == EVAL_ENUM_FIELD), lambda r: r["tail"])))
    has_enum = F.array_contains(types, EVAL_ENUM_FIELD)
    grp = F.element_at(F.array(*[F.lit(g) for g in EVAL_GROUPS]), (F.col("id").cast("bigint") % 3 + 1).cast("int"))
    d = ie_src(spark, sf_dir) if source is None else source
    return (
        d.select(
            "id", "cate", types.alias("_types"), grp.alias("group"), *[c for c in d.columns if c == "input"],
            F.slice(types, 1, 2).alias("required_fields"),
            F.when(has_enum, F.create_map(F.lit(EVAL_ENUM_FIELD), enum_vals)).otherwise(
                F.create_map().cast("map<string,array<string>>")).alias("enum_constraints"),
            relations_json(rel).alias("gold_output"),
            rel.alias("_rel"),
        )
    )


def eval_outputs(spark: SparkSession, sf_dir: str, seed: int = 42, prompts: DataFrame | None = None) -> DataFrame:
    """Model outputs: every model answers every prompt; the answer is the gold
    JSON damaged by class ``draw(seed, model:id) % 8``: none, code fence, drop
    the first required field, alias renames, unknown field, broken JSON,
    ``null``, wrapped in an array.  Latency is a draw as well."""
    from quarry.functions.draw import draw
    from quarry.functions.jsonfmt import relations_json

    p = eval_records(spark, sf_dir) if prompts is None else prompts
    models = F.explode(F.array(*[F.struct(F.lit(i).alias("model_ord"), F.lit(m).alias("model")) for i, m in enumerate(EVAL_MODELS)]))
    x = p.select(models.alias("m"), "*").select("m.model", "m.model_ord", *p.columns)
    key = F.concat_ws(":", F.col("model"), F.col("id"))
    x = x.withColumn("_cls", F.pmod(draw(seed, key, "class"), F.lit(8)))  # one draw for all its comparisons
    cls = F.col("_cls")
    gold, rel = F.col("gold_output"), F.col("_rel")
    renamed = gold
    for old, new in EVAL_RENAMES:
        renamed = F.replace(renamed, F.lit(f'"{old}": '), F.lit(f'"{new}": '))
    dropped = relations_json(F.filter(rel, lambda r: r["relation"] != F.try_element_at(F.col("required_fields"), F.lit(1))))
    extra = relations_json(F.concat(rel, F.array(F.struct(
        F.coalesce(F.try_element_at(rel, F.lit(1))["head"], F.lit(EVAL_UNKNOWN_HEAD)).alias("head"), F.lit(EVAL_UNKNOWN_FIELD[0]).alias("relation"),
        F.lit(EVAL_UNKNOWN_FIELD[1]).alias("tail")))))
    out = (
        F.when(cls == 0, gold)
        .when(cls == 1, F.concat(F.lit("```json\n"), gold, F.lit("\n```")))
        .when(cls == 2, dropped)
        .when(cls == 3, renamed)
        .when(cls == 4, extra)
        .when(cls == 5, F.substring(gold, F.lit(1), F.length(gold) - 1))
        .when(cls == 6, F.lit("null"))
        .otherwise(F.concat(F.lit("["), gold, F.lit("]")))
    )
    lat = F.lit(0.1) + F.pmod(draw(seed, key, "latency"), F.lit(1000)) / F.lit(1000.0)
    return x.select("model", "model_ord", "id", "group", out.alias("output"), lat.alias("latency_s"))


def eval_rounds(spark: SparkSession, sf_dir: str, seed: int = 42, prompts: DataFrame | None = None) -> DataFrame:
    """The same outputs as rounds of requests, one in sixteen of which failed:
    it has an error message and neither output nor latency."""
    from quarry.functions.draw import draw

    o = eval_outputs(spark, sf_dir, seed, prompts)
    failed = F.pmod(draw(seed, F.concat_ws(":", F.col("model"), F.col("id")), "request"), F.lit(16)) == 0
    return o.withColumns({"error": F.when(failed, F.lit("timeout")), "output": F.when(~failed, F.col("output")), "latency_s": F.when(~failed, F.col("latency_s"))})


# ---- benchmark and training logs from the events table ----------------------

def bench_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: config = event_type, time = value, run = user_id % 3,
    completion tokens = event_id % 256 (0 tokens = failed request); a TTFT is
    logged only for 'click' events.  Users with user_id % 40 = 3 make the
    config ``<type>-down``, whose requests all fail, and the batch of run 1 of
    'view' fails as a whole."""
    e = read_table(spark, sf_dir, "events")
    tokens = (F.col("event_id") % 256).cast("int")
    run = F.col("user_id") % 3
    down = F.col("user_id") % 40 == 3
    failed = down | ((F.col("event_type") == "view") & (run == 1))
    return e.select(
        F.when(down, F.concat("event_type", F.lit("-down"))).otherwise(F.col("event_type")).alias("config"), run.alias("run"), F.col("event_id"),
        F.col("value").alias("time_total_s"), tokens.alias("completion_tokens"),
        F.when(F.col("event_type") == "click", F.col("value") / 10).alias("ttft_s"),
        F.when((tokens > 0) & (F.col("value") > 0) & ~failed, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
    )


def kv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache benchmark log: prompt_len = 128 * (1 + user_id % 4), gen_len =
    64 * (1 + event_id % 2), mode by event_id % 3 (0 = no cache), time = value,
    of which 1/8 to 4/8 is prefill, growing with the prompt."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        (F.lit(128) * (F.lit(1) + F.col("user_id") % 4)).alias("prompt_len"),
        (F.lit(64) * (F.lit(1) + F.col("event_id") % 2)).alias("gen_len"),
        F.when(F.col("event_id") % 3 == 0, F.lit("no_cache")).otherwise(F.lit("cache")).alias("mode"),
        F.col("value").alias("time_s"), (F.col("value") * (F.lit(1) + F.col("user_id") % 4) / F.lit(8)).alias("prefill_s"),
    )


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training log: run = event_type, step = event_id, val_loss = value,
    loss = value / 10, token weight = user_id % 5."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("val_loss"),
        (F.col("value") / 10).alias("loss"), (F.col("user_id") % 5).alias("weight"), F.col("ts"),
    )
