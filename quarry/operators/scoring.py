"""Structured-output scoring.

One Arrow UDF (:func:`parse_output`) reproduces Python ``json.loads`` exactly
(NaN/Infinity accepted, last duplicate key wins, trailing text rejected) and
returns a canonical nested struct, column by column; every check after that is a native
higher-order-function expression over it.  Three scorer modes exist, as in
the reference: ``strict`` (flat keys never count as extra), ``alias`` (field
names resolved through an alias table; flat keys do count) and ``stability``
(pool = every key including entity names).
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.jsonfmt import let
from quarry.functions.text import py_strip

# ---- fixed values ------------------------------------------------------------
FENCE_RE = r"(?s)^```(?:json)?\s*\n?(.*?)\n?\s*```$"
GROUPS = ["extraction", "schema_constraint", "format_following"]
# Field-name aliases of the reference scorer: canonical -> aliases, scanned in
# this order, first hit wins.
FIELD_ALIASES = {
    "创办者": ["创始人", "创建者", "建立者", "发起人"],
    "位于": ["位置", "地点", "所在地", "地址", "所在"],
    "发现者或发明者": ["发现者", "发明者", "发现人", "发明人"],
    "创建或成立时间": ["建造时间", "创建时间", "建立时间", "建成时间"],
    "发生时间": ["时间", "举办时间", "开始时间"],
    "发生地点": ["地点", "位置", "举办地"],
    "常见并发症": ["并发症", "合并症"],
    "症状": ["主要症状", "常见症状", "临床表现"],
    "治疗方法": ["治疗", "疗法", "治疗方式"],
    "成就": ["获奖", "奖项", "荣誉", "成就奖"],
    "子组织": ["旗下", "下属组织", "子公司", "分支机构"],
    "别名": ["又称", "又名", "别称", "又称", "也叫"],
    "组成": ["成分", "原料", "组成部分", "构成"],
    "用途": ["应用", "应用领域", "主要用途", "作用"],
    "所属科室": ["科室", "所属科"],
    "线路": ["所属线路", "路线"],
    "车站等级": ["等级"],
    "开通时间": ["启用时间", "运营时间", "通车时间"],
    "保护级别": ["濒危等级", "保护等级"],
    "成立时间": ["成立年份", "创立时间", "创建时间"],
    "出生地": ["出生地点", "籍贯"],
    "出生日期": ["生日", "出生年月"],
    "参与者": ["参加者", "参赛者", "参赛方"],
    "起因": ["原因", "导火索"],
    "导致": ["结果", "后果"],
}
# ---------------------------------------------------------------------------

VAL = T.StructType([T.StructField("s", T.StringType()), T.StructField("is_str", T.BooleanType())])
FIELD = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("sval", T.StringType()), T.StructField("vals", T.ArrayType(VAL)),
])
ENTRY = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("is_obj", T.BooleanType()),
    T.StructField("kind", T.StringType()), T.StructField("sval", T.StringType()),
    T.StructField("vals", T.ArrayType(VAL)), T.StructField("fields", T.ArrayType(FIELD)),
])
PARSED = T.StructType([
    T.StructField("ok", T.BooleanType()), T.StructField("kind", T.StringType()),
    T.StructField("entries", T.ArrayType(ENTRY)),
])


def _kind(v) -> str:
    if isinstance(v, str):
        return "str"
    if isinstance(v, list):
        return "list"
    if isinstance(v, dict):
        return "object"
    return "other"


def _vals(v):
    if isinstance(v, str):
        return [(v, True)]
    if isinstance(v, list):
        return [(x if isinstance(x, str) else str(x), isinstance(x, str)) for x in v]
    return []


def parse_one(text):
    """``(ok, kind, entries)`` for one cleaned output (Python semantics)."""
    if text is None:
        return (False, None, None)
    try:
        obj = json.loads(text)
    except (ValueError, TypeError, RecursionError):
        return (False, None, None)
    if obj is None:
        return (True, "null", None)
    if not isinstance(obj, dict):
        return (True, "array" if isinstance(obj, list) else "scalar", None)
    entries = []
    for k, v in obj.items():
        fields = None
        if isinstance(v, dict):
            fields = [(fk, _kind(fv), str(fv), _vals(fv)) for fk, fv in v.items()]
        entries.append((k, isinstance(v, dict), _kind(v), str(v), _vals(v), fields))
    return (True, "object", entries)


def whole(s: str) -> str:
    """``s`` with half surrogate pairs (a cut escape) replaced by U+FFFD, so
    that it is a UTF-8 string."""
    return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _texts(values: list) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:
        return pa.array([v if v is None else whole(v) for v in values], pa.string())


def _ends(ends: list) -> pa.Array:
    return pa.array([0, *ends], pa.int32())


class _Values:
    """Values of many keys, column by column: ``kind``, ``sval`` and ``vals``."""

    def __init__(self):
        self.kind, self.sval, self.s, self.is_str, self.ends = [], [], [], [], []

    def add(self, v) -> None:
        listed = _vals(v)
        self.kind.append(_kind(v))
        self.sval.append(str(v))
        self.s += [s for s, _ in listed]
        self.is_str += [is_str for _, is_str in listed]
        self.ends.append(len(self.s))

    def arrays(self) -> list:
        vals = pa.StructArray.from_arrays([_texts(self.s), pa.array(self.is_str, pa.bool_())], VAL.names)
        return [pa.array(self.kind, pa.string()), _texts(self.sval), pa.ListArray.from_arrays(_ends(self.ends), vals)]


def parse_all(texts: list) -> pa.StructArray:
    """:func:`parse_one` of every text as one array of the type ``PARSED``,
    filled column by column."""
    loads, oks, kinds, entry_ends, no_entries = json.loads, [], [], [], []
    keys, is_obj, field_ends, no_fields, names = [], [], [], [], []
    entry, field = _Values(), _Values()
    kind, sval, s, is_str, ends = field.kind.append, field.sval.append, field.s, field.is_str.append, field.ends.append
    for text in texts:
        obj, ok = None, text is not None
        if ok:
            try:
                obj = loads(text)
            except (ValueError, TypeError, RecursionError):
                ok = False
        oks.append(ok)
        held = isinstance(obj, dict)
        kinds.append("object" if held else None if not ok else "null" if obj is None else "array" if isinstance(obj, list) else "scalar")
        for k, v in obj.items() if held else ():
            keys.append(k)
            inner = isinstance(v, dict)
            is_obj.append(inner)
            if inner:
                entry.kind.append("object")
                entry.sval.append(str(v))
                entry.ends.append(len(entry.s))
                names += v
                for value in v.values():
                    if type(value) is str:  # as most are: ``field.add`` in place
                        kind("str")
                        sval(value)
                        s.append(value)
                        is_str(True)
                        ends(len(s))
                    else:
                        field.add(value)
            else:
                entry.add(v)
            no_fields.append(not inner)
            field_ends.append(len(names))
        no_entries.append(not held)
        entry_ends.append(len(keys))
    fields = pa.StructArray.from_arrays([_texts(names), *field.arrays()], FIELD.names)
    fields = pa.ListArray.from_arrays(_ends(field_ends), fields, mask=pa.array(no_fields, pa.bool_()))
    entries = pa.StructArray.from_arrays([_texts(keys), pa.array(is_obj, pa.bool_()), *entry.arrays(), fields], ENTRY.names)
    entries = pa.ListArray.from_arrays(_ends(entry_ends), entries, mask=pa.array(no_entries, pa.bool_()))
    return pa.StructArray.from_arrays([pa.array(oks, pa.bool_()), pa.array(kinds, pa.string()), entries], PARSED.names)


@F.arrow_udf(PARSED)
def _parse(s: pa.Array) -> pa.Array:
    return parse_all(s.to_pylist())


def parse_output(c: Column) -> Column:
    """Python ``json.loads`` as a canonical struct (the only Python step).

    The UDF fills the columns of the nested struct and returns them as they
    are: no text is made of the structure, nor parsed again.  Marked
    nondeterministic only so the optimizer never inlines it into the
    higher-order functions that consume it; it is a pure function."""
    return _parse.asNondeterministic()(c)


def _loads_ok(s) -> bool:
    if s is None:
        return False
    try:
        json.loads(s)
        return True
    except (ValueError, TypeError, RecursionError):
        return False


@F.pandas_udf(T.BooleanType())
def _json_ok(s: pd.Series) -> pd.Series:
    return s.map(_loads_ok)


def json_ok(c: Column) -> Column:
    """True when Python's ``json.loads`` accepts the text (Spark's native JSON
    parsers accept trailing text and differ on NaN and duplicate keys)."""
    return _json_ok(c)


# ---- native parts -----------------------------------------------------------

def clean_output(c: Column) -> Column:
    """Strip, then unwrap one whole-string code fence (optional ``json``)."""
    s = py_strip(c)
    return F.when(s.rlike(FENCE_RE), py_strip(F.regexp_extract(s, FENCE_RE, 1))).otherwise(s)


def alias_lookup_map(aliases: dict) -> dict:
    """name -> canonical, first hit in table order wins (literal config)."""
    out: dict = {}
    for canonical, names in aliases.items():
        for n in [canonical, *names]:
            out.setdefault(n, canonical)
    return out


def resolve_alias(col: Column, aliases: dict | None = None) -> Column:
    m = alias_lookup_map(FIELD_ALIASES if aliases is None else aliases)
    if not m:
        return col
    lit_map = F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, col), col)


def _obj_entries(p: Column) -> Column:
    return F.filter(F.coalesce(p["entries"], F.array().cast(T.ArrayType(ENTRY))), lambda e: e["is_obj"])


def field_pool(p: Column) -> Column:
    """Inner keys of object values plus keys of non-object values."""
    es = F.coalesce(p["entries"], F.array().cast(T.ArrayType(ENTRY)))
    return F.flatten(F.transform(es, lambda e: F.when(e["is_obj"], F.transform(e["fields"], lambda f: f["name"]))
                                 .otherwise(F.array(e["key"]))))


def inner_keys(p: Column) -> Column:
    return F.flatten(F.transform(_obj_entries(p), lambda e: F.transform(e["fields"], lambda f: f["name"])))


def all_keys(p: Column) -> Column:
    es = F.coalesce(p["entries"], F.array().cast(T.ArrayType(ENTRY)))
    return F.flatten(F.transform(es, lambda e: F.concat(F.array(e["key"]), F.coalesce(
        F.transform(e["fields"], lambda f: f["name"]), F.array().cast("array<string>")))))


def quoted(s: Column) -> Column:
    """A string as Python prints it inside a list (printable characters)."""
    x = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    for raw, said in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        x = F.replace(x, F.lit(raw), F.lit(said))
    double = F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _enum_violations(p: Column, enums: Column, name_fn=lambda n: n) -> Column:
    """Ordered ``(field, message)`` for each enum-constrained value not allowed."""
    def per_field(f):
        allowed = F.try_element_at(enums, name_fn(f["name"]))
        vals = F.coalesce(f["vals"], F.array().cast(T.ArrayType(VAL)))
        bad = F.filter(vals, lambda v: ~(v["is_str"] & F.array_contains(allowed, v["s"])))
        msg = lambda v: F.concat(F.lit("got '"), v["s"], F.lit("', expected one of ["),
                                 F.array_join(F.transform(F.array_sort(F.array_distinct(allowed)), quoted), ", "), F.lit("]"))
        return F.when(allowed.isNotNull(), F.transform(bad, lambda v: F.struct(f["name"].alias("field"), msg(v).alias("msg")))) \
            .otherwise(F.array().cast("array<struct<field:string,msg:string>>"))

    return F.flatten(F.transform(_obj_entries(p), lambda e: F.flatten(F.transform(e["fields"], per_field))))


def _last_per_key(arr: Column, key: str) -> Column:
    """Keep the last element for each key (dict overwrite semantics), in order
    of their places; found by sorting (places are never null, so the plain sort
    orders as ``array_sort`` does, without a comparator)."""
    placed = F.sort_array(F.transform(arr, lambda x, i: F.struct(x[key].alias("key"), i.alias("i"), x.alias("x"))))

    def last(rows):
        kept = F.filter(rows, lambda t, at: ~F.coalesce(F.get(rows, at + 1)["key"] == t["key"], F.lit(False)))
        return F.transform(F.sort_array(F.transform(kept, lambda t: F.struct(t["i"].alias("i"), t["x"].alias("x")))), lambda t: t["x"])

    return let(placed, last)


def with_gold(prompts: DataFrame) -> DataFrame:
    """Prompts with their gold output parsed, once for all models.

    The explode of one keeps the text a column of its own: Spark fails to plan a
    UDF whose argument is an expression of nested lambdas."""
    own = prompts.withColumn("gold_output", F.explode(F.array("gold_output")))
    return own.withColumn("gold_parsed", parse_output(F.col("gold_output")))


def score(df: DataFrame, aliases: dict | None = None, with_value_match: bool = True, keep_parsed: bool = False) -> DataFrame:
    """Score ``outputs ⋈ prompts`` rows.  Needs columns ``output`` and
    ``required_fields``, ``allowed_fields`` (arrays), ``enum_constraints``
    (map<string, array<string>>), optional ``gold_output``, or ``gold_parsed``
    of :func:`with_gold`.  Adds the strict, alias and stability results, and
    ``parsed_output`` if it is to be kept for :func:`structural_quality`."""
    aliases = FIELD_ALIASES if aliases is None else aliases
    d = df.withColumn("clean_output", clean_output(F.col("output"))).withColumn("_p", parse_output(F.col("clean_output")))
    p = F.col("_p")
    ok = F.coalesce(p["ok"], F.lit(False))
    is_dict = ok & (p["kind"] == "object")
    unparsed = ~ok | (p["kind"] == "null")
    req, allowed = F.col("required_fields"), F.col("allowed_fields")
    enums = F.coalesce(F.col("enum_constraints"), F.create_map().cast("map<string,array<string>>"))
    has_enums = F.size(enums) > 0
    empty = F.array().cast("array<string>")

    def absent(names, held):  # the names that are not held, which are listed once a row
        return let(held, lambda h: F.filter(names, lambda f: ~F.array_contains(h, f)))

    # what several results rest on are columns of their own, made once a row; no
    # value violates anything where nothing is constrained
    none = F.array().cast("array<struct<field:string,msg:string>>")
    viol = F.when(has_enums, _last_per_key(_enum_violations(p, enums), "field")).otherwise(none)
    d = d.withColumn("_pool", field_pool(p)).withColumn("_all", F.array_distinct(all_keys(p))).withColumn("_viol", viol)
    pool, viol = F.col("_pool"), F.col("_viol")
    enum_ok = F.size(viol) == 0
    d = (
        d.withColumn("parsed", ok)
        .withColumn("missing_fields", F.when(is_dict, absent(req, pool)).otherwise(req))
        .withColumn("_extra", F.when(is_dict, F.filter(inner_keys(p), lambda f: ~F.array_contains(allowed, f))).otherwise(empty))
        .withColumn("extra_fields", F.when(unparsed, empty).otherwise(F.col("_extra")))
        .withColumn("enum_ok", F.when(~unparsed & has_enums, enum_ok))
        .withColumn("enum_violations", F.when(~unparsed & has_enums, F.map_from_entries(viol)))
        .withColumn("schema_strict", ~unparsed & is_dict & (F.size("missing_fields") == 0) & (F.size("_extra") == 0) & enum_ok)
    )
    # alias-normalized (flat keys count as extra here)
    canon = lambda f: resolve_alias(f, aliases)
    pool_n = F.transform(pool, canon)
    miss_a = F.when(is_dict, absent(req, pool_n)).otherwise(req)
    extra_a = F.when(is_dict, F.array_sort(F.filter(F.array_distinct(pool), lambda f: ~F.array_contains(allowed, canon(f))))).otherwise(empty)
    enum_ok_a = ~has_enums | (F.size(_enum_violations(p, enums, canon)) == 0)
    d = (
        d.withColumn("missing_fields_alias", miss_a)
        .withColumn("extra_fields_alias", extra_a)
        .withColumn("schema_strict_alias", is_dict & (F.size("missing_fields_alias") == 0) & (F.size("extra_fields_alias") == 0) & enum_ok_a)
    )
    # stability scorer: every key (entity names too) is in the pool
    allk = F.col("_all")
    miss_s = F.when(~unparsed, absent(req, allk)).otherwise(req)
    extra_s = F.when(~unparsed, F.array_sort(F.filter(allk, lambda f: ~F.array_contains(allowed, f)))).otherwise(empty)
    allk_n = F.transform(allk, canon)
    miss_sa = F.when(~unparsed, absent(req, allk_n)).otherwise(req)
    extra_sa = F.when(~unparsed, F.array_sort(F.filter(allk, lambda f: ~F.array_contains(allowed, canon(f))))).otherwise(empty)
    d = (
        d.withColumn("missing_fields_stab", miss_s)
        .withColumn("extra_fields_stab", extra_s)
        .withColumn("schema_strict_stab", ~unparsed & (F.size("missing_fields_stab") == 0) & (F.size("extra_fields_stab") == 0) & enum_ok)
        .withColumn("schema_strict_stab_alias", ~unparsed & (F.size(miss_sa) == 0) & (F.size(extra_sa) == 0) & enum_ok)
    )
    if with_value_match and ("gold_parsed" in df.columns or "gold_output" in df.columns):
        d = d if "gold_parsed" in df.columns else with_gold(d)
        gold = F.col("gold_parsed")
        d = d.withColumn("value_match", F.when(~unparsed & is_dict & (F.size(gold["entries"]) > 0), value_match(p, gold))).drop("gold_parsed")
    d = d.drop("_pool", "_all", "_viol", "_extra")
    return d.withColumnRenamed("_p", "parsed_output") if keep_parsed else d.drop("_p")


def paired(left: Column, right: Column, key: str, make) -> Column:
    """``make(l, r)`` for every element of ``left``, in order, with the element
    of ``right`` that has the same ``key`` (null: none).  Keys are unique in
    each array.  Both are sorted into one array, where partners are neighbours."""
    def tagged(side, values):
        return F.transform(values, lambda x, i: F.struct(x[key].alias("key"), F.lit(side).alias("side"), i.alias("i"), x.alias("x")))

    lefts = F.transform(tagged(0, left), lambda t: F.struct(t["key"].alias("key"), t["side"].alias("side"), t["i"].alias("i"), t["x"].alias("l"), F.lit(None).alias("r")))
    rights = F.transform(tagged(1, right), lambda t: F.struct(t["key"].alias("key"), t["side"].alias("side"), t["i"].alias("i"), F.lit(None).alias("l"), t["x"].alias("r")))

    def met(rows):
        def one(t, at):
            nxt = F.get(rows, at + 1)
            return F.struct(t["side"].alias("side"), t["i"].alias("i"), make(t["l"], F.when((nxt["side"] == 1) & (nxt["key"] == t["key"]), nxt["r"])).alias("made"))

        return F.transform(F.sort_array(F.filter(F.transform(rows, one), lambda t: t["side"] == 0)), lambda t: t["made"])

    return let(F.sort_array(F.concat(lefts, rights)), met)


def value_match(p: Column, gold: Column) -> Column:
    """Per gold field: parsed value equals gold (``str()`` forms), or for list
    vs list, gold's string set is a subset.  Gold entities missing from the
    output (or not objects there) add nothing; keyed by field, last wins.
    Entities and fields meet by sorting, so a record of n fields costs n log n."""
    none = F.array().cast("array<struct<field:string,match:boolean>>")

    def field(g, f):
        listy = (g["kind"] == "list") & (f["kind"] == "list")
        sub = F.size(F.array_except(F.transform(g["vals"], lambda v: v["s"]), F.transform(f["vals"], lambda v: v["s"]))) == 0
        same = F.when(f.isNull(), F.lit(False)).when(listy, sub).otherwise(f["sval"] == g["sval"])
        return F.struct(g["name"].alias("field"), same.alias("match"))

    def entity(g, e):
        return F.when(e.isNull(), none).otherwise(paired(g["fields"], e["fields"], "name", field))

    found = F.flatten(paired(_obj_entries(gold), _obj_entries(p), "key", entity))
    return F.map_from_entries(_last_per_key(found, "field"))


# ---- summaries ---------------------------------------------------------------

def _rate(cond: Column, n: Column) -> Column:
    return F.when(n > 0, F.count_if(cond) / n).otherwise(F.lit(0.0))


def by_model(scored: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return scored.groupBy("model").agg(
        n.alias("total"),
        F.count_if("parsed").alias("parseable"),
        _rate(F.col("parsed"), n).alias("parseable_rate"),
        F.sum(F.size("missing_fields")).cast("bigint").alias("missing_fields_count"),
        _rate(F.size("missing_fields") > 0, n).alias("missing_rate"),
        F.sum(F.size("extra_fields")).cast("bigint").alias("extra_fields_count"),
        _rate(F.size("extra_fields") > 0, n).alias("hallucination_rate"),
        F.count_if("schema_strict").alias("schema_strict_count"),
        _rate(F.col("schema_strict"), n).alias("schema_strict_rate"),
        _rate(F.col("schema_strict_alias"), n).alias("schema_strict_alias_rate"),
        _rate(F.size("missing_fields_alias") > 0, n).alias("missing_alias_rate"),
        _rate(F.size("extra_fields_alias") > 0, n).alias("hallucination_alias_rate"),
        F.sum(F.col("latency_s")).alias("total_time_s"),
        F.avg(F.col("latency_s")).alias("avg_latency_s"),
    )


def by_group(scored: DataFrame, groups=GROUPS) -> DataFrame:
    n = F.count(F.lit(1))
    return scored.filter(F.col("group").isin(list(groups))).groupBy("model", "group").agg(
        n.alias("total"),
        (F.count_if("parsed") / n).alias("parseable_rate"),
        (F.count_if(F.size("missing_fields") > 0) / n).alias("missing_rate"),
        (F.count_if(F.size("extra_fields") > 0) / n).alias("hallucination_rate"),
        (F.count_if("schema_strict") / n).alias("schema_strict_rate"),
        (F.count_if("schema_strict_alias") / n).alias("schema_strict_alias_rate"),
        (F.count_if(F.size("missing_fields_alias") > 0) / n).alias("missing_alias_rate"),
    )


def leaderboard(by_model_df: DataFrame, model_order: list) -> DataFrame:
    """Rates to 4 places; rank by strict rate desc, parse rate desc, then run order (one row per
    model, so the unpartitioned window is over a handful of rows)."""
    from quarry.operators.sample import order_index

    def r4(c):
        return F.floor(F.col(c) * 10_000 + 0.5) / F.lit(10_000.0)

    rates = ["schema_strict_rate", "schema_strict_alias_rate", "parseable_rate", "missing_rate", "hallucination_rate"]
    shown = by_model_df.select("model", *[r4(c).alias(c) for c in rates])
    w = W.orderBy(F.desc("schema_strict_rate"), F.desc("parseable_rate"), order_index(model_order, F.col("model")))
    return shown.select(F.row_number().over(w).alias("rank"), "model", *rates)


def round_summary(scored: DataFrame, by: str = "round", more=()) -> DataFrame:
    """Stability round summary: parse / strict / alias-strict rates, errors,
    timing.  A failed request is a row with an ``error`` message and neither
    output nor latency: it counts in the total and in no rate.  ``more``
    aggregates come from the same pass."""
    n = F.count(F.lit(1))
    return scored.groupBy(by).agg(
        n.alias("total"),
        F.count("error").alias("errors"),
        (F.count_if("parsed") / n).alias("parse_rate"),
        (F.count_if("schema_strict_stab") / n).alias("strict_rate"),
        (F.count_if("schema_strict_stab_alias") / n).alias("alias_strict_rate"),
        F.coalesce(F.sum(F.col("latency_s")), F.lit(0.0)).alias("total_time_s"),
        (F.coalesce(F.sum(F.col("latency_s")), F.lit(0.0)) / n).alias("avg_latency_s"),
        *more,
    )


def round_wide(scored: DataFrame, by: str = "round", groups=GROUPS) -> DataFrame:
    """One wide row per round: totals plus per-group rates (null without a row
    of the group).  The groups are a fixed list, so their counts are columns of
    the one aggregate that makes the totals: no row is scored twice."""
    rates = {"parse_rate": "parsed", "strict_rate": "schema_strict_stab", "alias_strict_rate": "schema_strict_stab_alias"}
    more = []
    for g in groups:
        own = F.col("group") == g
        n = F.count_if(own)
        more += [F.when(n > 0, F.count_if(own & F.col(c)) / n).alias(f"{g}_{k}") for k, c in rates.items()]
        more.append(n.alias(f"{g}_total"))
    return round_summary(scored.filter(F.col(by).isNotNull()), by, more)


def structural_quality(scored: DataFrame, by=None) -> DataFrame:
    """Our definition (the reference ships only its result file): entity-key
    rate = parsed object with at least one object value; Han-field rate = all
    field names contain a Han character; field overlap = mean share of
    required fields present."""
    keys = [by] if isinstance(by, str) else list(by or [])
    d = scored.withColumnRenamed("parsed_output", "_p") if "parsed_output" in scored.columns else scored.withColumn("_p", parse_output(F.col("clean_output")))
    ent = F.coalesce(F.exists(F.coalesce(F.col("_p.entries"), F.array().cast(T.ArrayType(ENTRY))), lambda e: e["is_obj"]), F.lit(False))
    pool = field_pool(F.col("_p"))
    han = (F.size(pool) > 0) & F.forall(pool, lambda f: f.rlike(r"\p{IsHan}"))
    req = F.col("required_fields")
    overlap = F.when(F.size(req) > 0, F.size(F.array_intersect(pool, req)) / F.size(req)).otherwise(F.lit(0.0))
    n = F.count(F.lit(1))
    return d.groupBy(*keys).agg(
        n.alias("total"), (F.count_if(ent) / n).alias("entity_key_rate"),
        (F.count_if(F.coalesce(han, F.lit(False))) / n).alias("chinese_fields_rate"), F.avg(overlap).alias("avg_field_overlap"),
    )
