import json
import time
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.functions.draw import draw
from quarry.functions.jsonfmt import grouped, relations_json
from quarry.operators import sample as sp
from quarry.operators.derive import PERTURB_KINDS, perturb
from quarry.operators.sample import global_index

REL = "array<struct<head:string,relation:string,tail:string>>"


def _py_relations_json(rels):
    ents: dict = {}
    for h, r, t in rels:
        ents.setdefault(h, {}).setdefault(r, []).append(t)
    out = {e: {k: (v[0] if len(v) == 1 else v) for k, v in d.items()} for e, d in ents.items()}
    return json.dumps(out, ensure_ascii=False)


def test_relations_json_order_and_unwrap(spark):
    cases = [
        [("B", "r1", "x"), ("A", "r2", "y"), ("B", "r1", "x"), ("B", "r3", "z"), ("A", "r2", "w")],  # repeat kept, interleaved
        [("e", "k", "only")],
        [],
        [("中", "关系", "值\"q")],
    ]
    df = spark.createDataFrame([([{"head": h, "relation": r, "tail": t} for h, r, t in c],) for c in cases], f"rel {REL}")
    got = [r[0] for r in df.select(relations_json(F.col("rel"))).collect()]
    assert got == [_py_relations_json(c) for c in cases]


def _perturbed(spark, rels, fields, keys=("k",), seed=7, kinds=PERTURB_KINDS):
    rel = [{"head": h, "relation": r, "tail": t} for h, r, t in rels]
    df = spark.createDataFrame([(rel, fields, k) for k in keys], f"rel {REL}, fields array<string>, key string")
    rows = df.select("key", perturb(grouped(F.col("rel")), F.col("fields"), F.col("key"), seed, kinds).alias("p")).collect()
    found = {r["key"]: r["p"] and tuple(r["p"]) for r in rows}
    return found if len(keys) > 1 else found[keys[0]]


TRIPLES = [("E", "MEDIUM", "a"), ("F", "LARGE", "b"), ("E", "LARGE", "c"), ("E", "LARGE", "d"), ("F", "MEDIUM", "e")]
SCHEMA = ["LARGE", "MEDIUM", "WARRANTY"]


def test_perturb_misspells_a_used_field_of_the_first_entity(spark):
    seen = set()
    keys = [f"k{k}" for k in range(12)]
    found = _perturbed(spark, TRIPLES, SCHEMA, keys)
    assert _perturbed(spark, TRIPLES, SCHEMA, keys[3:4]) == found["k3"]  # nothing but seed and key decides
    for wrong, desc, kind in found.values():
        before, after = json.loads(_py_relations_json(TRIPLES)), json.loads(wrong)
        assert kind == "misspell" and list(after) == ["E", "F"] and after["F"] == before["F"]
        old = next(f for f in before["E"] if f not in after["E"])
        new = list(after["E"])[-1]  # goes to the end
        assert after["E"][new] == before["E"][old] and len(new) == len(old)
        [(x, y)] = [(a, b) for a, b in zip(old, new, strict=True) if a != b]
        assert ord(y) - ord(x) in (1, -1, 2)
        assert desc == f"字段名 '{old}' 被错误写成了 '{new}'"
        seen.add((old, ord(y) - ord(x)))
    assert len(seen) > 3


def test_perturb_other_kinds(spark):
    before = json.loads(_py_relations_json(TRIPLES))
    wrong, desc, kind = _perturbed(spark, TRIPLES, SCHEMA, kinds=("drop", "extra"))
    [gone] = set(before["E"]) - set(json.loads(wrong)["E"])
    assert kind == "drop" and desc == f"缺少字段 '{gone}'" and not any(gone in v for v in json.loads(wrong).values())
    wrong, desc, kind = _perturbed(spark, TRIPLES, ["WARRANTY"])
    [host] = [e for e, v in json.loads(wrong).items() if "WARRANTY" in v]
    assert kind == "extra" and f"'{host}'" in desc and json.loads(wrong)[host]["WARRANTY"] == "这是一个不正确的值"
    wrong, desc, kind = _perturbed(spark, TRIPLES, [])
    assert kind == "to_list" and json.loads(wrong)["E"]["MEDIUM"] == ["a", "多余值"] and json.loads(wrong)["F"] == before["F"]
    assert _perturbed(spark, [("E", "r", "a"), ("E", "r", "b")], []) is None  # no single value
    assert _perturbed(spark, [], ["x"]) is None
    assert _perturbed(spark, TRIPLES, None)[2] == "to_list"
    assert _perturbed(spark, TRIPLES, SCHEMA, kinds=()) is None


def test_perturb_edge_names(spark):
    # one character: the name stays and moves to the end
    assert json.loads(_perturbed(spark, [("E", "r", "a"), ("E", "zz", "b")], ["r"])[0]) == {"E": {"zz": "b", "r": "a"}}
    for name in ("关系", "😀😁", "a\"b", "\ud7ff\ud7ff"):  # code points of any width; past the surrogates
        wrong, _, kind = _perturbed(spark, [("E", name, "a")], [name])
        [new] = json.loads(wrong)["E"]
        assert kind == "misspell" and len(new) == len(name) and new != name and new.encode()
    # the wrong name is there already: it takes the value, in its place
    taken = [("E", "bb", "a"), *[("E", c, c) for c in ("ab", "cb", "db", "ba", "bc", "bd")]]
    wrong, desc, _ = _perturbed(spark, taken, ["bb"])
    new = desc.split("'")[3]
    want = {c: c for c in ("ab", "cb", "db", "ba", "bc", "bd")} | {new: "a"}
    assert json.loads(wrong)["E"] == want and list(json.loads(wrong)["E"]) == list(want)


def test_a_record_of_many_fields_stays_cheap(spark):
    rels = [(f"e{i % 50}", f"f{i % 5000}", f"t{i}") for i in range(10_000)]
    df = spark.createDataFrame([([{"head": h, "relation": r, "tail": t} for h, r, t in rels],)], f"rel {REL}")
    start = time.time()
    assert df.select(relations_json(F.col("rel"))).first()[0] == _py_relations_json(rels)
    assert time.time() - start < 20  # filters for each entity and field took minutes


def test_global_index_is_dense_and_partition_invariant(spark):
    from quarry.functions.draw import draw

    base = spark.range(0, 2000).withColumn("d", draw(1, F.col("id"), "x"))
    ref = None
    for parts in (1, 4, 16):
        df = base.repartition(parts)
        idx = global_index(df, [], "d", [F.col("id")], "idx", buckets=32)
        rows = sorted((r["idx"], r["id"]) for r in idx.collect())
        assert [r[0] for r in rows] == list(range(2000))
        if ref is None:
            ref = rows
        assert rows == ref
    # the order is (draw, id)
    want = sorted(((r["d"], r["id"]) for r in base.collect()))
    assert [r[1] for r in ref] == [w[1] for w in want]


def test_topics_meet_their_records_without_a_shuffle(spark):
    """A few topics by a shuffle would be a few tasks; also where nothing is
    small enough for Spark to broadcast by itself."""
    from quarry.operators import derive as dv
    from quarry.operators import ie
    from quarry.sources.adapters import eval_schema, with_allowed

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rel = "array<struct<head:string,relation:string,tail:string>>"
        d = spark.createDataFrame([("1", "A", "x", [("h", "r", "t")]), ("2", "B", "y", []), ("3", None, "z", [])], f"id string, cate string, input string, relation {rel}")
        schema = d.select("cate", F.explode("relation.relation").alias("f")).groupBy(F.col("cate").alias("topic")).agg(F.collect_set("f").alias("fields"))
        prompts = d.select("id", "cate", F.transform("relation", lambda r: r["relation"]).alias("_types"))
        frames = (dv.schema_lookup(d, schema, {}), with_allowed(prompts, eval_schema(d)), ie.apply_filters(d))
        assert [f.count() for f in frames] == [3, 3, 3]
        for f in frames:
            plan = f._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r["id"]: r["allowed_fields"] for r in frames[1].collect()} == {"1": ["r", "WARRANTY"], "2": [], "3": []}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_prompts_are_made_only_where_asked_for(spark):
    from quarry.operators import derive as dv

    triples = [("E1", "f1", "v1"), ("E1", "f2", "v2"), ("E2", "f1", "v3")]
    d = spark.createDataFrame([("1", "T", "high", "some text", triples), ("2", "T", "low", "x", triples[:1])],
                              "id string, cate string, quality_tier string, input string, relation array<struct<head:string,relation:string,tail:string>>")
    schema = spark.createDataFrame([("T", ["f1", "f2", "f3"])], "topic string, fields array<string>")
    t = dv.derive_tasks(d, schema, {})
    assert dv.T2J_PROMPT_HEAD.strip() not in t.select("task_type", "original_id")._jdf.queryExecution().optimizedPlan().toString()
    rows = {(r["original_id"], r["task_type"]): r for r in t.collect()}
    assert sorted(rows) == [("1", k) for k in sorted(dv.TASK_TYPES)] + [("2", "ie_extraction")]
    assert all('["f1", "f2", "f3"]' in r["prompt"] for r in rows.values())
    assert {k for k, r in rows.items() if r["perturbation"] is not None} == {("1", "schema_repair")}


def test_a_computed_relation_list_is_made_once(spark):
    df = spark.createDataFrame([([("a", "r", "x"), ("b", "r", "y")],)], "rel array<struct<head:string,relation:string,tail:string>>")
    out = df.select(relations_json(F.filter("rel", lambda r: r["tail"] != "marked")).alias("j"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("marked") == 1
    assert out.first()["j"] == '{"a": {"r": "x"}, "b": {"r": "y"}}'


def test_first_k_shuffles_no_rows_to_choose_them(spark):
    """Only the histogram and the rows of a boundary bucket are shuffled; a
    group's boundary, one row, meets the rows by a broadcast."""
    d = spark.range(400).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("p"),
                                F.lit("wide").alias("text"), draw(1, F.col("id")).alias("u"))
    rows = d.collect()
    for k in (0, 1, 77, 1000):
        got = sp.first_k(d, ["g"], ["p"], "u", "id", F.lit(k), buckets=16)
        want = set()
        for g in (None, 0, 1):
            own = sorted((r for r in rows if r.g == g), key=lambda r: (r.p is not None, r.p or 0, r.u, r.id))
            want |= {r.id for r in own[:k]}
        ids = [r.id for r in got.collect()]
        assert len(ids) == len(want) and set(ids) == want
    plan = got._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().split("\n") if "Join" in line]
    assert joins and all("broadcast" in line for line in joins)


def test_records_take_partitions_by_their_number(spark, monkeypatch):
    """However few partitions the session has, and with the same records."""
    from conftest import SMOKE
    from quarry.plans import ie as plans
    from quarry.sources import adapters

    def rows():
        t = plans.filtered(spark, SMOKE)
        return t.rdd.getNumPartitions(), sorted(map(str, t.select("id", "cate", "input", "relation", "reject_reason").collect()))

    _, want = rows()
    monkeypatch.setattr(adapters, "ITEMS_A_TASK", 250, raising=False)
    n, got = rows()
    assert n >= 20 and got == want
