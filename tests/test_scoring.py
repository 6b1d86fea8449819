from pyspark.sql import functions as F

from quarry.operators import scoring as sc
from quarry.operators.scoring import alias_lookup_map, clean_output, parse_one, score

PROMPT = "required_fields array<string>, allowed_fields array<string>, enum_constraints map<string,array<string>>, gold_output string"


def test_parse_matches_json_loads():
    assert parse_one('{"a": 1} trailing') == (False, None, None)
    assert parse_one("NaN")[0] is True
    ok, kind, entries = parse_one('{"k": {"f": 1}, "k": {"g": "x"}}')  # last duplicate wins
    assert ok and kind == "object" and entries[0][5][0][0] == "g"
    assert parse_one("null") == (True, "null", None)
    assert parse_one("[1]") == (True, "array", None)
    assert parse_one("{'a': 1}") == (False, None, None)


def test_clean_output_fences(spark):
    rows = ["```json\n{\"a\": 1}\n```", "```\n{\"a\": 1}```", "  {\"a\": 1}  ", "```json {\"a\": 1}``` tail"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "o string").select(clean_output(F.col("o"))).collect()]
    assert got[:3] == ['{"a": 1}'] * 3 and got[3] == rows[3].strip()


def test_alias_first_canonical_wins():
    m = alias_lookup_map({"LARGE": ["BIG", "HUGE"], "SMALL": ["TINY", "BIG"]})
    assert m["BIG"] == "LARGE" and m["TINY"] == "SMALL" and m["SMALL"] == "SMALL"


def test_score_modes(spark):
    rows = [
        # flat object: flat keys are never extra in strict mode, are extra in alias mode
        ('{"A": "x", "B": "y"}', ["A"], ["A"], {}),
        # entity-keyed with an unknown inner field; stability mode counts the entity name too
        ('{"E": {"A": "x", "Z": "y"}}', ["A"], ["A"], {}),
        # enum violation on a list value
        ('{"E": {"A": ["ok", "bad"]}}', ["A"], ["A"], {"A": ["ok"]}),
        ("null", ["A"], ["A"], {}),
        ("[1, 2]", ["A"], ["A"], {}),
    ]
    df = spark.createDataFrame([(i, o, r, a, e, '{"E": {"A": "x"}}') for i, (o, r, a, e) in enumerate(rows)],
                               "id int, output string, " + PROMPT)
    s = {r["id"]: r for r in score(df, aliases={}).collect()}
    assert s[0]["schema_strict"] is True and s[0]["extra_fields"] == [] and s[0]["extra_fields_alias"] == ["B"]
    assert s[1]["extra_fields"] == ["Z"] and s[1]["schema_strict"] is False
    assert s[1]["extra_fields_stab"] == ["E", "Z"]
    assert s[1]["value_match"] == {"A": True}
    assert s[2]["enum_ok"] is False and s[2]["enum_violations"] == {"A": "got 'bad', expected one of ['ok']"}
    assert s[3]["parsed"] is True and s[3]["missing_fields"] == ["A"] and s[3]["schema_strict"] is False
    assert s[4]["missing_fields"] == ["A"] and s[4]["extra_fields"] == [] and s[4]["schema_strict"] is False


def test_value_match_of_a_record_of_many_fields(spark):
    """Ten thousand fields, in another order than gold's; repeated names: the last entity's counts."""
    import json
    import time

    gold = {f"e{k}": {f"f{i}": f"v{i}" for i in range(k, 10_000, 20)} for k in range(20)} | {"last": {"f5": ["a", "b"], "f6": "x"}, "gone": {"f7": "y"}}
    out = {e: dict(reversed([(f, "wrong" if f == "f9" else v) for f, v in fs.items()])) for e, fs in reversed(gold.items()) if e != "gone"}
    out["last"] = {"f5": ["b", "c", "a"], "f6": 6}
    df = spark.createDataFrame([(json.dumps(out), json.dumps(gold), [], [])], "output string, gold_output string, required_fields array<string>, allowed_fields array<string>")
    df = df.withColumn("enum_constraints", F.create_map().cast("map<string,array<string>>"))
    start = time.time()
    got = sc.score(df).select("value_match").first()[0]
    assert time.time() - start < 30
    assert got == {f"f{i}": i not in (6, 9) for i in range(10_000)}


def test_error_rows_count_in_the_total_only(spark):
    rows = [("r", "extraction", '{"a": {"b": "c"}}', None, 0.5), ("r", "extraction", None, "timeout", None), ("r", "schema_constraint", None, "refused", None), ("all", "extraction", None, "down", None)]
    df = spark.createDataFrame(rows, "round string, group string, output string, error string, latency_s double")
    df = df.withColumns({"required_fields": F.array(F.lit("b")), "allowed_fields": F.array(F.lit("a"), F.lit("b")), "enum_constraints": F.create_map().cast("map<string,array<string>>")})
    got = {r["round"]: r for r in sc.round_wide(sc.score(df)).collect()}
    r = got["r"]
    assert (r["total"], r["errors"], r["parse_rate"], r["strict_rate"], r["total_time_s"]) == (3, 2, 1 / 3, 1 / 3, 0.5)
    assert (r["extraction_total"], r["extraction_parse_rate"], r["schema_constraint_parse_rate"]) == (2, 0.5, 0.0)
    assert (got["all"]["errors"], got["all"]["parse_rate"], got["all"]["avg_latency_s"]) == (1, 0.0, 0.0)


def test_parse_of_many_texts_is_that_of_each():
    texts = ['{"a": 1} x', None, "NaN", '{"k": {"f": 1}, "k": {"g": "x"}}', "null", "[1]", "3", '"s"', "", "{}", '{"e": {"f": "v", "g": ["v", 1, null]}}',
             '{"a": {}, "b": [1, "x", null, [2]], "c": null, "d": 1.0, "e": true, "f": {"g": {"h": 1}, "i": ["\\ud83d", "y"], "j": "\\ud83d\\ude00", "k\\udc00": null}}']

    def s(v):
        return None if v is None else sc.whole(v)

    def vals(vs):
        return [{"s": s(a), "is_str": b} for a, b in vs]

    for text, got in zip(texts, sc.parse_all(texts).to_pylist(), strict=True):
        ok, kind, entries = parse_one(text)
        entries = entries and [
            {"key": s(k), "is_obj": o, "kind": kd, "sval": s(sv), "vals": vals(vs),
             "fields": None if fs is None else [{"name": s(n), "kind": fk, "sval": s(fv), "vals": vals(fvs)} for n, fk, fv, fvs in fs]}
            for k, o, kd, sv, vs, fs in entries]
        assert got == {"ok": ok, "kind": kind, "entries": entries}
    assert sc.parse_all([]).to_pylist() == []


def _star(spark, folder):
    """Six orders, the last without line items, one of them twice."""
    tables = {
        "customer": ([(1, "BUILDING"), (2, "MACHINERY")], "c_custkey long, c_mktsegment string"),
        "orders": ([(k, 1 + k % 2) for k in (0, 1, 2, 3, 4, 5, 5)], "o_orderkey long, o_custkey long"),
        "part": ([(1, "B1", "LARGE", 'a "b"'), (2, "B2", "ECONOMY", "c"), (3, "B1", "SMALL", "d\\e")], "p_partkey long, p_brand string, p_type string, p_name string"),
        "lineitem": ([(k, 1 + (k + i) % 3, 1, i, float(i)) for k in range(5) for i in range(1 + k)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_scored_twice_for_the_wide_round(spark):
    row = ("r", "extraction", '{"a": {"b": "c"}}', None, 0.5)
    df = spark.createDataFrame([row, row, ("r", None, "{", None, 1.0), (None, *row[1:])], "round string, group string, output string, error string, latency_s double")
    df = df.withColumns({"required_fields": F.array(F.lit("b")), "allowed_fields": F.array(F.lit("a"), F.lit("b")), "enum_constraints": F.create_map().cast("map<string,array<string>>")})
    wide = sc.round_wide(sc.score(df))
    assert _plan(wide).count("ArrowEvalPython") == 1
    (r,) = wide.collect()  # none of the rows without a round
    assert (r["total"], r["parse_rate"], r["extraction_total"], r["extraction_strict_rate"], r["total_time_s"]) == (3, 2 / 3, 2, 1.0, 2.0)
    assert (r["format_following_total"], r["format_following_parse_rate"]) == (0, None)


def test_outputs_meet_their_prompts_without_a_shuffle_of_texts(spark, tmp_path):
    from quarry.plans import scoring as ps

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = ps.scored(spark, _star(spark, tmp_path / "star"))
        plan = _plan(s)
        assert "SortMergeJoin" in plan and plan.count("REPARTITION_BY_NUM") == 2 and "Exchange hashpartitioning(id" in plan
        assert not [x for x in plan.split("\n") if "hashpartitioning(id" in x and "ENSURE_REQUIREMENTS" in x]
        got = s.groupBy("id").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["id"]: r["count"] for r in got} == {str(k): 3 for k in range(5)} | {"5": 12}  # two prompts of two outputs a model


def test_value_match_of_queries(spark, tmp_path):
    """Whole answers match gold, those that miss a field do not."""
    from quarry.plans import scoring as ps

    d = _star(spark, tmp_path / "star")
    got = ps.q_value_match(spark, d).collect()
    s = {(r.model, r.id): r for r in ps.scored(spark, d, value_match=True).collect()}
    assert got and {(r.model, r.id): (r.n_fields, r.n_match) for r in got} == {
        k: (len(r.value_match), sum(r.value_match.values())) for k, r in s.items() if r.value_match is not None}
    assert all(r.value_match is not None for r in s.values() if r.schema_strict and r.id != "5")


def test_detailed_report_is_written_compressed_and_read_whole(spark, tmp_path):
    import glob
    import gzip

    from quarry.plans import files
    from quarry.sources import io

    df = spark.createDataFrame([("a", 'x "y"\nz, '), ("b", None)], "model string, raw_output string")
    got = files._csv(spark, df, f"small-{tmp_path.name}", "model string, raw_output string")
    assert sorted(map(tuple, got.collect())) == [("a", 'x "y"\nz, '), ("b", None)]
    assert all(f.endswith(".csv.gz") for f in got.inputFiles())
    assert b"model,raw_output" in gzip.open(got.inputFiles()[0].removeprefix("file://")).read()
    io.write_csv(df, str(tmp_path / "plain"))  # other reports stay plain
    assert glob.glob(str(tmp_path / "plain" / "*.csv"))
