"""Packing, centroid clustering and the Merkle manifest against plain versions."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMOKE
from quarry.llm import centroids, cutting_stock, merkle, packing
from quarry.llm.queries import op11_packing, op12_centroid_clustering, op13_merkle_manifest

from .helpers import SCHEMA, clashing, edge_docs, sha

PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- 11: packing ---------------------------------------------------------------

def check_pieces(pieces, docs, size, end=0):
    """Every id of every row in one piece, sequences gapless and unpadded; rows
    with equal ids (repeated or null keys) are told apart by their pieces."""
    library = Tokenizer.from_file(PATH)
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, library.encode(r["text"] or "", add_special_tokens=False).ids + [end]) for r in docs)
    streams = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        streams.setdefault((p["doc_id"] is not None, p["doc_id"] or 0), []).append((p["start"], ids, p["doc_tokens"]))
    assert sum(p["length"] for p in pieces) == sum(len(w[2]) for w in want)
    for key, own in streams.items():
        texts = [w[2] for w in want if w[:2] == key]
        for start, ids, n in own:
            assert any(t[start : start + len(ids)] == ids and len(t) == n for t in texts)
        if len(texts) == 1:
            assert sum((ids for _, ids, _ in sorted(own)), []) == texts[0]
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sorted(by) == list(range(len(by)))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size and (at == size or at & (at - 1) == 0)


@pytest.mark.parametrize("size", [64, 1024])
def test_packing_of_edge_cases(spark, size):
    docs = clashing(edge_docs(spark))
    docs = docs.union(docs.where("doc_id = 6")).repartition(4)  # repeated rows
    pieces = packing.pack(docs, PATH, public_tokenizers.PATTERN, size).collect()
    check_pieces(pieces, docs.collect(), size)
    empty = packing.pack(docs.limit(0), PATH, public_tokenizers.PATTERN, size)
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    library = Tokenizer.from_file(PATH)
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs}
    pieces = op11_packing(spark, SMOKE).collect()
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))
    for p in pieces:
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and p["doc_tokens"] == len(ids[p["doc_id"]])


def test_one_hot_length_and_many_partitions(spark):
    rows = [(i, "a b c d e f g", None, "hot", 0) for i in range(300)] + [(1000 + i, " x" * (i % 90), None, None, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(23)
    check_pieces(packing.pack(docs, PATH, public_tokenizers.PATTERN, 64).collect(), docs.collect(), 64)


def best_value(lengths, demand, prices):
    """The least price over all whole plans, by search (tiny cases)."""
    cost = prices.sequence()

    def patterns(i, room):
        if i == len(lengths):
            yield ()
            return
        for n in range(room // lengths[i] + 1):
            for rest in patterns(i + 1, room - n * lengths[i]):
                yield (n, *rest)

    known = {}

    def search(left):
        if left not in known:
            known[left] = float(prices.stream(np.array(lengths)) @ np.array(left))
            for p in patterns(0, prices.size):
                total = sum(n * i for n, i in zip(p, lengths, strict=True))
                if total and math.isfinite(cost[total]) and all(n <= m for n, m in zip(p, left, strict=True)):
                    known[left] = min(known[left], cost[total] + search(tuple(m - n for n, m in zip(p, left, strict=True))))
        return known[left]

    return search(tuple(demand))


def test_column_generation_reaches_the_best_plan():
    prices = cutting_stock.Prices(16)
    for lengths, demand in (((3, 5, 8, 11), (2, 3, 2, 2)), ((7, 9), (4, 3)), ((6, 10, 4), (3, 3, 1)), ((15,), (3,))):
        program = cutting_stock.solve(np.array(sorted(lengths)), np.array([d for _, d in sorted(zip(lengths, demand, strict=True))]), prices, gap=1e-9)
        whole = best_value([i for i, _ in sorted(zip(lengths, demand, strict=True))], [d for _, d in sorted(zip(lengths, demand, strict=True))], prices)
        assert program.value() <= whole + 0.01  # the demands are uneven by a thousandth
    # prices that no pattern and no stream place beats prove a plan the best one
    rng = np.random.default_rng(0)
    lengths, demand, prices = np.arange(1, 64), rng.integers(50, 500, 63), cutting_stock.Prices(64)
    start, program = cutting_stock.Program(lengths, demand, prices).value(), cutting_stock.solve(lengths, demand, prices, gap=0)
    y = program.duals()
    best = [0.0] + [-math.inf] * 64
    for total in range(1, 65):
        best[total] = max(best[total - i] + y[i - 1] for i in range(1, 64) if i <= total)
    cost = prices.sequence()
    assert all(best[t] <= cost[t] + 1e-6 for t in range(1, 65)) and (y <= prices.stream(lengths) + 1e-6).all()
    assert abs(program.value() - y @ program.demand) < 1e-6 * program.value() and program.value() < start


def test_rounded_plan_accounts_for_every_piece():
    rng = np.random.default_rng(3)
    for _ in range(20):
        size = int(rng.choice([16, 64]))
        histogram = {int(i): int(rng.integers(1, 30)) for i in rng.choice(np.arange(1, size), rng.integers(1, size - 1), replace=False)}
        plan = cutting_stock.rounded(histogram, cutting_stock.Prices(size))
        for copies, p in zip(plan.copies, plan.patterns, strict=True):
            total = sum(i * n for i, n in p.items())
            assert copies > 0 and total <= size and total & (total - 1) == 0
        used = {i: sum(c * p.get(i, 0) for c, p in zip(plan.copies, plan.patterns, strict=True)) for i in histogram}
        assert all(used[i] + plan.left[i] == n and plan.left[i] >= 0 for i, n in histogram.items())
    assert cutting_stock.rounded({}, cutting_stock.Prices(16)).copies == []


# ---- 12: centroid clustering -----------------------------------------------------

def plain_clusters(rows, k, rounds, size, scale):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, [min(max(math.floor(scale * x), -(1 << 62)), 1 << 62) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))
    ends = [list(v) for _, v in order[:k]]

    def near(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in ends]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[0], []).append(v)
        for c, vs in own.items():
            ends[c] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return sorted((key is not None, key or 0, *near(v)) for key, v in kept), ends


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "mine", 1) for k, v in rows], "vec_id long, embedding array<double>, cluster string, key int").repartition(3)


def vector_cases():
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-8, 9, 4) / 64).tolist()) for i in range(120)]
    rows += [(500, rows[0][1]), (0, rows[0][1]), (0, rows[5][1]), (None, rows[7][1]), (600, [0.1, -0.1, 0.007, -0.015])]
    rows += [(700, None), (701, []), (702, [1.0] * 3), (703, [1.0] * 5), (704, [1.0, None, 0.0, 0.0]), (705, [float("nan")] * 4), (706, [float("inf"), 0.0, 0.0, 0.0])]
    return rows


def test_clustering_equals_the_plain_version(spark):
    rows = vector_cases()
    for extra in ([], [(800, [3e9, 0.0, 0.0, 0.0]), (801, [-3e30, 1.0, 0.0, 0.0])]):  # beyond 64 bits: exact too
        got, ends = centroids.cluster(vectors(spark, rows + extra), k=5, size=4)
        want, plain = plain_clusters(rows + extra, 5, 3, 4, 64)
        found = got.collect()
        assert ends == plain
        least = (1 << 63) - 1
        assert sorted((r.vec_id is not None, r.vec_id or 0, r.cluster, r.distance) for r in found) == [(*w[:3], min(w[3], least)) for w in want]
        total = {}
        for w in want:
            total[w[2]] = total.get(w[2], 0) + min(w[3], least)
        assert all(r.cluster_inertia == min(total[r.cluster], least) and r.inertia == min(sum(total.values()), least) for r in found)


def test_clustering_of_few_or_no_vectors(spark):
    rows = vector_cases()
    got, ends = centroids.cluster(vectors(spark, rows[:3]), size=4)
    assert len(ends) == 3 and {r.distance for r in got.collect()} == {0}
    for none in (vectors(spark, rows[-7:]), vectors(spark, rows).limit(0)):
        got, ends = centroids.cluster(none, size=4)
        assert ends == [] and got.count() == 0


def test_clustering_does_not_depend_on_partitions(spark):
    table = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    a, first = centroids.cluster(table.repartition(1))
    b, second = centroids.cluster(table.repartition(9))
    assert first == second and sorted(a.collect()) == sorted(b.collect())
    assert op12_centroid_clustering(spark, SMOKE).count() == a.count()


# ---- 13: Merkle manifest -----------------------------------------------------------

def said(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r):
    return sha("".join(said(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(nodes):
    paths, own = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for j in range(len(run)):
                for leaf in own[i + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            below.append(sum(own[i : i + 3], []))
        nodes, own = up, below
    return nodes[0], paths


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {g: tree([t[2] for t in sorted(groups[g], key=lambda t: t[:3])]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for t, path in zip(sorted(groups[g], key=lambda t: t[:3]), trees[g][1], strict=True):
            r, full = dict(t[3]), path + top
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                r["text"] = r["text"].replace("\n", "")
            h = leaf_of(r)
            for a, b in full:
                h = sha(a + h + b)
            out.append((str(r["doc_id"]), t[2], trees[g][0], root, sha("".join(a + b for a, b in full)), h, h == root))
    return sorted(out)


def manifest_of(spark, docs, tmp_path):
    path = f"{tmp_path}/in"
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    found = op13_merkle_manifest(spark, path)
    return sorted((str(r[0]), *r[1:]) for r in found.collect())


def test_manifest_of_edge_cases(spark, tmp_path):
    docs = clashing(edge_docs(spark))
    docs = docs.union(docs.where("doc_id = 6"))  # repeated rows
    docs = docs.union(docs.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("é")}).limit(5)).union(docs.withColumn("source", F.lit("-")).limit(1))
    assert manifest_of(spark, docs, tmp_path) == plain_manifest([r.asDict() for r in docs.collect()])
    assert manifest_of(spark, docs.limit(0), tmp_path) == []
    assert manifest_of(spark, docs.limit(1), tmp_path) == plain_manifest([r.asDict() for r in docs.limit(1).collect()])


@pytest.mark.parametrize("depth", [1, 2])
def test_manifest_over_several_passes(spark, tmp_path, monkeypatch, depth):
    """Blocks of 3 and 9 leaves: trees of groups, and the one over groups, take
    several passes; one group holds most rows."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    sizes = {"hot": 100, None: 1, "": 2, "b": 3, "c": 4, "d": 9, "e": 10, "f": 27, "g": 28, "ü": 5, "z": 1}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 1009, f"line {i}\nnext" if i % 3 else None, None, source, i))
            i += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert manifest_of(spark, docs, tmp_path) == plain_manifest([r.asDict() for r in docs.collect()])


def test_manifest_finds_any_change(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 4}", i) for i in range(40)], SCHEMA)
    for claim, bad in ((F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text")), {7}), (F.concat("text", F.lit(" ")), set(range(40)))):
        rows = merkle.manifest(docs, ["doc_id", "text"], "doc_id", "source", {"text": claim}).collect()
        assert {r.doc_id for r in rows if r.folded != r.root} == bad
        assert len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 4
    assert hashlib.sha256(b"").hexdigest() == sha("")
