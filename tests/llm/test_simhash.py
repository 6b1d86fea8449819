import random
from collections import Counter

import numpy as np
import pytest

from quarry.llm import simhash
from quarry.llm.components import components

from .helpers import clashing, classes, edge_docs
from .helpers import simhash as plain


def test_fingerprints_and_components(spark):
    docs = clashing(edge_docs(spark))
    rows = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    want = classes(rows, lambda a, b: (a ^ b).bit_count() <= 4)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == Counter((i, f, c) for (i, f), c in zip(rows, want, strict=True))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [simhash.BLOCK, 16])
def test_dense_groups_lose_no_link(spark, monkeypatch, block):
    """A large cloud of fingerprints around few centres, also cut into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(5)
    values = set()
    for c in [r.getrandbits(64) for _ in range(4)]:
        for _ in range(150):
            v = c
            for b in r.sample(range(64), r.randrange(0, 6)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values | {r.getrandbits(64) for _ in range(200)})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)).collect()
    own = {v: i for i, v in enumerate(signed)}
    assert all((values[own[x.a]] ^ values[own[x.b]]).bit_count() <= 4 for x in links)
    linked = {frozenset((own[x.a], own[x.b])) for x in links}
    rows = [(i, (i, v)) for i, v in enumerate(values)]
    want = classes(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    assert classes(rows, lambda a, b: frozenset((a[0], b[0])) in linked) == want


def test_forest_spans_what_is_near():
    fp = np.array([0, 1, 3, 7, 15, 31, 2**63, 2**64 - 1], np.uint64)
    a, b = simhash.forest(fp, 1)
    assert len(a) == 6 and set(np.concatenate([a, b]).tolist()) == {0, 1, 2, 3, 4, 5, 6}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
