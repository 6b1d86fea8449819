import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import phrase_index

from .helpers import ALNUM, clashing, edge_docs, edge_texts, lower, phrase_hits


def items(spark):
    t = edge_texts()
    rows = [(1, " ".join(t[10].split()[20:60])), (2, "one two three"), (3, None), (4, ""), (5, "ONE, two; three"), (2, "w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20"), (None, "ab ab ab"), (6, "Straße été")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [phrase_index.BLOCK_WORDS, 10])
def test_equals_plain_search(spark, block):
    docs = clashing(edge_docs(spark))
    got = phrase_index.find(docs, items(spark), keep=("doc_id", "text", "n_chars"), block_words=block).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(*key, n, hit, tuple(sorted(i for i in found if i is not None))) for key, (n, hit, found) in zip(rows, phrase_hits(rows, [tuple(r) for r in items(spark).collect()]), strict=True)]
    assert Counter((r.doc_id, r.text, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r["items"])) for r in got) == Counter(want)
    assert all(set(r["items"]) <= set(r.near_items) for r in got if r["items"] and max(r["items"]) == 1)


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "zebra filler filler quartz more lemon words onyx"), (2, "zebra " + "far " * 60 + "quartz lemon onyx"), (3, "zebra quartz lemon")], "doc_id long, text string")
    test = spark.createDataFrame([(9, "onyx lemon quartz zebra")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in phrase_index.find(docs, test).collect()}
    assert got == {1: ([], [9]), 2: ([], []), 3: ([], [])}


def test_near_matches_do_not_depend_on_the_shard(spark):
    said = [f"term{i}" for i in range(40)]
    altered = " ".join(f"swap{i}" if i % 6 == 5 else w for i, w in enumerate(said))
    rows = [(1, altered), (2, "blue sky"), (3, "blue then a few words later sky"), (4, "blue " + "far " * 40 + "sky"), (5, "nothing of it"), (6, "echo echo echo echo and more")]
    rows += [(100 + i, f"{said[i]} term{i} other") for i in range(0, 40, 3)]
    test = spark.createDataFrame([(7, " ".join(said)), (8, "Blue sky"), (9, "echo echo echo mountain river")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [{r.doc_id: (r["items"], r.near_items) for r in phrase_index.find(docs.repartition(n, "doc_id"), test, block_words=w).collect()} for n, w in ((1, 10_000), (len(rows), 10_000), (3, 20))]
    assert got[0] == got[1] == got[2]
    assert {k: v for k, v in got[0].items() if any(v)} == {1: ([], [7]), 2: ([8], [8]), 3: ([], [8])}


def plain_near(docs, items, terms=4, span=24, size=13):
    """Near items by the rule: the rarest distinct terms that occur at all lie
    within a span on either side of the rarest one."""
    words = [ALNUM.findall(lower(t or "")) for _, t in docs]
    often = Counter(w for ws in words for w in ws)
    out = [set() for _ in docs]
    for i, t in items:
        ws = ALNUM.findall(lower(t or ""))
        for k in range(max(1, len(ws) - size + 1) if ws else 0):
            phrase = list(dict.fromkeys(ws[k : k + size]))
            asked = sorted((w for w in phrase if often[w]), key=lambda w: often[w])
            if i is None or len(asked) < min(terms, len(phrase)):
                continue
            # ties in rarity go by the order in the phrase
            asked = asked[:terms]
            for d, own in enumerate(words):
                centres = [p for p, w in enumerate(own) if w == asked[0]]
                if any(all(w in own[max(0, c - span) : c + span + 1] for w in asked[1:]) for c in centres):
                    out[d].add(i)
    return out


@pytest.mark.parametrize("block", [phrase_index.BLOCK_WORDS, 40])
def test_near_items_equal_plain_search(spark, block):
    r = random.Random(9)
    words = [f"t{i}" for i in range(60)]
    docs = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(60)], k=r.randrange(0, 120)))) for i in range(60)]
    test = [(i, " ".join(r.choices(words, k=r.randrange(1, 30)))) for i in range(25)] + [(3, docs[5][1]), (None, docs[6][1]), (50, "unseen words only"), (51, "t1 unseen t2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = phrase_index.find(frame, spark.createDataFrame(test, "item_id long, text string"), block_words=block).collect()
    want = plain_near(docs, test)
    hits = phrase_hits(docs, test)
    assert {x.doc_id: (set(x.near_items), set(x["items"])) for x in found} == {i: (want[i], {k for k in hits[i][2] if k is not None}) for i, _ in docs}


def test_a_stored_index_serves_several_test_sets(spark, tmp_path):
    docs = clashing(edge_docs(spark))
    made = phrase_index.index(docs, keep=("doc_id", "n_chars"))
    made.write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    for test in (items(spark), items(spark).limit(2), items(spark).limit(0)):
        for block in (phrase_index.BLOCK_WORDS, 10):
            fresh = phrase_index.find(docs, test, keep=("doc_id", "n_chars"), block_words=block).collect()
            again = phrase_index.find(None, test, keep=("doc_id", "n_chars"), block_words=block, stored=stored).collect()
            assert Counter(map(str, fresh)) == Counter(map(str, again))


def test_text_ids_and_clashing_keeps(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma")], "doc_id long, text string").withColumn("spans", F.lit("mine"))
    test = spark.createDataFrame([("item-a", "beta gamma"), ("item-b", "delta")], "name string, body string")
    got = phrase_index.find(docs, test, item_id="name", item_text="body").first()
    assert got["items"] == ["item-a"] and got["n_words"] == 3
    with pytest.raises(ValueError):
        phrase_index.find(docs, test, item_id="name", item_text="body", keep=("doc_id", "spans"))


def test_empty_tables(spark):
    docs = edge_docs(spark)
    assert all(not r.spans for r in phrase_index.find(docs, items(spark).limit(0)).collect())
    assert phrase_index.find(docs.limit(0), items(spark)).count() == 0


def test_hashes_do_not_depend_on_blocks():
    import numpy as np

    from quarry.llm.ragged import NOT_BLANK, Hashes, flat, span_hashes, words

    import pyarrow as pa

    data, offsets = flat(pa.array([" ".join(f"w{i % 97}" for i in range(4000)), None, "x" * 3000, "a b"], pa.string()))
    starts, ends, _, _ = words(data, offsets, NOT_BLANK)
    assert np.array_equal(span_hashes(data, starts, ends, block=64), Hashes(data).of(starts, ends))
