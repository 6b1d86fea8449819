import random
from collections import Counter

import pytest

from quarry.llm import repeats

from .helpers import clashing, edge_docs, kept_bytes


def check(docs, **kw):
    rows = docs.collect()
    want = kept_bytes([r.text for r in rows], kw.get("length", 200))
    got = repeats.remove_repeats(docs, **kw).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == Counter((r.doc_id, len((r.text or "").encode()), k) for r, k in zip(rows, want, strict=True))
    for r in got:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
        assert sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept)


def test_edge_table(spark):
    check(clashing(edge_docs(spark)))
    assert repeats.remove_repeats(edge_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, monkeypatch, seed, group):
    """Few letters, periods and shared passages; with ``group`` 1 every anchor
    takes the way of the very frequent ones."""
    monkeypatch.setattr(repeats, "GROUP", group)
    r = random.Random(seed)
    base = ["".join(r.choice("abé") for _ in range(60)) for _ in range(4)]
    texts = []
    for _ in range(60):
        s = "".join(r.choice(base)[r.randrange(30) : r.randrange(30, 61)] + "".join(r.choice("ab") for _ in range(r.randrange(4))) for _ in range(r.randrange(4)))
        texts.append(s if r.random() < 0.9 else r.choice(["ab" * 20, "a" * 50, ""]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    check(docs, length=20, gram=6)


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 256)
    r = random.Random(3)
    s = "".join(r.choice("abcdef") for _ in range(3000))
    check(spark.createDataFrame([(1, s), (2, "zz" + s[700:1300] + "yy"), (3, s[:100] + s[:100])], "doc_id long, text string"), length=50, gram=16)
