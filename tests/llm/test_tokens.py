import struct
from collections import Counter

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import token_counts, word_bpe
from quarry.llm.bpe_arrays import Vocabulary, WordCache

from .helpers import clashing, edge_docs, sha


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json")), Vocabulary(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(P.path("word_bpe_49k.json")), Vocabulary(P.path("word_bpe_49k.json"))


def test_counts_equal_the_library(spark, byte):
    docs = clashing(edge_docs(spark))
    got = token_counts.token_counts(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(byte[0].encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == Counter(want)
    assert token_counts.token_counts(docs.limit(0), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_coding_equals_the_library(spark, word):
    docs, path = clashing(edge_docs(spark)), P.path("word_bpe_49k.json")
    got = word_bpe.decode(word_bpe.encode(docs, path), path).collect()
    want = []
    for r in docs.collect():
        ids = word[0].encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), word[0].decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, r.n_tokens, sha(bytes(r.ids)), r.decoded) for r in got) == Counter(want)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(byte, word, s):
    import regex

    ids, _ = byte[1].merge([w.encode() for w in regex.findall(P.PATTERN, s)])
    if "<|" not in s:
        assert ids.tolist() == byte[0].encode(s, add_special_tokens=False).ids
        ids, _ = word[1].merge([w.encode() for w in word_bpe.Cutter(word[1].spec)(s)])
        assert ids.tolist() == word[0].encode(s, add_special_tokens=False).ids


def test_overlapping_pairs_and_bounds(byte):
    words = [b"aaaaaaa", b"", b"a", b"ababababab" * 50, b"\xff\x00"]
    ids, bounds = byte[1].merge(words)
    names = byte[1].tokens
    assert len(bounds) == len(words) + 1 and bounds[1] == bounds[2]
    assert "".join(names[i] for i in ids[bounds[3] : bounds[4]]) == "ababababab" * 50


def test_full_cache_changes_nothing():
    cache = WordCache(lambda ws: [len(w) for w in ws], limit=3)
    for lists in ([["a", "bb"]], [["ccc", "dddd"], ["a"]], [["a", "b", "c", "d", "e"]]):
        known = cache.learn(lists)
        assert all(known[w] == len(w) for ws in lists for w in ws)
