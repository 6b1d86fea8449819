"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array; the lowest-rank pairs are
found by binary search over sorted pair keys (``bpe_arrays``).  One narrow
pass encodes, a second turns ids back into text; nothing is shuffled.

Defined cases: null text = empty text = no ids and an empty decoded text;
repeated rows give repeated results; an empty table gives an empty result;
columns named like the outputs are not carried unless listed in ``keep``.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.bpe_arrays import Vocabulary, WordCache, byte_symbols
from quarry.llm.ragged import slices
from quarry.llm.token_counts import splitter

#: Fixed value of the vocabulary file: what counts as one word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Code points whose case and class no Unicode version has changed since the
#: library's tables were made; other texts are cut by the library's own rules.
SETTLED = regex.compile("[\x00-\u0557\u2010-\u2027\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f5ff]*+")


def normalized(s: str) -> str:
    """NFC, then lower case character by character (no final sigma)."""
    return unicodedata.normalize("NFC", s).replace("Σ", "σ").lower()


class Cutter:
    """Words of a text, as the vocabulary file says."""

    def __init__(self, spec: str):
        self.spec, self.cut, self.library = spec, regex.compile(WORD_PATTERN), None
        self.byte = {c: b for b, c in enumerate(byte_symbols())}

    def __call__(self, s: str) -> list[str]:
        if SETTLED.fullmatch(s):
            return self.cut.findall(normalized(s))
        if self.library is None:
            self.library = Tokenizer.from_str(self.spec)
        said = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(s))
        return [bytes(map(self.byte.__getitem__, w)).decode() for w, _ in said]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``ids`` (binary: little-endian
    unsigned 32-bit integers) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    schema = chosen.drop("__text").withColumns({"n_tokens": F.lit(0).cast("long"), "ids": F.lit(b"").cast("binary")}).schema

    def run(batches):
        vocab = shared.value
        special, cut = splitter(vocab.added), Cutter(vocab.spec)

        def packed(fresh):
            ids, bounds = vocab.merge([w.encode() for w in fresh])
            raw = ids.astype("<u4").tobytes()
            at = (bounds * 4).tolist()
            return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

        cache = WordCache(packed)
        names = {s: int(i).to_bytes(4, "little") for s, i in vocab.added.items()}
        for part in slices(batches, "__text"):
            plans, lists = [], []
            for s in part.column("__text").to_pylist():
                if s and special is not None and special.search(s):
                    bits, at = [], 0
                    for m in special.finditer(s):
                        bits += [cut(s[at : m.start()]), names[m[0]]]
                        at = m.end()
                    bits.append(cut(s[at:]))
                else:
                    bits = [cut(s)] if s else []
                plans.append(bits)
                lists += [b for b in bits if isinstance(b, list)]
            known = cache.learn(lists)
            ids = [b"".join(b if isinstance(b, bytes) else b"".join(map(known.__getitem__, b)) for b in bits) for bits in plans]
            arrays = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], [*keep, "n_tokens", "ids"])

    return chosen.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``: the tokens of ``ids`` with a
    blank between them (the file names no decoder)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary).tokens)
    schema = encoded.withColumn("decoded", F.lit("")).schema
    names = encoded.columns

    def run(batches):
        token = shared.value.__getitem__
        for part in slices(batches, "ids"):
            said = [" ".join(map(token, np.frombuffer(b, "<u4").tolist())) if b else "" for b in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(said, pa.string())], [*names, "decoded"])

    return encoded.mapInArrow(run, schema)
