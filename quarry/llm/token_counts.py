"""Token counts by rank-synchronous array merging.

Each task cuts its texts into pre-tokens, holds the ones it has not met as
ragged arrays, applies every pre-token's lowest-rank pair at the same time,
and counts the symbols that survive.  It is one narrow pass: no shuffle, and
no state beyond a bounded cache.

Defined cases: null text = empty text = 0 tokens; repeated rows give repeated
results; very long texts are one slice of their own; other columns are only
read when named in ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe_arrays import Vocabulary, WordCache
from quarry.llm.ragged import flat, slices


def splitter(added: dict[str, int]):
    """A pattern for the added tokens (longest first), or None."""
    names = sorted(added, key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, names))) if names else None


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_bytes`` and ``n_tokens`` of every row of ``docs``.

    ``vocabulary``: path of a byte-level ``tokenizers`` BPE file; ``pattern``:
    its pre-token pattern.  An added token inside a text counts as one."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))  # a vocabulary file: bounded
    cols = [*keep, "text"]
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("text"))
    schema = chosen.drop("text").withColumns({"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema

    def run(batches):
        vocab = shared.value
        special, cut = splitter(vocab.added), regex.compile(pattern)

        def lengths(fresh):
            return np.diff(vocab.merge([w.encode() for w in fresh])[1]).tolist()

        cache = WordCache(lengths)
        for part in slices(batches, "text"):
            column = part.column("text")
            _, offsets = flat(column)
            lists, extra = [], np.zeros(part.num_rows, np.int64)
            for i, s in enumerate(column.to_pylist()):
                if not s:
                    lists.append([])
                elif special is not None and (hits := special.findall(s)):
                    extra[i] = len(hits)
                    lists.append([w for piece in special.split(s) for w in cut.findall(piece)])
                else:
                    lists.append(cut.findall(s))
            known = cache.learn(lists)
            counts = np.array([sum(map(known.__getitem__, ws)) for ws in lists], np.int64) + extra
            arrays = [part.column(c) for c in cols[:-1]]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.diff(offsets)), pa.array(counts)], [*cols[:-1], "n_bytes", "n_tokens"])

    return chosen.mapInArrow(run, schema)
