"""Secret scans: patterns, and a token-efficiency test for random strings.

Base kinds are leftmost non-overlapping pattern matches.  The method adds the
kind ``random``: a run of key characters whose characters-per-token ratio
under a public byte-level vocabulary is low, which it hardly ever is for
natural words and names, after known digests (hex of a digest's length) and
identifiers (UUIDs; alphabets; paths, versions and names made of whole words or
numbers) are left out.  One narrow pass; offsets are code points, ends exclusive.

Defined cases: null text = empty text = no spans; overlapping spans of
different kinds are all reported and redacted as one; repeated rows give
repeated results; an empty table gives an empty result; a very long text is
read whole, and a long run costs no more than its length; other columns pass
through ``redact`` untouched.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import scan as segments
from quarry.llm.ragged import slices

KINDS = ("assign", "access", "hex", "random")

#: The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a whole run, so the same as longer matches of the open pattern
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

#: Runs that may be random keys, and what is known not to be one.
KEY_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)
WHOLE = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)")
#: Alphabets, from any letter on, once or again.
ORDERED = re.compile(rf"(?:{'|'.join(''.join(chr(97 + (k + i) % 26) for i in range(26)) for k in range(26))})+[a-z]*", re.I)
#: Characters per token below which a run counts as random.
MAX_RATIO = 2.0

_encodings: dict[int, tiktoken.Encoding] = {}


def ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token, blank, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoding(pattern: str, table: dict[bytes, int]) -> tiktoken.Encoding:
    if id(table) not in _encodings:
        _encodings.clear()
        _encodings[id(table)] = tiktoken.Encoding("keys", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encodings[id(table)]


def known(run: str) -> bool:
    """A digest, a UUID, or pieces that are all whole words or numbers."""
    if DIGEST.fullmatch(run) or UUID.fullmatch(run):
        return True
    pieces = [p for p in re.split(r"[/_+=-]+", run) if p]
    return len(pieces) > 1 and all(WHOLE.fullmatch(p) for p in pieces)


def is_random(run: str, enc: tiktoken.Encoding) -> bool:
    """Few characters a token, and nothing known.  Letters of one case are no
    exception; capitals are judged in lower case too, as the vocabulary has
    most words in lower case."""
    if run.isdigit() or known(run) or ORDERED.fullmatch(run):
        return False
    if len(run) >= MAX_RATIO * len(enc.encode_ordinary(run)):
        return False
    return not (run.isalpha() and run.isupper()) or len(run) < MAX_RATIO * len(enc.encode_ordinary(run.lower()))


#: Pieces of a run: identifiers and digests stay whole and end a stretch.
PIECE = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+", re.I)
LEAST = 20


def maximal(values: list[float]) -> list[tuple[int, int]]:
    """(first, end) of all maximal stretches with a positive sum, in linear time."""
    steps, lost = [], 0.0
    for i, v in enumerate(values):
        if v > 0:
            steps.append((i, i + 1, lost, v))
            lost = 0.0
        else:
            lost -= v
    return [(a, b) for a, b, _ in segments.maximal(steps)]


def random_stretches(run: str, enc: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run: all of it, or stretches of
    pieces, or, where a stretch is known, single pieces of it."""
    if is_random(run, enc):
        return [(0, len(run))]
    pieces = list(PIECE.finditer(run))
    if len(pieces) < 2:
        return []
    barrier = -float(2 * MAX_RATIO * len(run))
    tokens = enc.encode_ordinary_batch([p[0] for p in pieces], num_threads=1)
    values = [barrier if DIGEST.fullmatch(p[0]) or UUID.fullmatch(p[0]) else MAX_RATIO * len(t) - len(p[0]) for p, t in zip(pieces, tokens, strict=True)]
    out = []
    for first, end in maximal(values):
        a, b = pieces[first].start(), pieces[end - 1].end()
        if b - a >= LEAST and is_random(run[a:b], enc):
            out.append((a, len(run) if not run[b:].strip("=") else b))
        else:
            out += [p.span() for p in pieces[first:end] if len(p[0]) >= LEAST and is_random(p[0], enc)]
    return out


def spans(s: str, enc: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """(start, kind number, end), in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(s) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(s)]
    out += [(m.start() + a, 3, m.start() + b) for m in KEY_RUN.finditer(s) for a, b in random_stretches(m[0], enc)]
    return sorted(out)


SPANS = "array<struct<kind:string,start:long,end:long>>"


def scan(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``spans``, sorted by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks(rank_path))
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    schema = chosen.drop("__text").withColumn("spans", F.array().cast(SPANS)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        enc = encoding(pattern, shared.value)
        for part in slices(batches, "__text"):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(s, enc)] if s else [] for s in part.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(found, kind)], [*keep, "spans"])

    return chosen.mapInArrow(run, schema)


def masked(s: str, found: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for a, _, b in found:
        if a >= at:
            out += [s[at:a], mask]
        at = max(at, b)
    return "".join([*out, s[at:]])


def redact(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every run of found spans replaced by ``mask``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks(rank_path))
    names = docs.columns

    def run(batches):
        enc = encoding(pattern, shared.value)
        for part in slices(batches, text):
            said = [masked(s, found, mask) if s and (found := spans(s, enc)) else s for s in part.column(text).to_pylist()]
            at = names.index(text)
            yield pa.RecordBatch.from_arrays([pa.array(said, pa.string()) if i == at else c for i, c in enumerate(part.columns)], names)

    return docs.mapInArrow(run, docs.schema)


def joined(kinds: tuple[str, ...]):
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number(kind: str):
    """How many spans are of this kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
