"""Byte-pair merging of many words at once, on flat arrays.

The symbols of all words lie in one array; a pair's rank comes from a binary
search over sorted pair keys.  In every round each word applies its own
lowest-rank pair at all its places (left to right, without overlap), so the
number of rounds follows the longest word, not the number of words.  A pair
that contains a merged symbol always ranks after the merge that made it, so
this equals the one-at-a-time order of the reference libraries.
"""

from __future__ import annotations

import json

import numpy as np

NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte:
    visible Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, sorted pair keys and ranks of one ``tokenizers`` BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = f.read()
        spec = json.loads(self.spec)
        model = spec["model"]
        ids = dict(model["vocab"])
        suffix = model.get("end_of_word_suffix") or ""
        chars = byte_symbols()
        self.first = np.array([ids.get(c, -1) for c in chars], np.int32)
        self.last = np.array([ids.get(c + suffix, -1) for c in chars], np.int32) if suffix else self.first
        left, right, made = [], [], []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left.append(ids[a])
            right.append(ids[b])
            made.append(ids[a + b])
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array(made, np.int32)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: s for s, i in ids.items()} | {i: s for s, i in self.added.items()}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def symbols(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Initial symbols of the words and the bounds of each word."""
        data = np.frombuffer(b"".join(strings), np.uint8)
        bounds = np.zeros(len(strings) + 1, np.int64)
        np.cumsum([len(s) for s in strings], out=bounds[1:])
        sym = self.first[data]
        ends = bounds[1:][np.diff(bounds) > 0] - 1
        sym[ends] = self.last[data[ends]]
        return sym, bounds

    def merge(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, bounds of each word) after all merges."""
        sym, bounds = self.symbols(strings)
        lengths = np.diff(bounds)
        word = np.repeat(np.arange(len(strings)), lengths)
        if (sym < 0).any():  # a byte without a symbol is left out
            word, sym = word[sym >= 0], sym[sym >= 0]
        done_sym, done_word = [], []
        rank = self._ranks(sym, word)
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            live = np.repeat(low != NONE, size)
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, rank = sym[live], word[live], rank[live]
                if not len(sym):
                    break
                size, low = size[low != NONE], low[low != NONE]
            hit = rank == np.repeat(low, size)
            at = np.flatnonzero(hit)
            if len(at) > 1:  # x x x: take every second one of a run of touching pairs
                step = np.diff(at) == 1
                if step.any():
                    begin = np.concatenate([[True], ~step])
                    run = np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - run) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            fresh = new[at]
            sym, word, rank = sym[keep], word[keep], rank[keep]
            fresh = np.unique(np.concatenate([fresh, fresh[fresh > 0] - 1]))
            rank[fresh] = self._ranks(sym, word, fresh)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(len(strings) + 1))

    def _ranks(self, sym, word, at=None):
        """Rank of the pair that starts at each place (NONE at a word's end)."""
        n = len(sym)
        at = np.arange(n) if at is None else at
        out = np.full(len(at), NONE, np.int32)
        inner = at < n - 1
        i = at[inner]
        same = word[i] == word[i + 1]
        j = i[same]
        got = np.full(len(i), NONE, np.int32)
        got[same] = self.rank(sym[j], sym[j + 1])
        out[inner] = got
        return out


class WordCache:
    """What each distinct word became; emptied when it is full, so a task's
    memory stays bounded while results never depend on it."""

    def __init__(self, encode, limit: int = 400_000):
        self.known: dict = {}
        self.encode, self.limit = encode, limit

    def learn(self, lists: list[list[str]]) -> dict:
        fresh = set().union(*lists) - self.known.keys() if lists else set()
        if fresh:
            if len(self.known) + len(fresh) > self.limit:
                self.known.clear()
                fresh = set().union(*lists)
            fresh = list(fresh)
            self.known.update(zip(fresh, self.encode(fresh), strict=True))
        return self.known
