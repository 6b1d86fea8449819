"""Cutting stock by column generation, on one histogram of lengths.

A column is a pattern: how many pieces of each length share one sequence.  The
linear program covers every piece either by a pattern or by a place in the
stream of pieces that may be cut, at the least price; a dynamic program over
the knapsack of one sequence prices the patterns that could still enter.  The
size of everything here follows the sequence length, not the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TINY, PIVOT = 1e-9, 1e-6


@dataclass
class Prices:
    """What a sequence of each total costs, and a piece in the cut stream."""

    size: int
    per_sequence: float = 1 / 64
    per_cut: float = 1 / 16

    def sequence(self) -> np.ndarray:
        """By total.  Only totals that need no padding, the powers of two, can
        be patterns: the cut stream has no padding either."""
        total = np.arange(self.size + 1)
        whole = (total & (total - 1)) == 0
        return np.where(whole, total / self.size + self.per_sequence, np.inf)

    def stream(self, lengths: np.ndarray) -> np.ndarray:
        """A piece is cut as often as it meets the end of a sequence."""
        return lengths / self.size * (1 + self.per_sequence + self.per_cut)


def knapsack(lengths: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(best value of pieces that fill a total exactly, last piece), by total."""
    best, last = np.full(size + 1, -np.inf), np.full(size + 1, -1)
    best[0] = 0.0
    for total in range(1, size + 1):
        fit = int(np.searchsorted(lengths, total, side="right"))
        if fit:
            got = best[total - lengths[:fit]] + value[:fit]
            last[total] = got.argmax()
            best[total] = got[last[total]]
    return best, last


def pattern(last: np.ndarray, lengths: np.ndarray, total: int, first: int | None = None) -> dict[int, int]:
    """{index of length: pieces} that the dynamic program chose."""
    out: dict[int, int] = {}
    if first is not None:
        out[first] = 1
        total -= int(lengths[first])
    while total > 0:
        i = int(last[total])
        out[i] = out.get(i, 0) + 1
        total -= int(lengths[i])
    return out


class Program:
    """The restricted program in revised form, one row for each length.

    First basis: from the longest piece down, a pattern of the pieces that are
    left runs until one of its lengths is used up, so the columns are
    triangular; a length that no pattern can hold goes to the stream."""

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, prices: Prices):
        m = len(lengths)
        # uneven by under a thousandth of a piece, so that steps are rarely empty
        uneven = np.arange(1, m + 1) * 0.6180339887 % 1 / 1000
        self.lengths, self.demand, self.stream = lengths, demand + uneven, prices.stream(lengths)
        self.columns: list[dict[int, int]] = [{}] * m
        self.is_pattern = np.zeros(m, bool)
        self.cost, self.amount, self.pivots = self.stream.copy(), np.zeros(m), 0
        left, there, of_sequence = self.demand.copy(), np.ones(m, bool), prices.sequence()
        while there.any():
            have = np.flatnonzero(there)
            best, last = knapsack(lengths[have], (lengths[have] / prices.size) ** 2, prices.size)
            longest = int(have[-1])
            rest = prices.size - int(lengths[longest])
            if best[rest] > -np.inf:
                column = {int(have[i]): n for i, n in pattern(last, lengths[have], rest).items()}
                column[longest] = column.get(longest, 0) + 1
                out = min(column, key=lambda i: left[i] / column[i])
                amount, cost = left[out] / column[out], of_sequence[prices.size]
            else:
                column, out, amount, cost = {longest: 1}, longest, left[longest], self.stream[longest]
            for i, n in column.items():
                left[i] = max(0.0, left[i] - amount * n)
            there[out] = False
            self.columns[out], self.amount[out], self.cost[out], self.is_pattern[out] = column, amount, cost, best[rest] > -np.inf
        self._refresh()

    def _refresh(self) -> None:
        basis = np.zeros((len(self.lengths), len(self.lengths)))
        for j, c in enumerate(self.columns):
            basis[list(c), j] = list(c.values())
        self.inverse = np.linalg.inv(basis)
        self.amount = np.maximum(self.inverse @ self.demand, 0.0)

    def duals(self) -> np.ndarray:
        return self.cost @ self.inverse

    def value(self) -> float:
        return float(self.cost @ self.amount)

    def enter(self, column: dict[int, int], cost: float, is_pattern: bool) -> bool:
        at = list(column)
        move = self.inverse[:, at] @ np.array([column[i] for i in at], float)
        if not (move > PIVOT).any():
            return False
        ratio = np.full(len(move), np.inf)
        np.divide(self.amount, move, out=ratio, where=move > PIVOT)
        r = int(np.where(ratio <= ratio.min() + TINY, move, 0.0).argmax())  # of ties, the safest divisor
        step = max(ratio[r], 0.0)
        self.amount -= step * move
        self.amount[r] = step
        np.maximum(self.amount, 0.0, out=self.amount)
        row = self.inverse[r] / move[r]
        self.inverse -= np.outer(move, row)
        self.inverse[r] = row
        self.columns[r], self.cost[r], self.is_pattern[r] = column, cost, is_pattern
        self.pivots += 1
        if self.pivots % 512 == 0:  # rounding errors do not add up
            self._refresh()
        return True


def solve(lengths: np.ndarray, demand: np.ndarray, prices: Prices, gap: float = 1e-4, pivots: int = 2_000, batch: int = 64) -> Program:
    """Column generation until no plan can be cheaper by more than ``gap`` of
    the price, or after so many ``pivots`` (any basis is a plan)."""
    program, cost = Program(lengths, demand, prices), prices.sequence()
    while program.pivots < pivots:
        y = program.duals()
        best, last = knapsack(lengths, y, prices.size)
        with np.errstate(invalid="ignore"):
            scale = max(1.0, float(np.nanmax(best[1:] / cost[1:])), float((y / program.stream).max()))
        if program.value() - float(y @ program.demand) / scale <= gap * program.value():
            break
        offers = [(cost[t] - best[t], cost[t], int(t), None) for t in np.flatnonzero(best[1:] > cost[1:] + TINY) + 1]
        for total in (prices.size, prices.size // 2):  # the best pattern that holds a given length
            rest = total - lengths
            ok = rest >= 0
            offers += [(cost[total] - v, cost[total], total, int(i)) for i, v in zip(np.flatnonzero(ok), (y[ok] + best[rest[ok]]), strict=True) if v > cost[total] + TINY]
        offers += [(program.stream[i] - y[i], program.stream[i], None, int(i)) for i in np.flatnonzero(y > program.stream + TINY)]
        entered = 0
        for _, price, total, first in sorted(offers, key=lambda o: o[0])[: 4 * batch]:
            column = {first: 1} if total is None else pattern(last, lengths, total, first)
            if entered and price - sum(y[i] * n for i, n in column.items()) >= -TINY:
                continue  # an earlier one of this round did its work
            if program.enter(column, float(price), total is not None):
                entered, y = entered + 1, program.duals()
            if entered >= batch:
                break
        if not entered:
            break
    return program


@dataclass
class Plan:
    """Whole patterns with their copies, in order of their sequences."""

    size: int
    copies: list[int]
    patterns: list[dict[int, int]]  # {length: pieces}
    left: dict[int, int]  # {length: pieces for the cut stream}


def rounded(histogram: dict[int, int], prices: Prices, **limits) -> Plan:
    """The program's patterns in whole numbers: first rounded down, then once
    more as often as their pieces are still there."""
    lengths = np.array(sorted(histogram), np.int64)
    left = {int(i): int(histogram[i]) for i in lengths.tolist()}
    if not left:
        return Plan(prices.size, [], [], {})
    program = solve(lengths, np.array([left[i] for i in lengths.tolist()]), prices, **limits)
    chosen = sorted((j for j in range(len(lengths)) if program.is_pattern[j] and program.amount[j] > TINY), key=lambda j: (program.amount[j] % 1, j))
    patterns = [{int(lengths[i]): n for i, n in sorted(program.columns[j].items())} for j in chosen]
    copies = [0] * len(chosen)
    for limit in (True, False):
        for k, j in reversed(list(enumerate(chosen))):
            n = min(left[i] // c for i, c in patterns[k].items())
            n = min(n, int(program.amount[j] + 1e-3)) if limit else n
            copies[k] += n
            for i, c in patterns[k].items():
                left[i] -= n * c
    used = [k for k in range(len(chosen)) if copies[k]]
    return Plan(prices.size, [copies[k] for k in used], [patterns[k] for k in used], left)
