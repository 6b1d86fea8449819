"""All maximal-scoring segments of a sequence in linear time."""

from __future__ import annotations

from collections.abc import Iterable


def maximal(steps: Iterable[tuple[int, int, float, float]]) -> list[tuple[int, int, float]]:
    """(first, end, score) of all maximal segments.

    ``steps``: (first, end, lost, gain) of the places that gain, in order;
    ``lost`` is what the places between it and the one before take away.

    Candidates are kept with the running totals before and after them, and with
    a link to the nearest earlier one whose total before lies lower.  A new one
    absorbs that candidate and all after it if the candidate also ends lower,
    else it stands alone.  The links skip what no later candidate can need, so
    every candidate is passed over once, also where totals drift down."""
    found: list[tuple[int, int, float, float, int]] = []  # first, end, before, after, link
    total = 0.0
    for first, end, lost, gain in steps:
        low = total - lost
        total = low + gain
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= total:
                break
            first, low = found[k][0], found[k][2]
            del found[k:]
        found.append((first, end, low, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in found]
