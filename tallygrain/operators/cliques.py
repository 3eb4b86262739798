"""The largest group in which every two agree."""

from __future__ import annotations


def largest(names: list[str], agree: set[frozenset[str]]) -> list[str]:
    """The largest set of names of which every two are in `agree`, the first in order among equal ones.

    Sets are bits of a number. A branch takes a name, keeps who agrees with it, and passes over those
    that agree with a pivot, as one of the others or the pivot is in any group that can't be extended; it ends where
    what is left can't beat the best group so far."""
    order = sorted(set(names))
    bit = {x: 1 << k for k, x in enumerate(order)}
    near = {x: sum(bit[y] for y in order if y != x and frozenset((x, y)) in agree) for x in order}
    adjacent = [near[x] for x in order]
    best: list[int] = []

    def members(s: int) -> list[int]:
        out = []
        while s:
            low = s & -s
            out.append(low.bit_length() - 1)
            s ^= low
        return out

    def grow(chosen: list[int], left: int, done: int) -> None:
        nonlocal best
        if not left and not done:
            if (len(chosen), [-k for k in sorted(chosen)]) > (len(best), [-k for k in best]):
                best = sorted(chosen)
            return
        if len(chosen) + left.bit_count() < max(len(best), 1):
            return
        pivot = max(members(left | done), key=lambda k: (left & adjacent[k]).bit_count())
        for k in members(left & ~adjacent[pivot]):
            grow([*chosen, k], left & adjacent[k], done & adjacent[k])
            left &= ~(1 << k)
            done |= 1 << k

    grow([], (1 << len(order)) - 1, 0)
    return [order[k] for k in best]
