"""Spaced seeds: masks of 0 and 1, their completeness and their design (all on the driver; sets are tiny)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import combinations


def _errors(length: int, most: int, adjacent: bool) -> Iterable[frozenset[int]]:
    """Sets of spoilt positions; with ``adjacent`` an error may spoil two neighbours."""
    if not adjacent:
        yield from map(frozenset, combinations(range(length), most))
        return
    units = [frozenset((i,)) for i in range(length)] + [frozenset((i, i + 1)) for i in range(length - 1)]
    for some in combinations(units, most):
        yield frozenset().union(*some)


def places(mask: str, length: int) -> list[frozenset[int]]:
    """The checked positions of a mask at every offset in a read."""
    ones = [i for i, c in enumerate(mask) if c == "1"]
    return [frozenset(o + i for i in ones) for o in range(length - len(mask) + 1)]


def complete(masks: Iterable[str], length: int, most: int, adjacent: bool = False) -> bool:
    """Does every pattern of up to ``most`` errors leave some mask untouched at some offset?"""
    every = [p for m in masks for p in places(m, length)]
    return all(any(not (p & e) for p in every) for e in _errors(length, most, adjacent))


def block_masks(length: int, most: int, blocks: int) -> list[str]:
    """Masks that check all but ``most`` of ``blocks`` blocks: complete for ``most`` errors."""
    cuts = [round(i * length / blocks) for i in range(blocks + 1)]
    out = []
    for kept in combinations(range(blocks), blocks - most):
        out.append("".join("1" if any(cuts[b] <= i < cuts[b + 1] for b in kept) else "0" for i in range(length)))
    return out


def extended(masks: Iterable[str], length: int) -> list[str]:
    """Masks padded with unchecked positions to one length."""
    return [m.ljust(length, "0") for m in masks]


def merged(*sets: Iterable[str]) -> list[str]:
    """Distinct masks of several sets, sorted, without those that another one implies (it checks fewer of the same positions)."""
    every = sorted(set().union(*map(set, sets)))
    ones = {m: frozenset(i for i, c in enumerate(m) if c == "1") for m in every}
    return [m for m in every if not any(ones[o] < ones[m] for o in every)]


def at_most_ones(masks: Iterable[str], most: int) -> list[str]:
    """Masks with their last checked positions dropped beyond ``most``: looser, so still complete."""
    out = []
    for m in masks:
        seen, text = 0, []
        for c in m:
            seen += c == "1"
            text.append(c if c == "0" or seen <= most else "0")
        out.append("".join(text))
    return sorted(set(out))


def adjacent_masks(length: int, most: int) -> list[str]:
    """Complete masks where a valid-adjacent pair is one error: it may spoil two blocks."""
    return block_masks(length, 2 * most, 2 * most + 1)


def smallest(masks: Iterable[str], length: int, most: int, adjacent: bool = False) -> list[str]:
    """A small complete choice of masks: the ones that answer most of the open error patterns first (ties: text order)."""
    masks = sorted(set(masks))
    spots = {m: places(m, length) for m in masks}
    open_ = list(_errors(length, most, adjacent))
    out: list[str] = []
    while open_:
        best = max(masks, key=lambda m: (sum(any(not (p & e) for p in spots[m]) for e in open_), [-ord(c) for c in m]))
        rest = [e for e in open_ if all(p & e for p in spots[best])]
        if len(rest) == len(open_):
            raise ValueError("the masks aren't complete")
        out.append(best)
        open_ = rest
    return sorted(out)


def chance(masks: Iterable[str]) -> float:
    """The hits that a random place has with a set of masks: what verifying them costs."""
    return sum(4.0 ** -m.count("1") for m in masks)


def composed(known: Mapping[tuple[int, int], Iterable[str]], length: int, most: int, adjacent: bool = False) -> list[str]:
    """The cheapest complete set for ``length`` and ``most`` errors out of ``known`` sets, by (length, errors).

    Either a shorter set for as many errors, padded; or two sets side by side whose
    errors add up to one less, since then one of the halves has no more than its own.
    With ``adjacent`` the halves don't share the neighbours that one error spoils, so
    the one behind starts a place later.
    """
    known = {k: sorted(set(v)) for k, v in known.items()}
    options = [extended(v, length) for (n, e), v in known.items() if n <= length and e == most]
    for (n, e), front in known.items():
        behind = length - n - (1 if adjacent else 0)
        back = known.get((behind, most - 1 - e))
        if back is not None:
            options.append(merged(extended(front, length), ["0" * (length - behind) + m.ljust(behind, "0") for m in back]))
    options = [o for o in options if complete(o, length, most, adjacent)]
    if not options:
        raise ValueError(f"no known sets make one of {length} for {most} errors")
    return min(options, key=lambda o: (chance(o), o))


def best_sets(candidates: Iterable[str], length: int, most: int, count: int, size: int, adjacent: bool = False) -> list[list[str]]:
    """The ``count`` cheapest complete sets of at most ``size`` masks out of ``candidates`` (ties: fewer masks, text order)."""
    masks = sorted(set(candidates))
    found = [list(c) for k in range(1, size + 1) for c in combinations(masks, k) if complete(c, length, most, adjacent)]
    return sorted(found, key=lambda c: (chance(c), len(c), c))[:count]
