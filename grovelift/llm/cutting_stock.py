"""The cutting-stock problem by column generation: which lengths share a sequence.

Lengths are whole numbers of units. The size of the problem is bounded by the
number of different lengths, whatever the number of pieces.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

# The plan may be longer than the best one by this share.
GAP = 1e-3


def best_pattern(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The fill of one sequence with the highest value, any number of each length."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for c in range(int(lengths[0]), capacity + 1):
        n = int(np.searchsorted(lengths, c, side="right"))
        tries = values[:n] + best[c - lengths[:n]]
        i = int(np.argmax(tries))
        if tries[i] > best[c - 1]:
            best[c], choice[c] = tries[i], i
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if best[c] == best[c - 1]:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= int(lengths[choice[c]])
    return float(best[capacity]), counts


def fractional_patterns(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP, rounds: int = 20_000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, with nearly the least total use.

    The simplex method over patterns: the dual price of a length is what a
    piece of it costs now, and the knapsack of highest price enters if it is
    worth more than the sequence it takes. The prices over that worth bound the
    total use from below; it ends when the bound is within `gap`. Ending after
    `rounds` leaves a valid, longer plan.
    """
    fit = capacity // lengths
    columns = np.diag(fit).astype(float)
    inverse = np.diag(1.0 / fit)
    used = demand / fit
    bound = lengths @ demand / capacity
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        value, column = best_pattern(prices, lengths, capacity)
        bound = max(bound, used.sum() / max(1.0, value))
        if value <= 1 + 1e-9 or used.sum() - bound <= gap * used.sum():
            break
        change = inverse @ column
        falls = change > 1e-10
        ratios = np.full(len(used), np.inf)
        ratios[falls] = used[falls] / change[falls]
        leave = int(np.argmin(ratios))
        step = ratios[leave]
        used = np.maximum(used - step * change, 0)
        used[leave] = step
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
        columns[:, leave] = column
    return columns, used


def _fill_rest(rest: dict[int, int], capacity: int) -> Counter:
    """Best fit, longest first, for the pieces that rounding down has left."""
    by_room: dict[int, list[list[int]]] = {}
    bins: list[list[int]] = []
    for length in sorted(rest, reverse=True):
        for _ in range(rest[length]):
            room = next((r for r in range(length, capacity + 1) if by_room.get(r)), None)
            if room is None:
                held, room = [], capacity
                bins.append(held)
            else:
                held = by_room[room].pop()
            held.append(length)
            by_room.setdefault(room - length, []).append(held)
    return Counter(tuple(b) for b in bins)


def plan(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) of every pattern; together they hold each piece once."""
    lengths = np.array(sorted(k for k, n in demand.items() if n > 0), dtype=np.int64)
    if not len(lengths):
        return []
    wanted = np.array([demand[k] for k in lengths], dtype=float)
    columns, used = fractional_patterns(lengths, wanted, capacity)
    patterns, rest = [], {int(k): int(demand[k]) for k in lengths}
    for j in np.argsort(-used, kind="stable"):
        held = {int(k): int(a) for k, a in zip(lengths, columns[:, j], strict=True) if a > 0}
        # Rounding errors of the arithmetic must not take more than there is.
        times = min([int(used[j] + 1e-6), *(rest[k] // a for k, a in held.items())])
        if times > 0:
            patterns.append((times, held))
            for k, a in held.items():
                rest[k] -= times * a
    for fill, times in _fill_rest(rest, capacity).items():
        patterns.append((times, dict(Counter(fill))))
    return patterns
