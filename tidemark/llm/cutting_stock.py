"""Column generation for the one-dimensional cutting-stock problem.

The problem is over *sizes* (at most a few hundred), never over documents, so its work
and memory do not depend on how many pieces there are.
"""

from __future__ import annotations

import numpy as np


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of the largest total value.

    For one size the table is folded into residues modulo that size; along each residue the
    best number of copies is a running maximum, so every size costs a few numpy calls.
    """
    worth = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, dtype=np.int32)
    for i in np.argsort(-values / sizes, kind="stable"):
        value, size = values[i], int(sizes[i])
        if value <= 0:
            break
        rows = -(-(capacity + 1) // size)
        folded = np.full(rows * size, -np.inf)
        folded[: capacity + 1] = worth
        steps = np.arange(rows)[:, None] * value
        better = (np.maximum.accumulate(folded.reshape(rows, size) - steps, axis=0) + steps).ravel()[: capacity + 1]
        gained = better > worth + 1e-12
        worth[gained] = better[gained]
        last[gained] = i
    pattern = np.zeros(len(sizes), dtype=np.int64)
    # What is left of the capacity after the last item is known only by walking back with the
    # values: an entry may be older than the one it was built from, but never worth less.
    left = int(np.argmax(worth))
    total = float(worth[left])
    while left > 0 and last[left] >= 0:
        i = last[left]
        pattern[i] += 1
        left -= int(sizes[i])
    return total, pattern


def solve(sizes, demand, capacity: int, gap: float = 5e-4, max_rounds: int = 2000):
    """Patterns (rows over ``sizes``) and how often each is used, covering ``demand`` exactly.

    A revised simplex over patterns: the dual prices of the restricted linear program price
    sizes, :func:`best_pattern` finds the pattern of the lowest reduced cost, and the program
    ends when no more than ``gap`` can be won, by the volume bound or by Farley's.
    Prices are first smoothed towards those of a cut without waste, which they approach.
    The fractional solution is rounded down; what that leaves, at most one pattern's worth
    for each basic column, is packed first-fit decreasing.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    demand = np.asarray(demand, dtype=np.int64)
    n = len(sizes)
    if not n:
        return []
    copies = capacity // sizes
    patterns = np.diag(copies).astype(float)  # column j: pattern of basic variable j
    inverse = np.diag(1.0 / copies)
    amounts = demand / copies
    stock = sizes / capacity  # the prices of a cut without any waste
    weight = 0.9
    least = float(sizes @ demand) / capacity
    for _ in range(max_rounds):
        if amounts.sum() <= least * (1 + gap):
            break
        prices = inverse.sum(axis=0)
        while True:
            worth, entering = best_pattern(weight * stock + (1 - weight) * prices, sizes, capacity)
            if prices @ entering > 1 + 1e-9 or weight == 0:
                break
            weight = max(0.0, weight - 0.3)
        if weight == 0 and worth <= 1 + gap:
            break
        if prices @ entering <= 1 + 1e-9:
            break
        direction = inverse @ entering
        rising = direction > 1e-9
        if not rising.any():
            break
        ratios = np.full(n, np.inf)
        ratios[rising] = amounts[rising] / direction[rising]
        leaving = int(np.argmin(ratios))
        step = ratios[leaving]
        amounts = np.maximum(amounts - step * direction, 0)
        amounts[leaving] = step
        row = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, row)
        inverse[leaving] = row
        patterns[:, leaving] = entering
    found, left = [], demand.copy()
    whole = np.floor(amounts + 1e-7).astype(np.int64)
    for j in np.argsort(-amounts, kind="stable"):
        pattern = patterns[:, j].astype(np.int64)
        used = pattern > 0
        times = int(min(whole[j], (left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            left -= pattern * times
            found.append((pattern, times))
    order = np.argsort(-sizes, kind="stable")
    while left.any():
        room, pattern = capacity, np.zeros(n, dtype=np.int64)
        for i in order:
            if left[i] and sizes[i] <= room:
                pattern[i] = min(left[i], room // sizes[i])
                room -= int(pattern[i] * sizes[i])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left -= pattern * times
        found.append((pattern, times))
    return found
