"""Karmarkar-Karp differencing of numbers into any number of parts with near-equal sums."""

from __future__ import annotations

import heapq

import numpy as np


def difference(sizes: list[int], parts: int) -> list[list[int]]:
    """Positions of the sizes, dealt to `parts` parts.

    Each size starts as a partial partition with one part filled. The two partial partitions with
    the largest imbalance are merged, fullest part of one with emptiest part of the other, until
    one is left. The order of equal imbalances is that of the positions, so that the result is
    always the same.
    """
    if parts <= 1 or len(sizes) <= 1:
        return [list(range(len(sizes)))] + [[] for _ in range(parts - 1)]
    # A part's content is a node: a position, or two nodes put together. -1 is an empty part.
    joined: list[tuple[int, int]] = []
    first_joined = len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(parts, np.int64), np.full(parts, -1, np.int64)
        sums[-1], nodes[-1] = size, i
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heapq.heappop(heap)
        sums = sums + sums_b[::-1]
        nodes_b = nodes_b[::-1]
        out = np.maximum(nodes, nodes_b)
        both = np.flatnonzero((nodes >= 0) & (nodes_b >= 0))
        out[both] = first_joined + len(joined) + np.arange(len(both))
        joined.extend(zip(nodes[both].tolist(), nodes_b[both].tolist()))
        at = np.argsort(sums, kind="stable")
        sums = sums[at]
        sums -= sums[0]
        heapq.heappush(heap, (-int(sums[-1]), order, sums, out[at]))
        order += 1
    result = []
    for node in heap[0][3].tolist():
        part, todo = [], [node]
        while todo:
            x = todo.pop()
            if x >= first_joined:
                todo.extend(joined[x - first_joined])
            elif x >= 0:
                part.append(x)
        result.append(sorted(part))
    return result


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """As few near-equal windows as differencing fits into `capacity`; no size is larger."""
    parts = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, parts)
        if all(sum(sizes[i] for i in part) <= capacity for part in found):
            return [part for part in found if part]
        parts += 1
