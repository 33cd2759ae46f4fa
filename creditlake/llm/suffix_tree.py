"""Suffix trees of number sequences, and how far two suffixes agree.

:class:`SuffixTree` is built from left to right by Ukkonen's construction. Its
Euler tour lists the leaves in the order of their suffixes, and the shallowest
node that the tour meets between two leaves is their lowest common ancestor; a
table of range minima over the gaps between leaves finds it in constant time.
The depth of that ancestor is how far the two suffixes agree.

Time is linear but for the sorting of edges and the table (n log n, in numpy);
memory is a few hundred bytes a number.
"""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """The tree of ``numbers`` (from 1 to ``largest``) with an end that is smaller than all of them."""

    def __init__(self, numbers: list[int], largest: int):
        self.n = len(numbers)
        self.base = largest + 1
        self._build([*numbers, 0])
        self._tour()

    def _build(self, text: list[int]) -> None:
        n, base = len(text), self.base
        begin, end, link, depth, leaves = [0], [0], [0], [0], []
        edges: dict[int, int] = {}
        look = edges.get
        node = at = length = waiting = 0
        for i, symbol in enumerate(text):
            pending = 0
            waiting += 1
            while waiting:
                if not length:
                    at = i
                key = node * base + text[at]
                child = look(key)
                if child is None:
                    leaves.append(len(begin))
                    edges[key] = len(begin)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    depth.append(0)
                    if pending:
                        link[pending] = node
                        pending = 0
                else:
                    first = begin[child]
                    size = end[child] - first
                    if length >= size:
                        at += size
                        length -= size
                        node = child
                        continue
                    if text[first + length] == symbol:
                        if pending:
                            link[pending] = node
                        length += 1
                        break
                    # The edge is split: a new node in its middle, with a new leaf.
                    middle = len(begin)
                    edges[key] = middle
                    begin += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    depth += (depth[node] + length, 0)
                    begin[child] = first + length
                    edges[middle * base + text[first + length]] = child
                    edges[middle * base + symbol] = middle + 1
                    leaves.append(middle + 1)
                    if pending:
                        link[pending] = middle
                    pending = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        # Leaves are made in the order of their suffixes.
        self.depth = np.array(depth, np.int64)
        self.leaves = np.array(leaves, np.int64)
        self.depth[self.leaves] = n - np.arange(n)
        keys = np.fromiter(edges, np.int64, len(edges))
        self.parents, self.symbols = np.divmod(keys, base)
        self.children = np.fromiter(edges.values(), np.int64, len(edges))

    def _walk(self, rank: np.ndarray) -> np.ndarray:
        """The Euler tour that takes the children of a node in the order of ``rank``: nodes as they are met."""
        order = np.lexsort((rank, self.parents))
        children = self.children[order].tolist()
        edges = np.searchsorted(self.parents[order], np.arange(len(self.depth) + 1)).tolist()
        tour, stack = [], [0]
        pop, met, push = stack.pop, tour.append, stack.append
        while stack:
            node = pop()
            if node < 0:
                met(~node)
                continue
            met(node)
            for k in range(edges[node + 1] - 1, edges[node] - 1, -1):
                push(~node)
                push(children[k])
        return np.array(tour, np.int64)

    def _tour(self) -> None:
        tour = self._walk(self.symbols)
        suffix = np.full(len(self.depth), -1, np.int64)
        suffix[self.leaves] = np.arange(self.n + 1)
        stops = np.flatnonzero(suffix[tour] >= 0)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[suffix[tour[stops]]] = np.arange(self.n + 1)
        # From one leaf up to the next: the least depth is that of their common ancestor.
        low = np.minimum.reduceat(self.depth[tour], stops)[:-1].astype(np.int32)
        self.table = [low]
        width = 1
        while 2 * width <= len(low):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def falling_ranks(self) -> np.ndarray:
        """The rank of each suffix where larger numbers come first, but the end still before all."""
        tour = self._walk(np.where(self.symbols > 0, self.base - self.symbols, 0))
        suffix = np.full(len(self.depth), -1, np.int64)
        suffix[self.leaves] = np.arange(self.n + 1)
        order = suffix[tour]
        rank = np.empty(self.n + 1, np.int64)
        rank[order[order >= 0]] = np.arange(self.n + 1)
        return rank

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers the suffixes from ``a`` and from ``b`` (another place each) have in common."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(float))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.table[k]
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return found
