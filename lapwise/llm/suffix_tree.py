"""Longest common extensions of suffixes: Ukkonen's tree, its Euler tour and range minima over it."""

from __future__ import annotations

from array import array

import numpy as np

# Entries of the tour below one entry of the table of minima.
BLOCK = 16


class RangeMinimum:
    """Minima of ranges in constant time: in-block prefixes and suffixes, and a sparse table over block minima."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK) * BLOCK
        self.values = np.full(n, np.iinfo(np.int64).max)
        self.values[: len(values)] = values
        blocks = self.values.reshape(-1, BLOCK)
        self.head = np.minimum.accumulate(blocks, axis=1).ravel()
        self.tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [blocks.min(axis=1)]
        while 2 ** len(self.levels) <= len(blocks):
            half = 2 ** (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The least values of the closed ranges; left <= right."""
        first, last = left // BLOCK, right // BLOCK
        out = np.minimum(self.tail[left], self.head[right])
        one = first == last
        if one.any():
            low, high = left[one], right[one]
            least = self.values[low]
            for step in range(1, BLOCK):
                least = np.minimum(least, self.values[np.minimum(low + step, high)])
            out[one] = least
        span = last - first - 1
        for level, table in enumerate(self.levels):
            at = np.flatnonzero((span >= 1 << level) & (span < 2 << level))
            if len(at):
                inner = np.minimum(table[first[at] + 1], table[last[at] - (1 << level)])
                out[at] = np.minimum(out[at], inner)
        return out


def ukkonen(symbols: list[int]) -> tuple[array, array, dict[int, int]]:
    """The suffix tree of `symbols`, whose last one is unique: start and end of each node's edge, and children.

    Node 0 is the root; a child's key is its parent's number and its edge's
    first symbol. Edges of leaves end where the text does.
    """
    n = len(symbols)
    begin, end, link = array("q", [0]), array("q", [0]), array("q", [0])
    children: dict[int, int] = {}
    node, edge, length, waiting = 0, 0, 0, 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = i
            key = node << 32 | symbols[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                start = begin[child]
                size = end[child] - start
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if symbols[start + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                inner = len(begin)
                begin.append(start)
                end.append(start + length)
                link.append(0)
                children[key] = inner
                children[inner << 32 | symbol] = inner + 1
                begin.append(i)
                end.append(n)
                link.append(0)
                begin[child] = start + length
                children[inner << 32 | symbols[start + length]] = child
                if unlinked:
                    link[unlinked] = inner
                unlinked = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return begin, end, children


class Extensions:
    """Constant-time longest common extensions of the suffixes of a text, from its suffix tree.

    `codes` are numbers from 0. Suffix n is the empty one.
    """

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        # The last symbol is 0, the least; all others move up by one.
        begin, end, children = ukkonen([*(codes + 1).tolist(), 0])
        keys = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(keys)
        self.kids = np.fromiter(children.values(), np.int64, len(children))[order].tolist()
        del children
        keys = keys[order]
        # Children of one node lie together, by first symbol.
        self.bounds = np.searchsorted(keys >> 32, np.arange(len(begin) + 1)).tolist()
        self.closing = ((keys & 0xFFFFFFFF) == 0).tolist()
        self.sizes = (np.frombuffer(end, np.int64) - np.frombuffer(begin, np.int64)).tolist()
        tour, first = self._tour()
        self.minimum, self.first = RangeMinimum(tour), first

    def _tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Depths along the Euler tour, and the place of every suffix in it."""
        kids, bounds, sizes, n = self.kids, self.bounds, self.sizes, self.n
        tour, first = array("q"), array("q", bytes(8 * (n + 1)))
        # Entries are nodes and their parents' depths; a depth alone is a return to an inner node.
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if node < 0:
                tour.append(depth)
                continue
            depth += sizes[node]
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                first[n + 1 - depth] = len(tour)
            for k in range(high - 1, low - 1, -1):
                stack.append((-1, depth))
                stack.append((kids[k], depth))
            tour.append(depth)
        return np.frombuffer(tour, np.int64), np.frombuffer(first, np.int64)

    def ranks(self) -> np.ndarray:
        """The rank of every suffix of length 1 or more, a prefix before what it begins."""
        return np.argsort(np.argsort(self.first[: self.n]))

    def ranks_downward(self) -> np.ndarray:
        """The same with the order of symbols turned round; a prefix still comes first."""
        kids, bounds, sizes, closing, n = self.kids, self.bounds, self.sizes, self.closing, self.n
        found = array("q")
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            depth += sizes[node]
            low, high = bounds[node], bounds[node + 1]
            if low == high:
                found.append(n + 1 - depth)
                continue
            # The end of the text stays the least symbol: pushed last, it comes off first.
            ends = closing[low]
            for k in range(low + ends, high):
                stack.append((kids[k], depth))
            if ends:
                stack.append((kids[low], depth))
        order = np.frombuffer(found, np.int64)
        out = np.empty(n + 1, np.int64)
        out[order] = np.arange(n + 1)
        return out[:n]

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The lengths of the longest common prefixes of the suffixes i and j; i and j differ."""
        a, b = self.first[i], self.first[j]
        return self.minimum(np.minimum(a, b), np.maximum(a, b))
