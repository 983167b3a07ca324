"""Medians of growing multisets (small per-task helpers).

``RunningMedian`` keeps values and their counts in one ascending list and the
place of the median, which an insert moves by one at most. The list may be a
slice of a larger multiset: ``below`` and ``above`` count the values outside
it, which need not be kept while the median cannot reach them.

``CountTree`` is a search tree whose nodes hold counts and lie in a store of
the caller's (a stream's state): an insert or a rank reads one node per level.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, MutableMapping

import numpy as np


class RunningMedian:
    def __init__(self, counts: Iterable[tuple[float, int]] = (), below: int = 0, above: int = 0) -> None:
        """``counts``: (value, count), ascending; ``below`` / ``above``: values smaller / larger than all of them."""
        pairs = list(counts)
        self.values = [v for v, _ in pairs]
        self.counts = [c for _, c in pairs]
        self.low = self.values[0] if self.values and below else None
        self.high = self.values[-1] if self.values and above else None
        self.n = below + sum(self.counts) + above
        self.at, self.before = 0, below  # the lower median's index, and how many values lie before its value

    def __len__(self) -> int:
        return self.n

    def median(self) -> float | None:
        if not self.n:
            return None
        lower, upper = (self.n - 1) // 2, self.n // 2
        while lower >= self.before + self.counts[self.at]:
            self.before += self.counts[self.at]
            self.at += 1
        while lower < self.before:
            self.at -= 1
            self.before -= self.counts[self.at]
        value = self.values[self.at]
        return value if upper < self.before + self.counts[self.at] else (value + self.values[self.at + 1]) / 2

    def add(self, v: float) -> float:
        """Insert ``v``; return the median of everything inserted so far."""
        self.n += 1
        if self.low is not None and v < self.low:
            self.before += 1
        elif self.high is None or v <= self.high:
            i = bisect_left(self.values, v)
            if i < self.at or i == self.at and (i == len(self.values) or self.values[i] != v) and i < len(self.values):
                self.before += 1
            if i < len(self.values) and self.values[i] == v:
                self.counts[i] += 1
            else:
                self.values.insert(i, v)
                self.counts.insert(i, 1)
                if len(self.values) > 1 and i <= self.at:
                    self.at += 1
        return self.median()


class Node:
    """Ascending values with counts (a leaf), or children with their smallest values and counts."""

    __slots__ = ("values", "counts", "children")

    def __init__(self, values: list[float], counts: list[int], children: list[int] | None):
        self.values, self.counts, self.children = values, counts, children

    def pack(self) -> bytes:
        numbers = self.counts + (self.children or [])
        return bytes([self.children is not None]) + np.array(self.values, "<f8").tobytes() + np.array(numbers, "<i8").tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> "Node":
        n = (len(raw) - 1) // (24 if raw[0] else 16)
        numbers = np.frombuffer(raw, "<i8", offset=1 + 8 * n).tolist()
        return cls(np.frombuffer(raw, "<f8", n, 1).tolist(), numbers[:n], numbers[n:] if raw[0] else None)


class CountTree:
    """``store``: node number -> packed node, read when met and written by ``save``; ``made``: nodes so far."""

    def __init__(self, store: MutableMapping[int, bytes], root: int = 0, made: int = 0, width: int = 128):
        self.store, self.root, self.made, self.width = store, root, made, width
        self.open: dict[int, Node] = {}
        self.changed: set[int] = set()
        if not made:
            self.root = self.new(Node([], [], None))

    def new(self, node: Node) -> int:
        number, self.made = self.made, self.made + 1
        self.open[number] = node
        self.changed.add(number)
        return number

    def node(self, number: int) -> Node:
        if number not in self.open:
            self.open[number] = Node.unpack(self.store[number])
        return self.open[number]

    def __len__(self) -> int:
        return sum(self.node(self.root).counts)

    def add(self, v: float) -> None:
        path, number, node = [], self.root, self.node(self.root)
        while node.children is not None:
            i = max(0, bisect_right(node.values, v) - 1)
            node.values[i] = min(node.values[i], v)
            node.counts[i] += 1
            self.changed.add(number)
            path.append((number, i))
            number = node.children[i]
            node = self.node(number)
        i = bisect_left(node.values, v)
        if i < len(node.values) and node.values[i] == v:
            node.counts[i] += 1
        else:
            node.values.insert(i, v)
            node.counts.insert(i, 1)
        self.changed.add(number)
        while len(node.values) > self.width:
            half = len(node.values) // 2
            right = Node(node.values[half:], node.counts[half:], node.children and node.children[half:])
            del node.values[half:], node.counts[half:]
            if node.children is not None:
                del node.children[half:]
            other = self.new(right)
            if path:
                up, i = path.pop()
                parent = self.node(up)
                parent.values.insert(i + 1, right.values[0])
                parent.counts[i:i + 1] = [sum(node.counts), sum(right.counts)]
                parent.children.insert(i + 1, other)
            else:
                parent = Node([node.values[0], right.values[0]], [sum(node.counts), sum(right.counts)], [number, other])
                up = self.root = self.new(parent)
            number, node = up, parent

    def at(self, rank: int) -> float:
        """The value with ``rank`` values before it."""
        node = self.node(self.root)
        while True:
            for i, count in enumerate(node.counts):
                if rank < count:
                    break
                rank -= count
            if node.children is None:
                return node.values[i]
            node = self.node(node.children[i])

    def median(self) -> float | None:
        n = len(self)
        if not n:
            return None
        return self.at(n // 2) if n % 2 else (self.at(n // 2 - 1) + self.at(n // 2)) / 2

    def save(self) -> None:
        for number in self.changed:
            self.store[number] = self.open[number].pack()
        self.changed.clear()
