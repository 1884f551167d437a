"""K-d trees over letter counts, searched for words one edit away.

A word's vector has ``DIMS`` counts: a to z, and the other letters folded onto
the rest (folding and capping only bring vectors nearer). One replaced letter
raises one count and lowers one, an inserted letter raises one: L1 distances of
at most two and one. So a box is out of reach of a query as soon as what its
lower corner asks for, or what the query has beyond its upper corner, sums to
more than one; ``up`` and ``down`` are these allowances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters with a dimension of their own, dimensions (four times eight bytes), largest count.
LETTERS, DIMS, CAP = 26, 32, 63


def code_points(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), -1)


def vectors(points: np.ndarray) -> np.ndarray:
    """The letter counts of each row of code points."""
    letter = points.astype(np.int64) - ord("a")
    dim = np.where((letter >= 0) & (letter < LETTERS), letter, LETTERS + points % (DIMS - LETTERS))
    n, length = points.shape
    out = np.empty((n, DIMS), dtype=np.uint8)
    step = max(1, (1 << 22) // max(1, length))
    for at in range(0, n, step):
        some = dim[at:at + step]
        rows = np.arange(len(some))[:, None] * DIMS
        counts = np.bincount((rows + some).ravel(), minlength=len(some) * DIMS)
        out[at:at + step] = np.minimum(counts, CAP).reshape(-1, DIMS)
    return out


class Tree:
    """Nodes in arrays: ``left``/``right`` (-1: a leaf), the box ``low``/``high``,
    the split (``dim``, ``value``: not above goes left), and of leaves their
    number and the slice ``begin:end`` of ``order``, the points' row numbers."""

    def __init__(self, points: np.ndarray, leaves: int, tight: bool) -> None:
        """At most ``leaves`` leaves (a power of two, or as many as points
        differ). ``tight`` boxes hold the given points alone; others are the
        regions that the splits leave, for points still to come."""
        self.left, self.right, self.dim, self.value, self.leaf = [], [], [], [], []
        self.begin, self.end, self.low, self.high = [], [], [], []
        self.order = np.arange(len(points))
        self.leaves = 0
        self._grow(points, 0, len(points), leaves, tight, np.zeros(DIMS, np.uint8), np.full(DIMS, CAP, np.uint8))
        for name in ("left", "right", "dim", "value", "leaf", "begin", "end"):
            setattr(self, name, np.array(getattr(self, name), dtype=np.int64))
        self.low, self.high = np.array(self.low, dtype=np.uint8), np.array(self.high, dtype=np.uint8)

    def _grow(self, points, begin, end, leaves, tight, low, high) -> int:
        mine = points[self.order[begin:end]]
        if tight and len(mine):
            low, high = mine.min(axis=0), mine.max(axis=0)
        node = len(self.left)
        for name, x in (("left", -1), ("right", -1), ("dim", 0), ("value", 0), ("leaf", -1), ("begin", begin), ("end", end),
                        ("low", low), ("high", high)):
            getattr(self, name).append(x)
        spread = mine.var(axis=0) if len(mine) else np.zeros(DIMS)
        dim = int(spread.argmax())
        if leaves <= 1 or spread[dim] == 0:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        values = mine[:, dim]
        value = min(int(np.median(values)), int(values.max()) - 1)
        right = values > value
        self.order[begin:end] = self.order[begin:end][np.argsort(right, kind="stable")]
        cut = end - int(right.sum())
        below, above = high.copy(), low.copy()
        below[dim], above[dim] = value, value + 1
        self.dim[node], self.value[node] = dim, value
        self.left[node] = self._grow(points, begin, cut, leaves // 2, tight, low, below)
        self.right[node] = self._grow(points, cut, end, leaves // 2, tight, above, high)
        return node

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf in whose region each point lies."""
        node = np.zeros(len(points), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return self.leaf[node]
            at = node[inner]
            right = points[inner, self.dim[at]] > self.value[at]
            node[inner] = np.where(right, self.right[at], self.left[at])

    def reach(self, queries: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query row, leaf node)`` of every leaf whose box is in reach."""
        row = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        rows, nodes = [], []
        while len(row):
            near = within(queries[row], self.low[node], self.high[node], up, down)
            row, node = row[near], node[near]
            end = self.left[node] < 0
            rows.append(row[end])
            nodes.append(node[end])
            row, node = row[~end], node[~end]
            row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(nodes)


_ONES = np.uint64(0x0101010101010101)


def _at_most_one(excess: np.ndarray, most: int) -> np.ndarray:
    """Whether the bytes of each row sum to ``most`` (0 or 1) at most. Eight are
    added at a time: counts stop at ``CAP``, so four of them fit in a byte."""
    lanes = excess.view(np.uint64)
    total = lanes[:, 0] + lanes[:, 1] + lanes[:, 2] + lanes[:, 3]
    if not most:
        return total == 0
    return ((total & ~_ONES) == 0) & ((total & (total - np.uint64(1))) == 0)


def within(q: np.ndarray, low: np.ndarray, high: np.ndarray, up: int, down: int) -> np.ndarray:
    """Whether boxes ``low`` to ``high`` are in reach of ``q``, row by row."""
    return _at_most_one(np.maximum(low, q) - q, up) & _at_most_one(q - np.minimum(high, q), down)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of code points ``b``, as long as ``a``'s or one longer,
    is one replaced or inserted code point away from ``a``'s."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    start = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return start + end >= n


def near_rows(queries: np.ndarray, index: np.ndarray, leaf: int = 4, block: int = 1 << 11) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(query row, index row)`` of all words of ``index`` (code points) one
    edit away from those of ``queries``; the index words are as long or one
    longer."""
    if not len(queries) or not len(index):
        return
    up, down = 1, int(index.shape[1] == queries.shape[1])
    points, asked = vectors(index), vectors(queries)
    tree = Tree(points, 1 << max(0, (len(index) // leaf).bit_length()), tight=True)
    pairs_at_once = max(1, (1 << 22) // max(DIMS, index.shape[1]))
    for at in range(0, len(queries), block):
        q = asked[at:at + block]
        rows, nodes = tree.reach(q, up, down)
        size = tree.end[nodes] - tree.begin[nodes]
        ends = np.cumsum(size)
        begin = 0
        while begin < len(rows):  # leaves of about so many pairs
            done = ends[begin - 1] if begin else 0
            until = max(begin + 1, int(np.searchsorted(ends, done + pairs_at_once)))
            n = size[begin:until]
            left = np.repeat(rows[begin:until], n)
            shift = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            right = tree.order[np.repeat(tree.begin[nodes[begin:until]], n) + shift]
            begin = until
            x = points[right]
            near = within(q[left], x, x, up, down)
            left, right = left[near] + at, right[near]
            same = one_edit(queries[left], index[right])
            yield left[same], right[same]
