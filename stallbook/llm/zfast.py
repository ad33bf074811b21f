"""A z-fast trie over paths of prefix hashes.

A path is a row of 16-byte keys, the d-th of which identifies everything up to its depth. So whether
two paths agree up to a depth is one comparison, and agreement is monotone in the depth. The
trie is compacted: a node stands for the stretch of depths (low, high] on which the paths through it agree, and is stored in a hash
table under its handle, the key at the two-fattest depth of that stretch (the one with most trailing zero
bits). Fat binary search probes the two-fattest depths of a shrinking interval and finds the node at which
a path leaves the trie in as many probes as its length has bits.
"""

from __future__ import annotations

KEY = 16


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Paths that start at given depths; those with the same start (depth and key) share a root.

    Nodes are numbers into the lists: ``low``, ``high``, ``parent``, ``path`` (one of the paths through the
    node, from depth ``start`` on) and ``ends``, the paths that end at ``high``.
    """

    def __init__(self) -> None:
        self.low: list[int] = []
        self.high: list[int] = []
        self.parent: list[int] = []
        self.path: list[int] = []
        self.ends: list[list[int]] = []
        self.paths: list[tuple[int, bytes]] = []
        self.handles: dict[tuple[int, bytes], int] = {}
        self.children: dict[tuple[int, bytes], int] = {}
        self.roots: dict[tuple[int, bytes], int] = {}

    def _key(self, path: int, depth: int) -> bytes:
        start, keys = self.paths[path]
        at = (depth - start - 1) * KEY
        return keys[at : at + KEY]

    def _node(self, low: int, high: int, parent: int, path: int) -> int:
        for column, value in ((self.low, low), (self.high, high), (self.parent, parent), (self.path, path), (self.ends, [])):
            column.append(value)
        return len(self.low) - 1

    def _enter(self, node: int) -> None:
        """Put a node with a stretch into the tables, under its handle and under its first key."""
        low, high, path = self.low[node], self.high[node], self.path[node]
        f = two_fattest(low, high)
        self.handles[f, self._key(path, f)] = node
        self.children[low + 1, self._key(path, low + 1)] = node

    def locate(self, root: int, path: int, end: int) -> tuple[int, int]:
        """The node at which ``path``, ``end`` deep, leaves the trie, and the depth up to which it agrees with it."""
        node, a, b = root, self.high[root], end
        while a < b:
            f = two_fattest(a, b)
            found = self.handles.get((f, self._key(path, f)))
            if found is None:
                b = f - 1
            else:
                node, a = found, self.high[found]
        low, high = self.low[node], self.high[node]
        if node == root or (high <= end and self._key(self.path[node], high) == self._key(path, high)):
            # The whole node agrees; the rest may go on for a while in the child that starts alike.
            child = self.children.get((high + 1, self._key(path, high + 1))) if high < end else None
            if child is None:
                return node, high
            node, low, high = child, high + 1, self.high[child]
        else:
            low = two_fattest(low, high)
        high = min(high, end)
        while low < high:  # agrees at low, perhaps not at high
            middle = (low + high + 1) // 2
            if self._key(self.path[node], middle) == self._key(path, middle):
                low = middle
            else:
                high = middle - 1
        return node, low

    def insert(self, start: int, start_key: bytes, keys: bytes, label: int) -> None:
        """Add a path of ``len(keys) / KEY`` keys below ``(start, start_key)``."""
        root = self.roots.get((start, start_key))
        if root is None:
            root = self.roots[start, start_key] = self._node(start, start, -1, -1)
        self.paths.append((start, keys))
        path, end = len(self.paths) - 1, start + len(keys) // KEY
        node, depth = self.locate(root, path, end)
        if depth < self.high[node]:  # leaves inside the stretch: cut it there
            upper = self._node(self.low[node], depth, self.parent[node], self.path[node])
            f = two_fattest(self.low[node], self.high[node])
            del self.handles[f, self._key(self.path[node], f)]
            self.low[node], self.parent[node] = depth, upper
            self._enter(upper)
            self._enter(node)
            node = upper
        if depth < end:
            node = self._node(depth, end, node, path)
            self._enter(node)
        self.ends[node].append(label)

    def totals(self) -> tuple[list[int], list[int]]:
        """Per node how many paths run through it, and the smallest of their labels (a root counts too)."""
        count = [len(e) for e in self.ends]
        least: list[int | None] = [min(e, default=None) for e in self.ends]
        for node in sorted(range(len(self.low)), key=self.high.__getitem__, reverse=True):
            up = self.parent[node]
            if up >= 0 and count[node]:
                count[up] += count[node]
                least[up] = least[node] if least[up] is None else min(least[up], least[node])
        return count, least
