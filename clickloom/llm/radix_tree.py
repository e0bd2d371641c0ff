"""An adaptive radix tree over byte keys: four node layouts that grow with the fan-out, and path compression.

Keys are added in any order. A key may be a prefix of another one; it then rests in the node where it ends.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class _Sorted:
    """Up to ``room`` children: their bytes in order, and the children at the same places."""

    room = 4

    def __init__(self, entries):
        entries = list(entries)
        self.bytes = bytearray(b for b, _ in entries)
        self.children = [c for _, c in entries]

    def get(self, byte):
        at = self.bytes.find(byte)
        return self.children[at] if at >= 0 else None

    def put(self, byte, child):
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.children[at] = child
        else:
            self.bytes.insert(at, byte)
            self.children.insert(at, child)

    def full(self):
        return len(self.children) >= self.room

    def entries(self):
        return zip(self.bytes, self.children)


class Node4(_Sorted):
    room = 4


class Node16(_Sorted):
    room = 16


class Node48:
    """An index over all bytes into up to 48 child slots."""

    room = 48

    def __init__(self, entries):
        self.slots = bytearray(256)
        self.children = []
        for b, c in entries:
            self.put(b, c)

    def get(self, byte):
        at = self.slots[byte]
        return self.children[at - 1] if at else None

    def put(self, byte, child):
        if self.slots[byte]:
            self.children[self.slots[byte] - 1] = child
        else:
            self.children.append(child)
            self.slots[byte] = len(self.children)

    def full(self):
        return len(self.children) >= self.room

    def entries(self):
        return ((b, self.children[at - 1]) for b, at in enumerate(self.slots) if at)


class Node256:
    """One slot per byte."""

    def __init__(self, entries):
        self.children = [None] * 256
        for b, c in entries:
            self.children[b] = c

    def get(self, byte):
        return self.children[byte]

    def put(self, byte, child):
        self.children[byte] = child

    def full(self):
        return False

    def entries(self):
        return ((b, c) for b, c in enumerate(self.children) if c is not None)


LAYOUTS = (Node4, Node16, Node48, Node256)


class Branch:
    """The place where keys part, or where one ends: all keys below share their first ``depth`` bytes.

    ``sample`` is the number of any key below; the compressed path to here is read from that key.
    """

    __slots__ = ("depth", "sample", "ends", "layout")

    def __init__(self, depth: int, sample: int, ends: int | None = None):
        self.depth, self.sample, self.ends = depth, sample, ends
        self.layout = None

    def child(self, byte: int) -> Branch | None:
        return self.layout.get(byte) if self.layout else None

    def put(self, byte: int, child: Branch) -> None:
        if self.layout is None:
            self.layout = Node4([])
        elif self.layout.full() and self.layout.get(byte) is None:
            grown = LAYOUTS[LAYOUTS.index(type(self.layout)) + 1]
            self.layout = grown(self.layout.entries())
        self.layout.put(byte, child)

    def children(self) -> list[Branch]:
        return [c for _, c in self.layout.entries()] if self.layout else []


def shared(a: bytes, b: bytes, start: int, end: int) -> int:
    """How many first bytes ``a`` and ``b`` share, at most ``end``; the first ``start`` are known to be equal."""
    step = 16
    while start < end:
        stop = min(start + step, end)
        if a[start:stop] == b[start:stop]:
            start, step = stop, step * 2
        elif step == 1:
            return start
        else:
            step = max(1, (stop - start) // 2)
    return end


class RadixTree:
    """Numbers of distinct keys, found by descending through their bytes."""

    def __init__(self):
        self.keys: list[bytes] = []
        self.root: Branch | None = None

    def add(self, key: bytes) -> int:
        number, size = len(self.keys), len(key)
        self.keys.append(key)
        if self.root is None:
            self.root = Branch(size, number, number)
            return number
        above, node, known = None, self.root, 0
        while True:
            same = shared(key, self.keys[node.sample], known, min(size, node.depth))
            if same < node.depth:  # the compressed path parts from the key, or the key ends on it
                fork = Branch(same, number, number if same == size else None)
                fork.put(self.keys[node.sample][same], node)
                if same < size:
                    fork.put(key[same], Branch(size, number, number))
                if above is None:
                    self.root = fork
                else:
                    above.put(key[above.depth], fork)
                return number
            if size == node.depth:
                if node.ends is not None:
                    raise ValueError("the key is in the tree already")
                node.ends = number
                return number
            below = node.child(key[node.depth])
            if below is None:
                node.put(key[node.depth], Branch(size, number, number))
                return number
            above, node, known = node, below, node.depth

    def preorder(self) -> Iterator[tuple[Branch, Branch | None]]:
        """Every branch with the one above it, in the order of the keys."""
        stack = [(self.root, None)] if self.root else []
        while stack:
            node, above = stack.pop()
            yield node, above
            stack.extend((c, node) for c in reversed(node.children()))
