"""An adaptive radix tree over byte strings, with path compression.

A node holds the bytes that all keys below it share and its children by their
next byte, in the smallest of four layouts that fits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node4:
    """Up to 4 children: sorted bytes beside the children."""

    limit = 4
    __slots__ = ("bytes", "children")

    def __init__(self):
        self.bytes = bytearray()
        self.children: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return None if at < 0 else self.children[at]

    def put(self, byte: int, child: Node) -> None:
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.children[at] = child
        else:
            self.bytes.insert(at, byte)
            self.children.insert(at, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.children)

    def __len__(self) -> int:
        return len(self.children)


class Node16(Node4):
    """Up to 16 children, laid out as before."""

    limit = 16
    __slots__ = ()


class Node48:
    """Up to 48 children: a place for each byte, and the children by place."""

    limit = 48
    __slots__ = ("places", "children")

    def __init__(self):
        self.places = bytearray(256)
        self.children: list[Node] = []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.children[place - 1] if place else None

    def put(self, byte: int, child: Node) -> None:
        if place := self.places[byte]:
            self.children[place - 1] = child
        else:
            self.children.append(child)
            self.places[byte] = len(self.children)

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.children[p - 1]) for b, p in enumerate(self.places) if p)

    def __len__(self) -> int:
        return len(self.children)


class Node256:
    """A child or nothing for every byte."""

    limit = 256
    __slots__ = ("children", "size")

    def __init__(self):
        self.children: list[Node | None] = [None] * 256
        self.size = 0

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        self.size += self.children[byte] is None
        self.children[byte] = child

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, c) for b, c in enumerate(self.children) if c is not None)

    def __len__(self) -> int:
        return self.size


LAYOUTS = (Node4, Node16, Node48, Node256)


class Node:
    """What keys share from here on, the values of the key that ends here, and the children."""

    __slots__ = ("prefix", "key", "values", "layout")

    def __init__(self, prefix: bytes):
        self.prefix = prefix
        self.key: bytes | None = None
        self.values: list[int] = []
        self.layout = None

    def child(self, byte: int) -> Node | None:
        return None if self.layout is None else self.layout.get(byte)

    def put(self, byte: int, child: Node) -> None:
        if self.layout is None:
            self.layout = Node4()
        elif len(self.layout) == self.layout.limit and self.layout.get(byte) is None:
            grown = LAYOUTS[LAYOUTS.index(type(self.layout)) + 1]()
            for b, c in self.layout.items():
                grown.put(b, c)
            self.layout = grown
        self.layout.put(byte, child)

    def items(self) -> Iterator[tuple[int, Node]]:
        return iter(()) if self.layout is None else iter(self.layout.items())


def shared(a: bytes, b: bytes) -> int:
    """How many first bytes are the same."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class Tree:
    """Lists of values by key."""

    def __init__(self):
        self.root: Node | None = None

    def add(self, key: bytes, value: int) -> None:
        if self.root is None:
            self.root = self._ended(key, key, value)
            return
        above, byte, node, at = None, 0, self.root, 0
        while True:
            prefix = node.prefix
            if prefix and not key.startswith(prefix, at):
                # The keys part inside the prefix: a node of their common part comes above.
                same = shared(prefix, key[at : at + len(prefix)])
                parted = Node(prefix[:same])
                node.prefix = prefix[same + 1 :]
                parted.put(prefix[same], node)
                if above is None:
                    self.root = parted
                else:
                    above.put(byte, parted)
                node = parted
                at += same
            else:
                at += len(prefix)
            if at == len(key):
                node.key = key
                node.values.append(value)
                return
            below = node.child(key[at])
            if below is None:
                node.put(key[at], self._ended(key[at + 1 :], key, value))
                return
            above, byte, node = node, key[at], below
            at += 1

    @staticmethod
    def _ended(rest: bytes, key: bytes, value: int) -> Node:
        node = Node(rest)
        node.key = key
        node.values.append(value)
        return node
