"""An adaptive radix tree over byte strings: nodes of four sizes, and paths without branches in one node."""

from __future__ import annotations

from collections.abc import Iterator

#: Children that the node layouts hold: sorted bytes beside a list (4, 16), a byte table into a list (48), a list by byte (256).
LAYOUTS = (4, 16, 48, 256)


class Node:
    """The bytes of ``path`` follow the byte that led here; ``value`` is that of the string that ends here."""

    __slots__ = ("path", "value", "layout", "keys", "children")

    def __init__(self, path: bytes = b"", value=None):
        self.path, self.value = path, value
        self.layout, self.keys, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.keys.find(byte)
            return self.children[at] if at >= 0 else None
        if self.layout == 48:
            at = self.keys[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def add(self, byte: int, node: Node) -> None:
        """A child for a byte that has none."""
        if self.layout < 256 and len(self.children) == self.layout:
            self.grow()
        if self.layout <= 16:
            at = sum(key < byte for key in self.keys)
            self.keys.insert(at, byte)
            self.children.insert(at, node)
        elif self.layout == 48:
            self.children.append(node)
            self.keys[byte] = len(self.children)
        else:
            self.children[byte] = node

    def grow(self) -> None:
        found = list(self.by_byte())
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == 48:
            self.keys, self.children = bytearray(256), []
        elif self.layout == 256:
            self.keys, self.children = bytearray(), [None] * 256
        else:
            return
        for byte, node in found:
            self.add(byte, node)

    def by_byte(self) -> Iterator[tuple[int, Node]]:
        """Children in the order of their bytes."""
        if self.layout <= 16:
            yield from zip(self.keys, self.children, strict=True)
        elif self.layout == 48:
            yield from ((byte, self.children[at - 1]) for byte, at in enumerate(self.keys) if at)
        else:
            yield from ((byte, node) for byte, node in enumerate(self.children) if node is not None)

    def cut(self, length: int) -> None:
        """Keep ``length`` bytes of the path; what follows becomes the only child."""
        low = Node(self.path[length + 1 :], self.value)
        low.layout, low.keys, low.children = self.layout, self.keys, self.children
        byte = self.path[length]
        self.path, self.value = self.path[:length], None
        self.layout, self.keys, self.children = 4, bytearray(), []
        self.add(byte, low)


def common(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` are those of ``key`` from ``at``."""
    if key.startswith(path, at):
        return len(path)
    length = 0
    while at + length < len(key) and path[length] == key[at + length]:
        length += 1
    return length


def insert(tree: Node, key: bytes, value) -> None:
    """Put in a string that the tree doesn't hold yet."""
    node, at = tree, 0
    while True:
        length = common(node.path, key, at)
        if length < len(node.path):
            node.cut(length)
        at += length
        if at == len(key):
            node.value = value
            return
        below = node.child(key[at])
        if below is None:
            node.add(key[at], Node(key[at + 1 :], value))
            return
        node, at = below, at + 1
