"""An adaptive radix tree over byte strings: inner nodes grow through four layouts, and paths without a branch are compressed.

A node covers the bytes of its path behind the byte that leads to it. A key that
is a prefix of another one ends at an inner node, so any node may hold a value.
"""

from collections.abc import Iterator

#: How many children each layout has room for.
LAYOUTS = (4, 16, 48, 256)


class Node:
    """`path` behind the edge byte, the key that made the node, an optional value, and children in one of four layouts.

    With up to 16 children their bytes lie sorted beside them; with up to 48 a
    table of 256 numbers points into the list of children; beyond that the list
    itself has 256 places.
    """

    __slots__ = ("path", "key", "value", "room", "bytes", "children", "size")

    def __init__(self, path: bytes, key: bytes) -> None:
        self.path, self.key, self.value = path, key, None
        self.room, self.bytes, self.children, self.size = LAYOUTS[0], bytearray(), [], 0

    def child(self, byte: int) -> "Node | None":
        if self.room <= 16:
            at = self.bytes.find(byte)
            return None if at < 0 else self.children[at]
        if self.room == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, node: "Node") -> None:
        """Add or replace a child."""
        if self.child(byte) is not None:
            self.children[self.bytes.find(byte) if self.room <= 16 else self.bytes[byte] - 1 if self.room == 48 else byte] = node
            return
        if self.size == self.room:
            self._grow()
        self.size += 1
        if self.room <= 16:
            at = next((i for i, b in enumerate(self.bytes) if b > byte), len(self.bytes))
            self.bytes.insert(at, byte)
            self.children.insert(at, node)
        elif self.room == 48:
            self.children.append(node)
            self.bytes[byte] = len(self.children)
        else:
            self.children[byte] = node

    def _grow(self) -> None:
        pairs = list(self.items())
        self.room = LAYOUTS[LAYOUTS.index(self.room) + 1]
        if self.room == 48:
            self.bytes, self.children = bytearray(256), [node for _, node in pairs]
            for i, (byte, _) in enumerate(pairs):
                self.bytes[byte] = i + 1
        elif self.room == 256:
            self.bytes, self.children = bytearray(), [None] * 256
            for byte, node in pairs:
                self.children[byte] = node

    def items(self) -> Iterator[tuple[int, "Node"]]:
        """The children by their bytes, ascending."""
        if self.room <= 16:
            yield from zip(self.bytes, self.children)
        elif self.room == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from ((b, node) for b, node in enumerate(self.children) if node is not None)


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of `a` equal those of `b` from `start` on."""
    if b.startswith(a, start):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b[start : start + len(a)])) if x != y), min(len(a), len(b) - start))


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"", b"")

    def place(self, key: bytes) -> Node:
        """The node at which the key ends, made if need be."""
        above, edge, node, depth = None, 0, self.root, 0
        while True:
            same = _common(node.path, key, depth)
            if same < len(node.path):
                # The path is cut: a new node takes its front and the branch.
                front = Node(node.path[:same], key)
                front.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                if above is None:
                    self.root = front
                else:
                    above.put(edge, front)
                node = front
            depth += same
            if depth == len(key):
                return node
            byte = key[depth]
            below = node.child(byte)
            if below is None:
                below = Node(key[depth + 1 :], key)
                node.put(byte, below)
                return below
            above, edge, node, depth = node, byte, below, depth + 1

    def along(self, key: bytes) -> dict[int, int]:
        """id of each node on the way of the key: how many bytes of the key are matched there."""
        out, node, depth = {}, self.root, 0
        while True:
            same = _common(node.path, key, depth)
            depth += same
            out[id(node)] = depth
            if same < len(node.path) or depth == len(key):
                return out
            below = node.child(key[depth])
            if below is None:
                return out
            node, depth = below, depth + 1

    def upward(self) -> Iterator[tuple[Node, int, int]]:
        """(node, depth above its edge, depth at its end) of every node, children before their parents."""
        stack = [(self.root, 0, len(self.root.path), False)]
        while stack:
            node, above, end, seen = stack.pop()
            if seen or not node.size:
                yield node, above, end
                continue
            stack.append((node, above, end, True))
            stack.extend((below, end, end + 1 + len(below.path), False) for _, below in node.items())
