"""Edit paths as persistent linked nodes: shared prefixes, binary-lifting ancestors, rolling hashes, exact comparison.

A path is a node: a piece of text after a parent path. Paths that begin alike share the nodes of their beginning, so a step of
a dynamic program adds one node, whatever the length. Two paths are compared by the longest common prefix, found by a binary
search over prefix hashes (a prefix's node is reached through ancestors at powers of two); what the hashes say is equal is
then verified letter by letter up to the first shared node, and compared plainly if it was not.
"""

from __future__ import annotations

_MOD, _BASE = (1 << 61) - 1, 0x1F3D5B79A8C6E42


class Paths:
    """Store of paths; node 0 is the empty one. ``base`` is a parameter of the hash, so that tests can provoke collisions."""

    def __init__(self, base: int = _BASE, mod: int = _MOD):
        self.base, self.mod = base, mod
        self.piece, self.end, self.hash, self.up = [""], [0], [0], [[0]]

    def add(self, parent: int, piece: str) -> int:
        """The path ``parent`` followed by a piece of at least one letter."""
        h, base, mod = self.hash[parent], self.base, self.mod
        for c in piece:
            h = (h * base + ord(c)) % mod
        node, up = len(self.end), [parent]
        while up[-1]:  # the ancestor at 2^k is the 2^(k-1)-th of the one at 2^(k-1)
            above = self.up[up[-1]]
            if len(above) < len(up):
                break
            up.append(above[len(up) - 1])
        self.piece.append(piece)
        self.end.append(self.end[parent] + len(piece))
        self.hash.append(h)
        self.up.append(up)
        return node

    def holder(self, node: int, length: int) -> int:
        """The first ancestor of ``node`` (or itself) that is at least ``length`` letters long."""
        k = len(self.up[node]) - 1
        while k >= 0:
            up = self.up[node]
            if k < len(up) and up[k] and self.end[up[k]] >= length:
                node = up[k]
                k = min(k, len(self.up[node]) - 1)
            else:
                k -= 1
        return node

    def prefix(self, node: int, length: int) -> tuple[int, int]:
        """(hash of the first ``length`` letters, the node that holds the last of them)."""
        if not length:
            return 0, 0
        node = self.holder(node, length)
        over = self.end[node] - length
        if not over:
            return self.hash[node], node
        h = self.hash[self.up[node][0]]
        for c in self.piece[node][:len(self.piece[node]) - over]:
            h = (h * self.base + ord(c)) % self.mod
        return h, node

    def common(self, a: int, b: int) -> int:
        """Letters that both paths begin with, as the hashes have it."""
        lo, hi = 0, min(self.end[a], self.end[b])
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.prefix(a, mid)[0] == self.prefix(b, mid)[0]:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def same(self, a: int, b: int, length: int) -> bool:
        """Whether the first ``length`` letters are equal, read back until both paths are one node."""
        a, b = self.holder(a, length), self.holder(b, length)
        while length and a != b:
            start = max(self.end[self.up[a][0]], self.end[self.up[b][0]])
            x, y = self.end[self.up[a][0]], self.end[self.up[b][0]]
            if self.piece[a][start - x:length - x] != self.piece[b][start - y:length - y]:
                return False
            length = start
            a = self.up[a][0] if x >= length else a
            b = self.up[b][0] if y >= length else b
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether path ``a`` comes before path ``b`` in the order of their letters."""
        n = self.common(a, b)
        if not self.same(a, b, n):  # two different prefixes have one hash
            return self.text(a) < self.text(b)
        x, y = self.letter(a, n), self.letter(b, n)
        return x < y

    def letter(self, node: int, at: int) -> str:
        """The letter at a position; empty past the end."""
        if at >= self.end[node]:
            return ""
        node = self.holder(node, at + 1)
        return self.piece[node][at - self.end[self.up[node][0]]]

    def text(self, node: int, start: int = 0) -> str:
        """The letters from ``start`` on."""
        out = []
        while node and self.end[node] > start:
            out.append(self.piece[node])
            node = self.up[node][0]
        whole = "".join(reversed(out))
        return whole[start - self.end[node]:]
