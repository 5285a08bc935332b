"""Forests that change line by line, as link-cut trees: each question or change takes amortised log time."""

from __future__ import annotations


class LinkCut:
    """A forest of numbered nodes; paths from the roots are kept in splay trees by depth."""

    def __init__(self, size: int = 0) -> None:
        self.up, self.left, self.right = [-1] * size, [-1] * size, [-1] * size

    def add(self) -> int:
        """A new node without a parent."""
        for side in (self.up, self.left, self.right):
            side.append(-1)
        return len(self.up) - 1

    def _is_top(self, x: int) -> bool:
        up = self.up[x]
        return up < 0 or (self.left[up] != x and self.right[up] != x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g, top = up[p], self._is_top(p)
        near, far = (left, right) if left[p] == x else (right, left)
        near[p] = far[x]
        if near[p] >= 0:
            up[near[p]] = p
        far[x] = p
        up[p], up[x] = x, g
        if not top:
            (left if left[g] == p else right)[g] = x

    def _splay(self, x: int) -> None:
        while not self._is_top(x):
            p = self.up[x]
            if not self._is_top(p):
                straight = (self.left[self.up[p]] == p) == (self.left[p] == x)
                self._rotate(p if straight else x)
            self._rotate(x)

    def _access(self, x: int) -> int:
        """Makes the path from the root to ``x`` one splay tree with ``x`` on top; gives the node at which it left the path before."""
        last, at = -1, x
        while at >= 0:
            self._splay(at)
            self.right[at] = last
            last, at = at, self.up[at]
        self._splay(x)
        return last

    def link(self, child: int, parent: int) -> None:
        """Hangs a root on a node of another tree."""
        self._access(child)
        self._access(parent)
        self.up[child] = parent

    def cut(self, child: int) -> None:
        """Takes a node off its parent, if it has one."""
        self._access(child)
        above = self.left[child]
        if above >= 0:
            self.up[above] = -1
            self.left[child] = -1

    def is_above(self, upper: int, lower: int) -> bool:
        """Whether a node is an ancestor of another one, or the same."""
        self._access(upper)
        return self._access(lower) == upper
