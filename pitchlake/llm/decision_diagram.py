"""Count-weighted decision diagrams of failure masks, reordered by level swaps.

A diagram has one level per filter, in some order; a node's two edges lead to
the documents that pass and to those that fail the filter of its level.  A
node carries the weights (any tuple of counts) of all documents below it;
equal subdiagrams are one node.  Exchanging two adjacent levels touches only
the nodes of these two: the upper ones keep their place and weight, so nothing
above or below changes.  All orders of the filters are reached one exchange
at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

Weights = tuple[int, ...]


class Diagram:
    """Diagram over ``names``; ``masks`` gives the weights of each failure
    mask (bit i set: filter ``names[i]`` fails)."""

    def __init__(self, names: Sequence[str], masks: dict[int, Weights]):
        self.order = list(names)
        self.zero = (0,) * len(next(iter(masks.values()), (0,)))
        self.weights: list[Weights] = []
        self.edges: list[tuple[int, int]] = []            # (pass, fail); of a leaf (-1, -1)
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in self.order]  # edges -> node
        leaves: dict[Weights, int] = {}

        def build(level: int, mask: int) -> int:
            if level == len(self.order):
                w = masks.get(mask, self.zero)
                if w not in leaves:
                    leaves[w] = self._new((-1, -1), w)
                return leaves[w]
            return self._node(level, build(level + 1, mask), build(level + 1, mask | 1 << level))
        self.root = build(0, 0)

    def _new(self, edges: tuple[int, int], weights: Weights) -> int:
        self.edges.append(edges)
        self.weights.append(weights)
        return len(self.edges) - 1

    def _node(self, level: int, passed: int, failed: int) -> int:
        known = self.levels[level]
        if (passed, failed) not in known:
            total = tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed]))
            known[passed, failed] = self._new((passed, failed), total)
        return known[passed, failed]

    def swap(self, level: int) -> None:
        """Exchange ``level`` with the one below it."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for node in upper:
            (pp, pf), (fp, ff) = (self.edges[x] for x in self.edges[node])
            edges = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.edges[node] = edges       # the same documents, asked in another order
            self.levels[level][edges] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Weights, Weights]]:
        """Along the path that passes everything: filter, weights of what
        passes it and of what it removes."""
        node = self.root
        for name in self.order:
            passed, failed = self.edges[node]
            yield name, self.weights[passed], self.weights[failed]
            node = passed


def exchanges(n: int) -> Iterator[int]:
    """Levels to exchange, one after the other, to visit all orders of n
    (the last level travels through each order of the others, by turns up
    and down)."""
    if n < 2:
        return
    up = True
    for outer in [*exchanges(n - 1), None]:
        yield from range(n - 2, -1, -1) if up else range(n - 1)
        if outer is not None:
            yield outer + up   # the others stand one lower while it is at the top
        up = not up


def all_orders(names: Sequence[str], masks: dict[int, Weights]) -> Iterator[Diagram]:
    """The diagram in every order of its levels (one object, changed in place)."""
    diagram = Diagram(names, masks)
    yield diagram
    for level in exchanges(len(names)):
        diagram.swap(level)
        yield diagram
