"""A BK-tree over 64-bit codes, with leaves that are scanned as arrays."""

from __future__ import annotations

import numpy as np


class BKTree:
    """Children of a node are keyed by their Hamming distance to it; a search follows only edges within the radius.

    A node with at most `leaf` codes below it keeps them in an array. Queries go down in batches, so a shard that
    is searched with all its own codes visits each node once. Items found can be taken out (`take`), which keeps
    the search of dense clusters near linear.
    """

    def __init__(self, codes: np.ndarray, leaf: int = 8):
        self.codes, self.alive = codes, np.ones(len(codes), bool)
        self.nodes: list[tuple[np.uint64 | None, np.ndarray, dict[int, int]]] = []
        self._grow(np.arange(len(codes)), leaf)

    def _grow(self, items: np.ndarray, leaf: int) -> None:
        todo = [(items, -1, 0)]
        while todo:
            items, parent, edge = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][2][edge] = me
            if len(items) <= leaf:
                self.nodes.append((None, items, {}))
                continue
            pivot = self.codes[items[0]]
            far = np.bitwise_count(self.codes[items] ^ pivot)
            self.nodes.append((pivot, items[far == 0], {}))
            for d in np.unique(far[far > 0]):
                todo.append((items[far == d], me, int(d)))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, item) of all pairs within the radius whose item is still alive."""
        found_q, found_i = [np.empty(0, int)], [np.empty(0, int)]
        todo = [(0, np.arange(len(queries)))]
        while todo:
            at, q = todo.pop()
            pivot, items, children = self.nodes[at]
            items = items[self.alive[items]]
            if pivot is None:
                for part in np.array_split(q, max(1, len(q) * len(items) // 4_000_000 + 1)):
                    a, b = np.nonzero(np.bitwise_count(queries[part, None] ^ self.codes[items][None, :]) <= radius)
                    found_q.append(part[a])
                    found_i.append(items[b])
                continue
            far = np.bitwise_count(queries[q] ^ pivot).astype(int)
            near = q[far <= radius]
            if len(items) and len(near):
                found_q.append(np.repeat(near, len(items)))
                found_i.append(np.tile(items, len(near)))
            for d, child in children.items():
                below = q[np.abs(far - d) <= radius]
                if len(below):
                    todo.append((child, below))
        return np.concatenate(found_q), np.concatenate(found_i)

    def accompanied(self, radius: int) -> np.ndarray:
        """Which codes have another one within the radius. A code goes down no further once one is found, so this costs
        little in dense clusters, and elsewhere a visit of each node that some code's radius reaches."""
        found = np.zeros(len(self.codes), bool)
        todo = [(0, np.arange(len(self.codes)))]
        while todo:
            at, q = todo.pop()
            q = q[~found[q]]
            pivot, items, children = self.nodes[at]
            if not len(q):
                continue
            if pivot is None:
                for part in np.array_split(q, len(q) * len(items) // 4_000_000 + 1):
                    near = np.bitwise_count(self.codes[part, None] ^ self.codes[items][None, :]) <= radius
                    found[part] |= (near & (part[:, None] != items[None, :])).any(1)
                continue
            far = np.bitwise_count(self.codes[q] ^ pivot).astype(int)
            near = far <= radius
            found[q[near]] |= (len(items) > 1) | (q[near] != items[0])
            for d, child in children.items():
                below = q[np.abs(far - d) <= radius]
                if len(below):
                    todo.append((child, below))
        return found

    def take(self, items: np.ndarray) -> None:
        self.alive[items] = False


def shard_roots(codes: np.ndarray, radius: int, accept=None, block: int = 256) -> np.ndarray:
    """For each code of a shard the position of the first code of its component under links within the radius.

    Components are explored breadth first; what is reached leaves the tree, so no pair list of a cluster is made.
    `accept(i, j)`, if given, takes arrays of positions and tells which pairs within the radius are links. Codes without
    another one within the radius are set aside first.
    """
    roots = np.arange(len(codes))
    if len(codes) < 2:
        return roots
    tree = BKTree(codes)
    for first in np.flatnonzero(tree.accompanied(radius)).tolist():
        if not tree.alive[first]:
            continue
        tree.take(np.array([first]))
        frontier = [first]
        while frontier:
            now, frontier = np.array(frontier[:block]), frontier[block:]
            q, i = tree.search(codes[now], radius)
            if accept is not None and len(i):
                kept = accept(now[q], i)
                i = i[kept]
            i = np.unique(i)
            tree.take(i)
            roots[i] = first
            frontier += i.tolist()
    return roots


def tree_edges(roots: np.ndarray, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions (member, parent) that hold each component together, with at most width + 1 pairs at a position:
    members of a component stand in a tree, so no node has all others as neighbours."""
    order = np.argsort(roots, kind="stable")
    first = np.r_[True, roots[order][1:] != roots[order][:-1]] if len(roots) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(roots)), 0))
    rank = np.arange(len(roots)) - start
    some = np.flatnonzero(rank > 0)
    return order[some], order[start[some] + (rank[some] - 1) // width]
