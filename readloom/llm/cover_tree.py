"""Cover trees over integer points, with sums of what lies below each node.

A node at a scale covers its points within that scale; its children are nodes at half the scale, its own centre first,
whose centres lie further than that half from each other. A node with one child only is left out. Points are exact:
64-bit integers where squares fit, else Python's.
"""

from __future__ import annotations

import numpy as np

#: Largest component for which sums of 512 squares of differences fit 64 bits.
SAFE = 1 << 26
#: Rounding of square roots is allowed for: two distances this close, relatively, are not told apart.
SLACK = 1e-9


def exact(values: np.ndarray) -> np.ndarray:
    """Integral floats as integers of a type in which squared distances are exact."""
    if values.size and (np.abs(values).max() > SAFE or values.shape[-1] > 512):
        return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)
    return values.astype(np.int64)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    if a.shape[-1] == 0:
        return np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int64)
    return np.square(a - b).sum(axis=-1)


def _roots(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(float))


class CoverTree:
    """``points`` are the distinct ones; nodes are numbered level by level, children of a node next to each other."""

    def __init__(self, points: np.ndarray):
        place: dict[tuple, int] = {}
        #: Of each given point, which of the distinct ones it is.
        self.of = np.array([place.setdefault(p, len(place)) for p in map(tuple, points.tolist())], np.int64)
        self.points = np.array(list(place), points.dtype).reshape(len(place), points.shape[1])
        n = len(place)
        centre, dist, node = np.zeros(n, np.int64), _roots(squares(self.points, self.points[:1])), np.zeros(n, np.int64)
        self.centre, self.radius, self.parent, self.level = np.zeros(1, np.int64), dist.max()[None], np.full(1, -1), [0, 1]
        active, scale = np.flatnonzero(self.radius[node]), float(self.radius[0])
        while len(active):
            scale /= 2
            # What its centre does not cover goes to the first point left, of all nodes at once, until none is.
            todo = active[dist[active] > scale]
            while len(todo):
                _, first, which = np.unique(node[todo], return_index=True, return_inverse=True)
                to = todo[first][which]
                far = _roots(squares(self.points[todo], self.points[to]))
                near = far <= scale
                centre[todo[near]], dist[todo[near]] = to[near], far[near]
                todo = todo[~near]
            made = self.level[-1]
            parent, middle = np.unique(np.stack((node[active], centre[active])), axis=1)
            splits = np.bincount(parent, minlength=made) > 1
            parent, middle, moved = parent[splits[parent]], middle[splits[parent]], active[splits[node[active]]]
            fresh = np.empty(n, np.int64)
            fresh[middle] = np.arange(made, made + len(middle))
            node[moved] = fresh[centre[moved]]
            self.centre, self.parent, self.radius = np.append(self.centre, middle), np.append(self.parent, parent), np.append(self.radius, np.zeros(len(middle)))
            np.maximum.at(self.radius, node[moved], dist[moved])
            if len(middle):
                self.level.append(made + len(middle))
            active = active[self.radius[node[active]] > 0]
        self.leaf = node
        # Sums and counts of the given points, from the leaves up.
        self.count, self.sum = np.zeros(self.level[-1], np.int64), np.zeros((self.level[-1], points.shape[1]), points.dtype)
        times = np.bincount(self.of, minlength=n)
        self.count[self.leaf], self.sum[self.leaf] = times, self.points * times[:, None].astype(points.dtype)
        for begin, end in zip(self.level[-2:0:-1], self.level[:1:-1]):
            np.add.at(self.count, self.parent[begin:end], self.count[begin:end])
            np.add.at(self.sum, self.parent[begin:end], self.sum[begin:end])
        self.children = np.bincount(self.parent[1:], minlength=self.level[-1])
        self.child = np.zeros(self.level[-1], np.int64)
        found, first = np.unique(self.parent[1:], return_index=True)
        self.child[found] = first + 1

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each distinct point (ties to the first), and what falls to each entry: sums and counts.

        A node's points all go to one entry where every other is further from its centre by more than twice its radius;
        else its children are asked, among the entries that are left.
        """
        own = np.full(len(self.centre), -1)
        sums, counts = np.zeros(entries.shape, self.sum.dtype), np.zeros(len(entries), np.int64)
        nodes, left = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        while len(nodes):
            square = squares(self.points[self.centre[nodes]][:, None], entries[None])
            far = np.where(left, _roots(square), np.inf)
            square[~left] = square.max() + 1
            best = square.argmin(axis=1)
            radius, least = self.radius[nodes], far[np.arange(len(nodes)), best]
            left = far <= (least + (2 + SLACK) * radius + SLACK * least)[:, None]
            done = (left.sum(axis=1) == 1) | (radius == 0)
            own[nodes[done]] = best[done]
            np.add.at(sums, best[done], self.sum[nodes[done]])
            np.add.at(counts, best[done], self.count[nodes[done]])
            nodes, left = nodes[~done], left[~done]
            many = self.children[nodes]
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            nodes, left = np.repeat(self.child[nodes], many) + offset, np.repeat(left, many, axis=0)
        for begin, end in zip(self.level[1:-1], self.level[2:]):
            own[begin:end] = np.where(own[begin:end] < 0, own[self.parent[begin:end]], own[begin:end])
        return own[self.leaf], sums, counts
