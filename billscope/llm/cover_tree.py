"""A cover tree over unit vectors, and its dual traversal: which of two sets of them are within a distance, pruned by covering radii.

A level's nodes are a net: each covers what lies within its radius, 2, 1, 1/2 and so on, and is its own child on the next level. Levels on
which nothing would be split are left out. The points of a node are neighbours in the tree's order, so a node is a range.
"""

import numpy as np

#: Below this radius a node's points are its children.
LEAST_RADIUS = 2.0**-7
#: Distances come from products of unit vectors and are exact to this; bounds decide only beyond it.
MARGIN = 1e-7
#: Rows of a dense comparison at a time.
STRIP = 512


def distances(products: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * products, 0.0))


class CoverTree:
    """order: places of the given points in the tree's order. Nodes: centre (in that order), radius (to its farthest point), start and
    end of its range, children (a range of nodes, empty for a point)."""

    def __init__(self, points: np.ndarray):
        self._apart = distances(points @ points.T)
        self._nodes: list[list] = []
        self._order: list[int] = []
        self._children: list[list[int]] = []
        every = np.arange(len(points))
        self._add(every)
        # Depth first: a node's points are in order once its subtree is done; children are named in an index of their own.
        pending = [(0, every, 2.0)]
        while pending:
            node, members, radius = pending.pop()
            self._nodes[node][2] = len(self._order)
            if len(members) == 1:
                self._order.append(int(members[0]))
                continue
            groups = self._split(members, radius)
            numbers = [self._add(group) for group, _ in groups]
            self._children[node] = numbers
            pending.extend((k, group, r) for k, (group, r) in reversed(list(zip(numbers, groups, strict=True))))
        self.order = np.array(self._order)
        place = np.empty(len(points), np.int64)
        place[self.order] = every
        self.centre = place[[n[0] for n in self._nodes]]
        self.radius = np.array([n[1] for n in self._nodes])
        self.start = np.array([n[2] for n in self._nodes])
        self.end = self.start + np.array([n[3] for n in self._nodes])
        self.first_child = np.concatenate([[0], np.cumsum([len(c) for c in self._children])])
        self.children = np.array([k for c in self._children for k in c], np.int64)
        self.points = points[self.order]
        del self._apart, self._nodes, self._order, self._children

    #: What a tree is stored as.
    PARTS = ("points", "centre", "radius", "start", "end", "first_child", "children")

    def parts(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.PARTS}

    @classmethod
    def of_parts(cls, parts) -> "CoverTree":
        tree = cls.__new__(cls)
        for name in cls.PARTS:
            setattr(tree, name, parts[name])
        return tree

    def _add(self, members: np.ndarray) -> int:
        """The first member is the centre."""
        farthest = self._apart[members[0], members].max() if len(members) > 1 else 0.0
        self._nodes.append([int(members[0]), float(farthest) + (MARGIN if len(members) > 1 else 0.0), 0, len(members)])
        self._children.append([])
        return len(self._nodes) - 1

    def _split(self, members: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
        """The nodes of the first finer level with more than one."""
        while True:
            radius /= 2
            if radius < LEAST_RADIUS:
                return [(members[k : k + 1], radius) for k in range(len(members))]
            if self._apart[members[0], members].max() > radius:
                break
        groups, left = [], members
        while len(left):
            near = self._apart[left[0], left] <= radius
            near[0] = True
            groups.append((left[near], radius))
            left = left[~near]
        return groups

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """The children of these nodes; points stay."""
        return np.concatenate([self.children[self.first_child[k] : self.first_child[k + 1]] if self.first_child[k + 1] > self.first_child[k] else [k] for k in nodes.tolist()])


def traverse(one: CoverTree, other: CoverTree, least_cosine: float, linked) -> None:
    """Calls linked(nodes of one, nodes of other, matrix): where the matrix is true, all points of both nodes are within the cosine.

    Every pair of points within it is in exactly one such pair of nodes, every other pair in none. Pairs of points are decided by
    their product; pairs of nodes by the distance of their centres and both covering radii, where these suffice.
    """
    within = float(np.sqrt(2.0 - 2.0 * least_cosine))
    pending = [(np.array([0]), np.array([0]))]
    while pending:
        mine, others = pending.pop()
        a_all, b = one.opened(mine), other.opened(others)
        vectors, radius_b, alone_b = other.points[other.centre[b]], other.radius[b], other.end[b] - other.start[b] == 1
        for at in range(0, len(a_all), STRIP):
            a = a_all[at : at + STRIP]
            products = one.points[one.centre[a]] @ vectors.T
            alone = (one.end[a] - one.start[a] == 1)[:, None] & alone_b
            apart, reach = distances(products), one.radius[a][:, None] + radius_b
            near = np.where(alone, products >= least_cosine, apart + reach <= within - MARGIN)
            undecided = ~alone & ~near & (apart - reach <= within + MARGIN)
            if near.any():
                linked(a, b, near)
            pending.extend((a[k : k + 1], b[undecided[k]]) for k in np.flatnonzero(undecided.any(axis=1)))
