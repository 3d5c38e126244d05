"""Cover trees over integer points, and nearest centres of whole subtrees.

A forest holds one tree for each of several sets of points, all built in step.  A node is
a stretch of points in tree order whose first point is its centre.  At level ``i`` all
points of a node are within ``2 ** i`` of the centre; centres of the children of a node
are further apart than ``2 ** (i - 1)`` and cover its points within that.  Levels at
which nothing would be divided are skipped, and small nodes are leaves.

Sums over a subtree are differences of cumulative sums along the tree order.  Distances
are compared as whole numbers wherever they decide between centres.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Points of a leaf.
LEAF = 16
#: Keeps a centre whose distance ties with the bound but for rounding.
_SLACK = 1e-6


@dataclass
class Forest:
    points: np.ndarray  # in tree order: one row per point
    order: np.ndarray  # places of these points in the input
    first: np.ndarray  # of each node, its points
    end: np.ndarray
    radius: np.ndarray  # largest distance of its points from the first
    child: np.ndarray  # its children are neighbours, from this node on
    children: np.ndarray  # 0 for a leaf
    trees: int  # the first nodes are the roots

    @property
    def sums(self) -> np.ndarray:
        """Cumulative sums along the order, with a row of zeros before them."""
        out = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=out[1:])
        return out


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return np.einsum("ij,ij->i", gap, gap)


def _ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and the range of each."""
    owner = np.repeat(np.arange(len(first)), count)
    before = np.cumsum(count) - count
    return np.arange(len(owner)) - before[owner] + first[owner], owner


def build(sets: np.ndarray) -> Forest:
    """Trees of ``sets``, whole numbers by set, point and dimension."""
    trees, size, dimensions = sets.shape
    points = sets.reshape(-1, dimensions).astype(np.int64)
    order = np.arange(len(points))
    first = np.arange(trees) * size
    end = first + size
    out: list[list[np.ndarray]] = []
    known = 0
    while len(first):
        at, owner = _ranges(first, end - first)
        square = _squares(points[order[at]], points[order[first]][owner])
        starts = np.cumsum(end - first) - (end - first)
        widest = np.maximum.reduceat(square, starts)
        radius = np.sqrt(widest.astype(np.float64))
        (split,) = np.nonzero((end - first > LEAF) & (widest > 0))
        children = np.zeros(len(first), np.int64)
        child = np.zeros(len(first), np.int64)
        out.append([first, end, radius, child, children])
        known += len(first)
        if not len(split):
            break
        # the square of the distance within which a child covers: a power of four
        level = np.frexp(radius[split])[1]
        level -= np.ldexp(1.0, level - 1) >= radius[split]
        cover = np.ldexp(1.0, 2 * (level - 1))
        at, owner = _ranges(first[split], (end - first)[split])
        group = np.zeros(len(at), np.int64)
        rest = np.arange(len(at))
        turn = 0
        while len(rest):
            # the first point left of every node is the centre of its next child
            own = owner[rest]
            leads = np.concatenate([[True], own[1:] != own[:-1]])
            centre = points[order[at[rest[leads]]]]
            near = _squares(points[order[at[rest]]], centre[np.cumsum(leads) - 1])
            covered = near <= cover[own]
            group[rest[covered]] = turn
            rest = rest[~covered]
            turn += 1
        moved = np.lexsort((group, owner))
        order[at] = order[at][moved]
        key = owner[moved] * turn + group[moved]
        fresh = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1])
        parent = owner[moved][fresh]
        children[split] = np.bincount(parent, minlength=len(split))
        child[split] = known + np.searchsorted(parent, np.arange(len(split)))
        first = at[fresh]
        end = np.append(at[fresh[1:] - 1], at[-1]) + 1
    columns = [np.concatenate(column) for column in zip(*out)]
    return Forest(points[order], order, *columns, trees)


def assign(forest: Forest, centres: np.ndarray) -> tuple[np.ndarray, ...]:
    """The nearest centre of every point, of equally near ones the first.

    ``centres`` are whole numbers by tree, entry and dimension.  Returns stretches of the
    tree order with one answer each: tree, entry, first and end, in no order; every point
    is in one of them.  A node keeps the centres that the triangle inequality leaves
    possible for some point below it; one alone takes the whole subtree.
    """
    entries = centres.shape[1]
    flat = centres.reshape(-1, centres.shape[2]).astype(np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    node = np.arange(forest.trees)
    # candidates of all nodes of the step: node, and number among all centres
    owner = np.repeat(node, entries)
    option = np.arange(forest.trees * entries)
    while len(node):
        middle = forest.points[forest.first[node]]
        square = _squares(middle[owner], flat[option])
        starts = np.searchsorted(owner, np.arange(len(node)))
        away = np.sqrt(square.astype(np.float64))
        reach = np.minimum.reduceat(away, starts) + 2 * forest.radius[node]
        kept = away <= (reach * (1 + 1e-12) + _SLACK)[owner]
        # all points of such a node are its centre, so the numbers themselves decide
        single = forest.radius[node] == 0
        nearest = square == np.minimum.reduceat(square, starts)[owner]
        kept = np.where(single[owner], nearest, kept)
        owner, option = owner[kept], option[kept]
        starts = np.searchsorted(owner, np.arange(len(node)))
        counts = np.diff(np.append(starts, len(owner)))
        done = (counts == 1) | single
        found.append((option[starts[done]], forest.first[node[done]], forest.end[node[done]]))
        leaf = ~done & (forest.children[node] == 0)
        found.append(_exact(forest, node, leaf, starts, counts, option, flat))
        (inner,) = np.nonzero(~done & ~leaf)
        below, above = _ranges(forest.child[node[inner]], forest.children[node[inner]])
        parent = inner[above]
        picked, owner = _ranges(starts[parent], counts[parent])
        option, node = option[picked], below
    option, first, end = (np.concatenate(column) for column in zip(*found))
    return option // entries, option % entries, first, end


def _exact(forest, node, leaf, starts, counts, option, flat):
    """The points of ambiguous leaves, each compared with the centres that are left."""
    (own,) = np.nonzero(leaf)
    first = forest.first[node[own]]
    at, owner = _ranges(first, forest.end[node[own]] - first)
    picked, point = _ranges(starts[own][owner], counts[own][owner])
    square = _squares(forest.points[at[point]], flat[option[picked]])
    if not len(at):
        return at, at, at
    begins = np.searchsorted(point, np.arange(len(at)))
    least = np.minimum.reduceat(square, begins)
    hit = np.nonzero(square == least[point])[0]
    # options are in ascending order, so the first hit is the first entry
    best = hit[np.searchsorted(point[hit], np.arange(len(at)))]
    return option[picked[best]], at, at + 1


def totals(forest: Forest, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points of every centre, by tree and entry."""
    tree, entry, first, end = assign(forest, centres)
    slot = tree * centres.shape[1] + entry
    counts = np.zeros(centres.shape[0] * centres.shape[1], np.int64)
    sums = np.zeros((len(counts), centres.shape[2]), np.int64)
    running = forest.sums
    np.add.at(counts, slot, end - first)
    np.add.at(sums, slot, running[end] - running[first])
    return counts, sums


def codes(forest: Forest, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, by tree and place in the input."""
    tree, entry, first, end = assign(forest, centres)
    order = np.argsort(first)
    length = (end - first)[order]
    code = np.repeat(entry[order], length)
    near = centres[np.repeat(tree[order], length), code]
    out = np.empty(len(code), np.int64)
    error = np.empty(len(code), np.int64)
    out[forest.order] = code
    error[forest.order] = _squares(forest.points, near.astype(np.int64))
    return out.reshape(forest.trees, -1), error.reshape(forest.trees, -1)
