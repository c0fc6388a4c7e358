"""Cover tree over norm-augmented vectors, searched by inner product (numpy).

Every candidate gets one more coordinate, sqrt(M^2 - |x|^2) with M the
largest norm, so all lie on a sphere of radius M about the origin and a
query, with 0 there, keeps its inner products. A node's children are picked
farthest first until they cover its points within ``BASE`` of its covering
radius (``FANOUT`` of them at most, what they then leave uncovered is left to
the next level); every point goes to its nearest child. Radii are angles, as
reached by the points below, so by the triangle inequality on the sphere all
inner products below a node lie within |q| M cos(phi +- theta), phi the
query's angle to the centre and theta the radius.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE = 1.3
FANOUT = 32
LEAF = 24
#: Slack of the bounds, for rounding of angles.
SLACK = 1e-7


@dataclass
class Tree:
    x: np.ndarray          # (rows, dims) integers, rows of a leaf side by side
    ids: np.ndarray
    labels: np.ndarray
    radius: float          # M
    centre: np.ndarray     # a node's centre: a row of x
    theta: np.ndarray
    parent: np.ndarray     # -1 for the root
    begin: np.ndarray      # rows of a node: begin up to end
    end: np.ndarray
    leaf: np.ndarray
    low: np.ndarray        # smallest and largest label below a node
    high: np.ndarray


def build(x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
    """The tree of integer vectors ``x``, without cuts by depth or size."""
    f = x.astype(np.float64)
    square = np.einsum("rd,rd->r", f, f)
    radius = float(np.sqrt(square.max(initial=0.0)))
    unit = np.hstack([f, np.sqrt(np.maximum(radius ** 2 - square, 0.0))[:, None]])
    if radius:
        unit /= radius
    order = np.arange(len(x))
    nodes: list[tuple] = []

    def angles(rows, to):
        chord = unit[rows] - unit[to]
        return 2 * np.arcsin(np.minimum(1.0, np.sqrt(np.einsum("rd,rd->r", chord, chord)) / 2))

    # (place in ``order``, its end, centre, parent); a node's rows are a run of ``order``
    stack = [(0, len(x), 0, -1)] if len(x) else []
    while stack:
        a, b, centre, parent = stack.pop()
        rows = order[a:b]
        near = angles(rows, centre)
        theta = float(near.max())
        me = len(nodes)
        nodes.append((centre, theta, parent, a, b, b - a <= LEAF or theta == 0.0))
        if nodes[-1][-1]:
            continue
        centres, child = [centre], np.zeros(len(rows), np.int64)
        while len(centres) < FANOUT and near.max() > theta / BASE:
            far = rows[int(near.argmax())]
            to_far = angles(rows, far)
            closer = to_far < near
            child[closer], near = len(centres), np.minimum(near, to_far)
            centres.append(far)
        place = np.argsort(child, kind="stable")
        order[a:b] = rows[place]
        ends = a + np.cumsum(np.bincount(child, minlength=len(centres)))
        for c, start, end in zip(centres, np.concatenate([[a], ends[:-1]]), ends):
            if end > start:
                stack.append((int(start), int(end), int(c), me))
    where = np.empty(len(x), np.int64)
    where[order] = np.arange(len(x))
    cols = [np.array(v) for v in zip(*nodes)] if nodes else [np.zeros(0, np.int64)] * 6
    begin, end = cols[3].astype(np.int64), cols[4].astype(np.int64)
    labels = labels[order]
    return Tree(x[order], ids[order], labels, radius, where[cols[0].astype(np.int64)],
                cols[1].astype(np.float64), cols[2].astype(np.int64), begin, end,
                cols[5].astype(bool),
                np.array([labels[a:b].min() for a, b in zip(begin, end)], np.int64),
                np.array([labels[a:b].max() for a, b in zip(begin, end)], np.int64))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = max(int(np.abs(a).max(initial=0)), 1) * max(int(np.abs(b).max(initial=0)), 1)
    if most * a.shape[1] < 1 << 53:  # every partial sum is exact in a double
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


@dataclass
class Hits:
    """Flat results: query row, its window, score and id; best first within a window."""
    query: np.ndarray
    window: np.ndarray
    score: np.ndarray
    id: np.ndarray
    opened: int = 0        # rows whose scores were computed


def search(tree: Tree, q: np.ndarray, q_id: np.ndarray, q_label: np.ndarray, low: np.ndarray,
           high: np.ndarray, k: int, same_label: bool, step: int = 8) -> Hits:
    """The ``k`` best rows of each query's windows, ``low <= score <= high``.

    Rows of the query's label only (without its own id) or of other labels
    only; best are higher scores, then smaller ids. Windows with low > high
    are empty. Best-first: a query opens its ``step`` nodes of highest bound
    (cut at the window's top) at a time; nodes outside its windows, or under
    the k-th score found so far, are never opened.
    """
    n, windows = low.shape
    none = np.zeros(0, np.int64)
    out: list[tuple] = []
    nodes = len(tree.theta)
    if not n or not nodes or not windows:
        return Hits(none, none, none, none)
    f = q.astype(np.float64)
    norm = np.sqrt(np.einsum("qd,qd->q", f, f)) * tree.radius
    score = products(q, tree.x[tree.centre]).astype(np.float64)
    phi = np.arccos(np.clip(score / np.where(norm > 0, norm, 1.0)[:, None], -1.0, 1.0))
    slack = (SLACK * norm + SLACK)[:, None]
    upper = norm[:, None] * np.cos(np.maximum(phi - tree.theta, 0.0)) + slack
    lower = norm[:, None] * np.cos(np.minimum(phi + tree.theta, np.pi)) - slack
    mine = q_label[:, None]
    if same_label:
        allowed = (tree.low <= mine) & (mine <= tree.high)
    else:
        allowed = (tree.low != mine) | (tree.high != mine)
    best = np.full((n, windows, k), np.iinfo(np.int64).min)   # scores found, ascending
    waiting = np.zeros((n, nodes), bool)
    waiting[:, 0] = True
    waiting &= allowed
    opened = 0
    parent = np.maximum(tree.parent, 0)
    has_parent = tree.parent >= 0
    while True:
        # what each waiting node can still give: its bound, cut at the top of a window it touches
        floor = np.maximum(low, best[:, :, 0])
        worth = np.full((n, nodes), -np.inf)
        for w in range(windows):
            can = waiting & (upper >= floor[:, w, None]) & (lower <= high[:, w, None]) \
                & (low[:, w] <= high[:, w])[:, None]
            worth = np.where(can, np.maximum(worth, np.minimum(upper, high[:, w, None])), worth)
        waiting &= worth > -np.inf
        if not waiting.any():
            break
        if step < nodes:
            cut = np.partition(worth, nodes - step, axis=1)[:, nodes - step, None]
            take = waiting & (worth >= cut)
        else:
            take = waiting.copy()
        waiting &= ~take
        waiting |= take[:, parent] & has_parent & allowed
        for leaf in np.flatnonzero(take.any(axis=0) & tree.leaf):
            rows = np.flatnonzero(take[:, leaf])
            a, b = int(tree.begin[leaf]), int(tree.end[leaf])
            got = products(q[rows], tree.x[a:b])
            opened += got.size
            if same_label:
                fits = (tree.labels[a:b] == mine[rows]) & (tree.ids[a:b] != q_id[rows, None])
            else:
                fits = tree.labels[a:b] != mine[rows]
            for w in range(windows):
                i, j = np.nonzero(fits & (got >= floor[rows, w, None])
                                  & (got <= high[rows, w, None]))
                if not len(i):
                    continue
                out.append((rows[i], np.full(len(i), w), got[i, j], tree.ids[a + j]))
                inside = np.full(got.shape, np.iinfo(np.int64).min)
                inside[i, j] = got[i, j]
                found = np.partition(inside, max(0, (b - a) - k), axis=1)[:, -k:]
                both = np.concatenate([best[rows, w], found], axis=1)
                best[rows, w] = np.sort(both, axis=1)[:, -k:]
    if not out:
        return Hits(none, none, none, none, opened)
    query, window, score, ident = (np.concatenate(c) for c in zip(*out))
    keep = score >= best[query, window, 0]
    query, window, score, ident = query[keep], window[keep], score[keep], ident[keep]
    order = np.lexsort((ident, -score, window, query))
    query, window, score, ident = query[order], window[order], score[order], ident[order]
    group = query * windows + window
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    rank = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
    top = rank < k
    return Hits(query[top], window[top], score[top], ident[top], opened)
