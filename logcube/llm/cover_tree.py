"""Cover trees over norm-augmented vectors, searched best-first for the greatest
inner products within windows.

A coordinate sqrt(M² - |x|²) is added to every vector x of a tree (M: their
greatest norm), so that all lie on one sphere and the inner product with a
query, which has 0 there, falls with the angle to it.  A node is a vector; its
children are a net of the vectors below it with half the node's covering radius,
and its own covering radius, the greatest distance to a vector below it, bounds
their angles to any query, and so their inner products from both sides.

``search`` takes queries in batches: the node with the greatest bound comes
first, a query leaves a node whose bounds miss its window or its k-th best
score so far, and every vector that is reached is scored exactly.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Fewer vectors below a node are its children, one by one.
LEAF = 16
#: Bounds are widened by so much of |query| * M against rounding.
SLACK = 1e-6
#: Components beyond this are drawn in before distances are measured; their trees
#: are searched without bounds.
FAR = 1e100
#: Scores beyond a long are the greatest long.
LIMIT = 2**63 - 1


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of levels; the children of node i are first[i] .. last[i] - 1."""

    order: np.ndarray  # node -> row of the vectors that the tree was built from
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray  # greatest distance from the node to a node below it
    norm: float  # M


def build(vectors: np.ndarray) -> Tree:
    """The cover tree of the rows of ``vectors`` (float64, one at least)."""
    vectors = np.clip(vectors, -FAR, FAR)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    top = squares.max()
    augmented = np.column_stack([vectors, np.sqrt(np.maximum(top - squares, 0.0))])

    def distances(rows: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(np.maximum(2 * top - 2 * (augmented[rows] @ augmented[row]), 0.0))

    order, first, last, radius = [0], [], [], []
    below = [np.arange(1, len(vectors))]  # of the nodes, in their order
    for node, row in enumerate(order):  # grows
        rows = below[node]
        below[node] = None
        first.append(len(order))
        if len(rows) == 0:
            last.append(len(order))
            radius.append(0.0)
            continue
        far = distances(rows, row)
        radius.append(float(far.max()))
        if len(rows) <= LEAF or radius[-1] == 0.0:
            order += rows.tolist()
            below += [rows[:0]] * len(rows)
        else:
            # A net: the vector that is farthest from all of it, until all are covered.
            net, nearest, owner = [], np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
            place = int(far.argmax())
            while nearest[place] > radius[-1] / 2:
                reach = distances(rows, rows[place])
                reach[place] = -1.0  # its own, also beside equal vectors
                closer = reach < nearest
                owner[closer] = len(net)
                nearest = np.where(closer, reach, nearest)
                net.append(place)
                place = int(nearest.argmax())
            in_net = np.zeros(len(rows), bool)
            in_net[net] = True
            by_owner = np.flatnonzero(~in_net)
            by_owner = by_owner[np.argsort(owner[by_owner], kind="stable")]
            cuts = np.searchsorted(owner[by_owner], np.arange(len(net) + 1))
            order += rows[net].tolist()
            below += [rows[by_owner[cuts[i] : cuts[i + 1]]] for i in range(len(net))]
        last.append(len(order))
    return Tree(np.array(order), np.array(first, np.int32), np.array(last, np.int32), np.array(radius), float(np.sqrt(top)))


@dataclass(frozen=True)
class Forest:
    """Trees side by side; all arrays by node."""

    vectors: np.ndarray
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    roots: np.ndarray


@dataclass(frozen=True)
class Windows:
    """Each wants the ``k`` best nodes of its query with low <= score <= high,
    by score, then id: those of the query's label, or of any other."""

    query: np.ndarray  # row of the queries
    low: np.ndarray
    high: np.ndarray
    k: int
    same_label: bool


def _whole(vectors: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in v] for v in vectors], dtype=object).reshape(vectors.shape)


def search(forest: Forest, vectors: np.ndarray, rows: np.ndarray, labels: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, node, score) of the best nodes of every window."""
    biggest = max(1.0, float(np.abs(vectors).max(initial=0))) * max(1.0, float(np.abs(forest.vectors).max(initial=0)))
    exact = vectors.shape[1] * biggest < 2**53  # in float64; else in Python's numbers, and without bounds
    kind = np.float64 if exact else object
    vectors = vectors if exact else _whole(vectors)
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)) if exact else None
    theta = 2 * np.arcsin(np.clip(forest.radius / np.maximum(2 * forest.norm, 1e-300), 0, 1))
    inner = forest.last > forest.first
    k, n = windows.k, len(windows.query)
    best = np.full((n, k), -np.inf, dtype=kind)
    found = np.full((n, k), -1, np.int64)
    heap: list[tuple] = []

    def offer(wanted, nodes, scores):
        """Take the nodes that are among the best of a window."""
        fits = (scores >= windows.low[wanted][:, None]) & (scores <= windows.high[wanted][:, None])
        asked = windows.query[wanted]
        fits &= (forest.labels[nodes] == labels[asked][:, None]) == windows.same_label
        fits &= forest.rows[nodes] != rows[asked][:, None]
        scores = np.where(fits, scores, -np.inf)
        least = best[wanted, k - 1]
        if len(nodes) > k:
            least = np.maximum(least, np.partition(scores, len(nodes) - k, axis=1)[:, len(nodes) - k])
        which, place = np.nonzero(fits & (scores >= least[:, None]))
        if not len(which):
            return
        touched = np.unique(which)
        old, slot = np.nonzero(found[wanted[touched]] >= 0)
        old = wanted[touched][old]
        window = np.concatenate([wanted[which], old])
        node = np.concatenate([nodes[place], found[old, slot]])
        score = np.concatenate([scores[which, place], best[old, slot]])
        by = np.lexsort((forest.rows[node], forest.ids[node], -score, window))
        window, node, score = window[by], node[by], score[by]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        window, node, score, rank = (x[rank < k] for x in (window, node, score, rank))
        best[window, rank], found[window, rank] = score, node

    def expand(nodes, wanted):
        asked, back = np.unique(windows.query[wanted], return_inverse=True)
        if exact:
            scores = vectors[asked] @ forest.vectors[nodes].T
        else:
            scores = np.clip(vectors[asked] @ _whole(forest.vectors[nodes]).T, -LIMIT, LIMIT)
        offer(wanted, nodes, scores[back])
        deeper = np.flatnonzero(inner[nodes])
        if not len(deeper):
            return
        below = nodes[deeper]
        if not exact:
            for node in below:
                heapq.heappush(heap, (-np.inf, int(node), wanted, np.full(len(wanted), np.inf)))
            return
        scale = np.maximum(lengths[asked][:, None] * forest.norm[below], 1e-300)
        angle = np.arccos(np.clip(scores[:, deeper] / scale, -1, 1))
        upper = (scale * (np.cos(np.maximum(angle - theta[below], 0)) + SLACK))[back]
        lower = (scale * (np.cos(np.minimum(angle + theta[below], np.pi)) - SLACK))[back]
        least = np.maximum(windows.low[wanted], best[wanted, k - 1])
        reach = (upper >= least[:, None]) & (lower <= windows.high[wanted][:, None])
        for j in np.flatnonzero(reach.any(axis=0)):
            left = np.flatnonzero(reach[:, j])
            bound = float(np.minimum(upper[left, j], windows.high[wanted[left]]).max())
            heapq.heappush(heap, (-bound, int(below[j]), wanted[left], upper[left, j]))

    if n and len(forest.roots):
        expand(forest.roots, np.arange(n))
    while heap:
        _, node, wanted, upper = heapq.heappop(heap)
        wanted = wanted[upper >= best[wanted, k - 1]]
        if len(wanted):
            expand(np.arange(forest.first[node], forest.last[node]), wanted)
    window, slot = np.nonzero(found >= 0)
    return window, found[window, slot], best[window, slot]
