"""A flat neighbour graph over one shard's unit vectors: robust pruning and range-expanding greedy search."""

from __future__ import annotations

import numpy as np

NEAR, FAR = 32, 16  # a node's pool: nearest rows, and nearest ones outside its tight neighbourhood
DEGREE, BACK = 20, 12  # edges a node picks, and edges to it that it takes over
ALPHA = 1.2
BEAM = 12  # nodes a search always expands
MARGIN = 0.08  # a search also expands every node found within this of the wanted cosine
QUERIES = 512
PAIRS = 1 << 18
UNSEEN = -2.0


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if k < scores.shape[1] else np.tile(np.arange(scores.shape[1]), (len(scores), 1))


def robust_pruned(x: np.ndarray, least: float) -> np.ndarray:
    """(row, DEGREE) picked neighbours, -1 where none is left.

    Of a row's pool the nearest is picked, and those that are ``ALPHA`` times nearer to it than to the row go; and so
    on.  Half of a pool comes from outside the row's tight neighbourhood, so a large group of near copies keeps ways out.
    """
    n = len(x)
    out = np.full((n, DEGREE), -1)
    if n < 2:
        return out
    for i in range(0, n, 256):
        rows = np.arange(i, min(i + 256, n))
        scores = x[rows] @ x.T
        scores[np.arange(len(rows)), rows] = UNSEEN
        pool = np.concatenate([_top(scores, min(NEAR, n)), _top(np.where(scores >= least, UNSEEN, scores), min(FAR, n))], axis=1)
        near = np.take_along_axis(scores, pool, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        pool, near = np.take_along_axis(pool, order, axis=1), np.take_along_axis(near, order, axis=1)
        vectors = x[pool]
        apart = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
        left, far = near > UNSEEN, 2 - 2 * near
        for step in range(DEGREE):
            have = np.flatnonzero(left.any(axis=1))
            if not len(have):
                break
            pick = left[have].argmax(axis=1)
            out[rows[have], step] = pool[have, pick]
            left[have] &= ALPHA * ALPHA * apart[have, pick] > far[have]
            left[have, pick] = False
    return out


def edges_both_ways(picked: np.ndarray) -> list[np.ndarray]:
    """Each row's picked neighbours and, up to ``BACK``, rows that picked it."""
    node, slot = np.nonzero(picked >= 0)
    to = picked[node, slot]
    order = np.argsort(to, kind="stable")
    starts = np.searchsorted(to[order], np.arange(len(picked) + 1))
    return [np.unique(np.concatenate([p[p >= 0], node[order[a:min(b, a + BACK)]]])) for p, a, b in zip(picked, starts[:-1], starts[1:])]


def medoid(x: np.ndarray, rows: np.ndarray) -> int:
    return int(rows[(x[rows] @ x[rows].mean(axis=0)).argmax()])


def range_search(x: np.ndarray, graph: np.ndarray, starts: list[int], least: float):
    """(first row, cosines of a slice of rows with all rows; ``UNSEEN`` where the search did not come).

    ``graph`` is (row, neighbours padded by -1).  Every row searches from ``starts`` and from itself: it expands its best
    ``BEAM`` nodes and all within ``MARGIN`` of ``least``, until nothing is left to expand.
    """
    n = len(x)
    dense = None
    for i in range(0, n, QUERIES):
        q = x[i:i + QUERIES]
        m = len(q)
        scores, done = np.full((m, n), UNSEEN), np.zeros((m, n), bool)
        scores[:, starts] = q @ x[starts].T
        scores[np.arange(m), np.arange(i, i + m)] = 1.0
        while True:
            edge = np.partition(scores, n - BEAM, axis=1)[:, n - BEAM, None] if n > BEAM else UNSEEN
            want = ~done & (scores > UNSEEN) & ((scores >= least - MARGIN) | (scores >= edge))
            who, node = np.nonzero(want)
            if not len(who):
                break
            done |= want
            new = np.zeros((m, n), bool)
            if len(who) * graph.shape[1] > m * n:
                if dense is None:
                    dense = np.zeros((n, n), np.float32)
                    a, b = np.nonzero(graph >= 0)
                    dense[a, graph[a, b]] = 1
                new |= want.astype(np.float32) @ dense > 0
            else:
                reached = graph[node]
                a, b = np.nonzero(reached >= 0)
                new[who[a], reached[a, b]] = True
            new &= scores == UNSEEN
            who, node = np.nonzero(new)
            if len(who) > m * n // 8:
                scores = np.where(new, q @ x.T, scores)
            else:
                for j in range(0, len(who), PAIRS):
                    a, b = who[j:j + PAIRS], node[j:j + PAIRS]
                    scores[a, b] = np.einsum("ij,ij->i", q[a], x[b])
        yield i, scores
