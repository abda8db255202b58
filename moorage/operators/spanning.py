"""Minimum spanning trees of mutual reachability in about n log n steps, on one machine.

All lengths here are squares. Lower bounds of distances are computed with the same roundings as distances, so what is ruled
out by them could not have been equal either.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np

#: Distances that are held at once.
BLOCK = 2_000_000


class Boxes:
    """Points in halves of halves, cut across the longer side. All leaves hold ``leaf`` places; those beyond the points are
    at infinity. Node ``a`` of a level has the nodes 2a and 2a + 1 of the next."""

    def __init__(self, x: np.ndarray, least: int):
        n, self.depth = len(x), 0
        while n >> (self.depth + 1) >= least:
            self.depth += 1
        self.leaf = -(-n // (1 << self.depth))
        places = self.leaf << self.depth
        self.order, y = np.full(places, -1), np.full((places, 2), np.inf)
        self.order[:n], y[:n] = np.arange(n), x
        for level in range(self.depth):
            part = y.reshape(1 << level, -1, 2)
            longer = (np.where(part < np.inf, part, -np.inf).max(1) - part.min(1)).argmax(1)
            by = np.take_along_axis(part, longer[:, None, None], 2)[:, :, 0].argsort(1)
            by = (by + np.arange(1 << level)[:, None] * part.shape[1]).ravel()
            self.order, y = self.order[by], y[by]
        self.real = self.order >= 0
        self.x, self.y = y[:, 0].copy(), y[:, 1].copy()
        self.lo = [self.levels(c, np.minimum) for c in (self.x, self.y)]
        self.hi = [self.levels(np.where(self.real, c, -np.inf), np.maximum) for c in (self.x, self.y)]

    def levels(self, values: np.ndarray, f: np.ufunc) -> list[np.ndarray]:
        """``f`` over the places of each node, by level."""
        out = [f.reduce(values.reshape(-1, self.leaf), axis=1)]
        while len(out[0]) > 1:
            out.insert(0, f(out[0][::2], out[0][1::2]))
        return out

    def gap(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a))
        for lo, hi in zip(self.lo, self.hi, strict=True):
            side = np.maximum(np.maximum(lo[level][b] - hi[level][a], lo[level][a] - hi[level][b]), 0.0)
            out += side * side
        return out

    def pairs(self, kept) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (a, b, gap) of leaves with a <= b, from the root down through those that ``kept(level, a, b, gap)`` keeps."""
        a = b = np.zeros(1, int)
        for level in range(self.depth + 1):
            if level:
                two = a != b
                a, b = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a[two] + 1]), np.concatenate([2 * b, 2 * b + 1, 2 * b + 1, 2 * b[two]])
            gap = self.gap(level, a, b)
            some = kept(level, a, b, gap)
            a, b, gap = a[some], b[some], gap[some]
        return a, b, gap

    def apart(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Distances of the places ``p`` and ``q``, which are broadcast."""
        with np.errstate(invalid="ignore"):
            out, other = self.x[p] - self.x[q], self.y[p] - self.y[q]
        out *= out
        other *= other
        out += other
        return out

    def places(self, leaves: np.ndarray) -> np.ndarray:
        return leaves[:, None] * self.leaf + np.arange(self.leaf)


def core_distances(boxes: Boxes, k: int) -> np.ndarray:
    """Distance of the point at each place to its k-th neighbour."""
    size, n = boxes.leaf, len(boxes.x)
    first = np.empty((n, k + 1))
    step = max(1, BLOCK // size**2)
    for at in range(0, n // size, step):
        own = boxes.places(np.arange(at, min(at + step, n // size)))
        d = boxes.apart(own[:, :, None], own[:, None, :])
        d[np.isnan(d)] = np.inf
        first[own.ravel()] = np.partition(d, k, axis=2)[:, :, : k + 1].reshape(-1, k + 1)
    far = np.where(boxes.real, first[:, k], -np.inf)
    reach = boxes.levels(far, np.maximum)
    a, b, gap = boxes.pairs(lambda level, a, b, gap: gap < np.maximum(reach[level][a], reach[level][b]))
    two = a != b
    a, b, gap = np.concatenate([a[two], b[two]]), np.concatenate([b[two], a[two]]), np.concatenate([gap[two], gap[two]])
    some = gap < reach[-1][a]
    a, b = a[some], b[some]
    who, near = [np.empty(0, int)], [np.empty(0)]
    for at in range(0, len(a), step):
        p, leaf = boxes.places(a[at : at + step]), b[at : at + step, None]
        gap = np.zeros(p.shape)
        for c, lo, hi in zip((boxes.x, boxes.y), boxes.lo, boxes.hi, strict=True):
            side = np.maximum(np.maximum(lo[-1][leaf] - c[p], c[p] - hi[-1][leaf]), 0.0)
            gap += side * side
        i, j = np.nonzero(gap < far[p])
        p, d = p[i, j], boxes.apart(p[i, j][:, None], boxes.places(leaf[i, 0]))
        i, j = np.nonzero(d < far[p][:, None])
        who.append(p[i]), near.append(d[i, j])
    who, near = np.concatenate(who), np.concatenate(near)
    some = np.unique(who)
    who, near = np.concatenate([np.repeat(some, k + 1), who]), np.concatenate([first[some].ravel(), near])
    by = np.lexsort((near, who))
    far[some] = near[by][np.searchsorted(who[by], some) + k]
    return far


def shortest_edges(boxes: Boxes, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (u, v, length) of places that hold all edges of all minimum spanning trees (Boruvka).

    In each round every component is joined to another by its shortest edge, by places among equals. All others of that
    length are taken along: an edge of any minimum spanning tree is as short as the shortest one of one of the components
    at its ends in the round that brings these together.
    """
    size, n = boxes.leaf, len(boxes.x)
    core = np.where(boxes.real, core, np.inf)
    dense = boxes.levels(core, np.minimum)
    of = np.where(boxes.real, np.cumsum(boxes.real) - 1, -1)
    parts = int(boxes.real.sum())
    leaves = np.arange(n // size)
    step = max(1, BLOCK // size**2)
    out = []
    while parts > 1:
        # the shortest edge of each component that is known so far
        bound = np.full(parts, np.inf)
        lowest = boxes.levels(np.where(boxes.real, of, parts), np.minimum)
        highest = boxes.levels(of, np.maximum)
        found = []

        def shorten(c, length, bound=bound):
            some = length < bound[c]
            np.minimum.at(bound, c[some], length[some])

        def sample(p, q, of=of, shorten=shorten):
            some = (of[p] != of[q]) & boxes.real[p] & boxes.real[q]
            p, q = p[some], q[some]
            length = np.maximum(np.maximum(boxes.apart(p, q), core[p]), core[q])
            shorten(of[p], length), shorten(of[q], length)

        def widest(level, bound=bound, of=of):
            return np.where(boxes.real, bound[of], -np.inf).reshape(1 << level, -1).max(1)

        def compare(a, b, least, bound=bound, of=of, shorten=shorten, found=found):
            for at in range(0, len(a), step):
                most = bound[of]
                wide = np.where(boxes.real, most, -np.inf).reshape(-1, size).max(1)
                some = at + np.flatnonzero(least[at : at + step] <= np.maximum(wide[a[at : at + step]], wide[b[at : at + step]]))
                p, q = boxes.places(a[some]), boxes.places(b[some])
                d = boxes.apart(p[:, :, None], q[:, None, :])
                np.maximum(d, core[p][:, :, None], out=d)
                np.maximum(d, core[q][:, None, :], out=d)
                d[(of[p][:, :, None] == of[q][:, None, :]) | ~(d < np.inf)] = np.inf
                shorten(of[p].ravel(), d.min(2).ravel()), shorten(of[q].ravel(), d.min(1).ravel())
                i, j, k = np.nonzero((d <= np.maximum(bound[of[p]][:, :, None], bound[of[q]][:, None, :])) & (d < np.inf))
                u, v = p[i, j], q[i, k]
                once = (u < v) | (a[some][i] != b[some][i])
                found.append((u[once], v[once], d[i, j, k][once]))

        mixed = leaves[lowest[-1] < highest[-1]]
        compare(mixed, mixed, np.zeros(len(mixed)))
        for k in range(n.bit_length() - 1):
            p = np.flatnonzero((bound[of] == np.inf) & boxes.real)
            sample(p, (p + (1 << k)) % n)

        def kept(level, a, b, gap, lowest=lowest, highest=highest, sample=sample, widest=widest):
            least = np.maximum(np.maximum(gap, dense[level][a]), dense[level][b])
            wide = widest(level)
            whole = (lowest[level][a] == highest[level][a]) & (lowest[level][b] == highest[level][b]) & (lowest[level][a] == lowest[level][b])
            some = ~whole & (least <= np.maximum(wide[a], wide[b]))
            span, i = n >> level, np.flatnonzero(some)
            for at in (0, span // 2):
                sample(a[i] * span + at, b[i] * span + at)
            wide = widest(level)
            return some & (least <= np.maximum(wide[a], wide[b]))

        a, b, gap = boxes.pairs(kept)
        two = a != b
        a, b, gap = a[two], b[two], gap[two]
        least = np.maximum(np.maximum(gap, dense[-1][a]), dense[-1][b])
        by = least.argsort()
        compare(a[by], b[by], least[by])
        u, v, length = (np.concatenate(c) for c in zip(*found, strict=True))
        some = (length == bound[of[u]]) | (length == bound[of[v]])
        u, v, length = np.minimum(u, v)[some], np.maximum(u, v)[some], length[some]
        by = np.lexsort((v, u, length))
        u, v, length = u[by], v[by], length[by]
        out.append((u, v, length))
        pick = np.full(parts, len(u))
        for c in (of[u], of[v]):
            mine = np.flatnonzero(length == bound[c])
            np.minimum.at(pick, c[mine], mine)
        up = of[u[pick]] + of[v[pick]] - np.arange(parts)
        up = np.where((up[up] == np.arange(parts)) & (np.arange(parts) < up), np.arange(parts), up)
        while (up[up] != up).any():
            up = up[up]
        roots, up = np.unique(up, return_inverse=True)
        parts, of = len(roots), np.where(boxes.real, up[of], -1)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def prim(n: int, u: np.ndarray, v: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source, node, length): from node 0 always the nearest node, the smallest one among equals, by its edge from the node
    that was there first."""
    known, rank = np.unique(length, return_inverse=True)
    ends, keys = np.concatenate([u, v]), np.concatenate([rank * n + v, rank * n + u])
    by = ends.argsort(kind="stable")
    start = np.searchsorted(ends[by], np.arange(n + 1)).tolist()
    ways = keys[by].tolist()
    there, heap, taken, node = bytearray(n), [], [], 0
    there[0] = 1
    for _ in range(n - 1):
        for key in ways[start[node] : start[node + 1]]:
            if not there[key % n]:
                heappush(heap, key)
        while there[node]:
            key = heappop(heap)
            node = key % n
        there[node] = 1
        taken.append(key)
    taken = np.array(taken, dtype=np.int64)
    when = np.zeros(n, int)
    when[taken % n] = np.arange(1, n)
    by = np.lexsort((when[ends], keys))
    return ends[by][np.searchsorted(keys[by], taken)], taken % n, known[taken // n] if n > 1 else np.empty(0)


def spanning_tree(x: np.ndarray, k: int) -> np.ndarray:
    """Edges (a, b, distance) of the minimum spanning tree of mutual reachability by the k-th neighbour, shortest first, and
    those of equal length in the order in which Prim's method takes them from the first point on.

    Of equal points beyond ``k`` one stands for all: the others follow it at no distance.
    """
    n = len(x)
    k = min(k, n - 1)
    by = np.lexsort((x[:, 1], x[:, 0]))
    starts = np.flatnonzero(np.r_[True, (x[by][1:] != x[by][:-1]).any(1)])
    sizes = np.diff(np.r_[starts, n])
    at = np.arange(n) - np.repeat(starts, sizes)
    many = np.repeat(sizes > k, sizes)
    rows, least = np.sort(by[~many | (at <= k)]), max(8, k + 1)
    boxes = Boxes(x[rows], least)
    core = np.empty(n)
    core[rows[boxes.order[boxes.real]]] = core_distances(boxes, k)[boxes.real]
    if many.any():
        rows = np.sort(by[~many | (at == 0)])
        boxes = Boxes(x[rows], least)
    u, v, length = shortest_edges(boxes, core[rows][boxes.order])
    source, node, length = prim(len(rows), boxes.order[u], boxes.order[v], length)
    # each row is followed by those it stands for
    count, where = np.ones(n, int), np.empty(n, int)
    count[by[starts]] = np.where(many[starts], sizes, 1)
    where[by] = np.arange(n)
    order = np.r_[0, rows[node]]
    count = count[order]
    lead = np.repeat(order, count)
    turn = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
    edges = np.empty((n, 3))
    edges[:, 0] = np.where(turn > 0, lead, np.repeat(np.r_[0, rows[source]], count))
    edges[:, 1] = by[where[lead] + turn]
    edges[:, 2] = np.where(turn > 0, 0.0, np.repeat(np.r_[0.0, np.sqrt(length)], count))
    edges = edges[1:]
    return edges[np.argsort(edges[:, 2], kind="stable")]
