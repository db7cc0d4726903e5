"""A hierarchical navigable small-world graph over one shard of vectors, as flat numpy arrays.

Vectors are inserted in a fixed random order. A node's links go to the nearest nodes inserted before
it on each of its layers (found exactly, block by block, where the usual insertion searches), thinned
so that no link is closer to another link than to the node; the linked nodes link back as far as they
have places. So early nodes keep long links and the graph stays navigable. Searches for many queries
run side by side: a greedy walk down the upper layers, then a beam on the lowest.
"""

from __future__ import annotations

import numpy as np

LINKS = 16          # on upper layers; twice as many on the lowest
NEAR = 48           # candidates when a node is linked
BEAM = 128
ROWS = 512          # nodes linked at a time


def levels(marks: np.ndarray) -> np.ndarray:
    """A layer for each node, from its hash: each layer holds about one in ``LINKS`` of the one below."""
    u = (marks.astype(np.uint64) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-12)) / np.log(LINKS)).astype(np.int32)


def thin(sims: np.ndarray, between: np.ndarray, most: int) -> np.ndarray:
    """Which candidates (nearest first) a node links: those nearer to it than to any chosen before, then the nearest of the rest."""
    n, k = sims.shape
    chosen = np.zeros((n, k), bool)
    for c in range(k):
        shaded = (chosen & (between[:, c, :] > sims[:, c, None])).any(1)
        chosen[:, c] = ~shaded & (chosen.sum(1) < most) & np.isfinite(sims[:, c])
    rest = np.cumsum(~chosen & np.isfinite(sims), 1)
    return chosen | (~chosen & np.isfinite(sims) & (rest <= most - chosen.sum(1)[:, None]))


def layer(x: np.ndarray, links: int, places: int) -> np.ndarray:
    """Links of the nodes of one layer, ``places`` wide, -1 where free. ``x`` is in order of insertion."""
    n = len(x)
    forward = np.full((n, links), -1, np.int32)
    weight = np.full((n, links), -np.inf, np.float32)
    for at in range(0, n, ROWS):
        stop = min(n, at + ROWS)
        sims = x[at:stop] @ x[:stop].T
        sims[np.arange(stop)[None, :] >= np.arange(at, stop)[:, None]] = -np.inf
        k = min(NEAR, stop)
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        got = np.take_along_axis(sims, near, 1)
        order = np.argsort(-got, axis=1, kind="stable")
        near, got = np.take_along_axis(near, order, 1), np.take_along_axis(got, order, 1)
        c = x[near]
        pick = thin(got, np.einsum("nkd,njd->nkj", c, c, optimize=True), links)
        place = np.cumsum(pick, 1) - 1
        i, j = np.nonzero(pick)
        forward[at + i, place[i, j]] = near[i, j]
        weight[at + i, place[i, j]] = got[i, j]
    # Own links first, then links back: a node's nearest predecessor before others, then by nearness.
    i, j = np.nonzero(forward >= 0)
    start, end, w = i, forward[i, j], weight[i, j]
    own = np.concatenate([np.zeros(len(i)), np.where(j == 0, 1, 2)])
    a, b, w = np.concatenate([start, end]), np.concatenate([end, start]), np.concatenate([w, w])
    order = np.lexsort((-w, own, a))
    a, b = a[order], b[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, places), -1, np.int32)
    keep = rank < places
    out[a[keep], rank[keep]] = b[keep]
    return join_strays(out, forward)


def join_strays(out: np.ndarray, forward: np.ndarray) -> np.ndarray:
    """Gives every node that can't be walked to from the first one a link from a node that can."""
    n = len(out)
    while True:
        seen = np.zeros(n, bool)
        edge = np.zeros(min(n, 1), np.int64)
        while len(edge):
            seen[edge] = True
            nxt = np.unique(out[edge])
            edge = nxt[(nxt >= 0) & ~seen[np.maximum(nxt, 0)]]
        strays = np.flatnonzero(~seen)
        if not len(strays):
            return out
        s = int(strays[0])
        # The nearest predecessor that can be reached; all before the first stray can.
        host = int(next(h for h in forward[s] if h >= 0 and seen[h]))
        free = np.flatnonzero(out[host] < 0)
        if not len(free):
            # A full host passes the stray on to a reached node with a free place, or widens the table.
            open_ = np.flatnonzero(seen & (out < 0).any(1))
            if len(open_):
                host = int(open_[np.argmin(np.abs(open_ - host))])
                free = np.flatnonzero(out[host] < 0)
            else:
                out = np.concatenate([out, np.full((n, 1), -1, np.int32)], 1)
                free = [out.shape[1] - 1]
        out[host, free[0]] = s


class Graph:
    """``nodes[l]`` are the nodes of layer ``l``, ``links[l]`` their neighbours as node numbers."""

    def __init__(self, x: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray]):
        self.x, self.nodes, self.links = x, nodes, links

    @classmethod
    def build(cls, x: np.ndarray, marks: np.ndarray) -> "Graph":
        level = levels(marks)
        nodes, links = [], []
        for k in range(int(level.max(initial=0)) + 1):
            on = np.flatnonzero(level >= k)
            got = layer(x[on], LINKS, 2 * LINKS if k == 0 else LINKS)
            nodes.append(on.astype(np.int32))
            links.append(np.where(got >= 0, on[got], -1).astype(np.int32))
        return cls(x, nodes, links)

    def step(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        sims = np.einsum("qd,qmd->qm", q, self.x[np.maximum(ids, 0)], optimize=True)
        sims[ids < 0] = -np.inf
        return sims

    def search(self, q: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nodes found nearest to each query, and their similarity; -1 where there are fewer."""
        n, m, rows = len(self.x), len(q), np.arange(len(q))
        at = np.full(m, self.nodes[-1][0])
        for nodes, links in zip(self.nodes[:0:-1], self.links[:0:-1]):
            best = np.einsum("qd,qd->q", q, self.x[at])
            going = rows
            while len(going):
                near = links[np.searchsorted(nodes, at[going])]
                sims = self.step(q[going], near)
                top = sims.argmax(1)
                value = sims[np.arange(len(going)), top]
                better = value > best[going]
                at[going[better]] = near[better, top[better]]
                best[going[better]] = value[better]
                going = going[better]
        ids = np.full((m, beam), -1, np.int64)
        sims = np.full((m, beam), -np.inf, np.float32)
        done = np.zeros((m, beam), bool)
        seen = np.zeros((m, n), bool)
        ids[:, 0], sims[:, 0] = at, np.einsum("qd,qd->q", q, self.x[at])
        seen[rows, at] = True
        while True:
            open_ = np.where(done | (ids < 0), -np.inf, sims)
            pick = open_.argmax(1)
            going = np.flatnonzero(np.isfinite(open_[rows, pick]))
            if not len(going):
                break
            done[going, pick[going]] = True
            near = self.links[0][ids[going, pick[going]]].astype(np.int64)
            fresh = (near >= 0) & ~seen[going[:, None], np.maximum(near, 0)]
            near = np.where(fresh, near, -1)
            r, c = np.nonzero(fresh)
            seen[going[r], near[r, c]] = True
            all_ids = np.concatenate([ids[going], near], 1)
            all_sims = np.concatenate([sims[going], self.step(q[going], near)], 1)
            all_done = np.concatenate([done[going], np.zeros(near.shape, bool)], 1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[going] = np.take_along_axis(all_ids, keep, 1)
            sims[going] = np.take_along_axis(all_sims, keep, 1)
            done[going] = np.take_along_axis(all_done, keep, 1)
        ids[~np.isfinite(sims)] = -1
        order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
