"""Hierarchical navigable small-world graphs over the vectors of one shard, in numpy.

Nodes are inserted in growing batches: a batch searches the graph as it stands, sees its own members exactly, and
links to diverse near neighbours. All searches of a batch advance together, so every step is one array operation.
"""

from __future__ import annotations

import io

import numpy as np

DEGREE = 16
BUILD_BEAM = 48
STEP = 4
BATCH = 512
# Links to others that an audit wants to see before it judges a beam.
LINKS_SEEN = 256


def _levels(n: int) -> np.ndarray:
    """Level of each node by place: one in DEGREE reaches the next level."""
    draws = np.random.default_rng(5).random(n)
    levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(DEGREE)).astype(int), 6)
    if n:
        levels[0] = levels.max()
    return levels


def _top(sims: np.ndarray, ids: np.ndarray, k: int):
    if sims.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        sims, ids = np.take_along_axis(sims, at, 1), np.take_along_axis(ids, at, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)


def _single(ids: np.ndarray) -> np.ndarray:
    """Mask of the first occurrence of each id in its row."""
    order = np.argsort(ids, axis=1, kind="stable")
    ranked = np.take_along_axis(ids, order, 1)
    first = np.concatenate([np.ones((len(ids), 1), bool), ranked[:, 1:] != ranked[:, :-1]], axis=1)
    mask = np.empty_like(first)
    np.put_along_axis(mask, order, first, 1)
    return mask


class Graph:
    def __init__(self, vectors: np.ndarray):
        """``vectors``: unit length, float32."""
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        self.level = _levels(n)
        tops = int(self.level.max()) + 1 if n else 1
        self.links = [np.full((n, 2 * DEGREE if k == 0 else DEGREE), -1, np.int32) for k in range(tops)]

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        g = cls(vectors)
        # Higher nodes first: every level is navigable before lower nodes are hung below it.
        order = np.argsort(-g.level, kind="stable")
        at, size = 0, 32
        while at < len(order):
            g._insert(order[:at], order[at: at + size])
            at += size
            size = min(2 * size, BATCH)
        return g

    def _insert(self, old: np.ndarray, new: np.ndarray) -> None:
        q = self.vectors[new]
        entry = np.full((len(new), 1), old[0] if len(old) else -1)
        for k in range(len(self.links) - 1, -1, -1):
            found_s, found_i = np.full((len(new), 1), -2, np.float32), np.full((len(new), 1), -1)
            if len(old):
                member = self.level[new] >= k
                found_s, found_i = self.search_level(q, entry, k, BUILD_BEAM if member.any() else 1)
                entry = found_i[:, :4]
            mine = np.flatnonzero(self.level[new] >= k)
            if not len(mine):
                continue
            own = q[mine] @ q[mine].T
            np.fill_diagonal(own, -2)
            sims = np.concatenate([found_s[mine], own], axis=1)
            ids = np.concatenate([found_i[mine], np.broadcast_to(new[mine], own.shape)], axis=1)
            sims, ids = _top(np.where(ids < 0, -2, sims), ids, BUILD_BEAM)
            chosen = self._diverse(sims, ids, DEGREE)
            self.links[k][new[mine], :DEGREE] = chosen
            self._answer(new[mine], chosen, k)

    def _diverse(self, sims: np.ndarray, ids: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` ids per row, nearest first, preferring those nearer to the row than to one taken before."""
        width = ids.shape[1]
        near = self.vectors[np.maximum(ids, 0)]
        between = np.matmul(near, near.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        for j in range(width):
            rival = np.where(taken, between[:, j, :], -2).max(axis=1)
            taken[:, j] = (ids[:, j] >= 0) & (sims[:, j] > -1.5) & (rival < sims[:, j]) & (taken.sum(axis=1) < degree)
        # Places left over go to the nearest of the rest.
        rank = np.where(ids < 0, 3 * width, np.where(taken, 0, width)) + np.arange(width)
        rank = np.where(sims <= -1.5, 3 * width, rank)
        order = np.argsort(rank, axis=1)[:, :degree]
        out = np.where(np.take_along_axis(rank, order, 1) >= 3 * width, -1, np.take_along_axis(ids, order, 1))
        if out.shape[1] < degree:
            out = np.concatenate([out, np.full((len(out), degree - out.shape[1]), -1)], axis=1)
        return out.astype(np.int32)

    def _answer(self, nodes: np.ndarray, chosen: np.ndarray, k: int) -> None:
        """Add the links back; a node with too many keeps diverse ones."""
        src = np.repeat(nodes, chosen.shape[1])
        dst = chosen.ravel()
        ok = dst >= 0
        src, dst = src[ok], dst[ok]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        at, start, count = np.unique(dst, return_index=True, return_counts=True)
        width = int(count.max()) if len(count) else 0
        if not width:
            return
        added = np.full((len(at), width), -1)
        place = np.arange(len(dst)) - np.repeat(start, count)
        added[np.repeat(np.arange(len(at)), count), place] = src
        for a in range(0, len(at), 256):
            rows = at[a: a + 256]
            ids = np.concatenate([self.links[k][rows], added[a: a + 256]], axis=1)
            ids = np.where(_single(ids), ids, -1)
            sims = np.einsum("qd,qkd->qk", self.vectors[rows], self.vectors[np.maximum(ids, 0)])
            sims, ids = _top(np.where(ids < 0, -2, sims), ids, 64)
            self.links[k][rows] = self._diverse(sims, ids, self.links[k].shape[1])

    def search_level(self, q: np.ndarray, entry: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``beam`` nodes of level ``k`` for each query, best first: (similarities, ids); id -1 where there is none."""
        n, m = len(self.vectors), len(q)
        seen = np.zeros((m, n + 1), bool)
        ids = np.where(_single(entry), entry, -1)
        np.put_along_axis(seen, ids, True, 1)
        sims = np.einsum("qd,qkd->qk", q, self.vectors[np.maximum(ids, 0)])
        sims = np.where(ids < 0, -2, sims).astype(np.float32)
        if ids.shape[1] < beam:
            pad = ((0, 0), (0, beam - ids.shape[1]))
            ids, sims = np.pad(ids, pad, constant_values=-1), np.pad(sims, pad, constant_values=-2)
        sims, ids = _top(sims, ids, beam)
        done = ids < 0
        live = np.arange(m)
        while len(live):
            open_ = np.where(done[live], -3, sims[live])
            step = min(STEP, beam)
            pick = np.argpartition(-open_, step - 1, axis=1)[:, :step] if beam > step else np.broadcast_to(np.arange(beam), open_.shape)
            use = np.take_along_axis(open_, pick, 1) > -2
            going = use.any(axis=1)
            live, pick, use = live[going], pick[going], use[going]
            if not len(live):
                break
            nodes = np.where(use, np.take_along_axis(ids[live], pick, 1), -1)
            mark = done[live]
            np.put_along_axis(mark, pick, True, 1)
            done[live] = mark
            nbr = np.where(nodes[:, :, None] < 0, -1, self.links[k][nodes]).reshape(len(live), -1)
            fresh = (nbr >= 0) & ~seen[live[:, None], nbr] & _single(nbr)
            nbr = np.where(fresh, nbr, -1)
            seen[live[:, None], nbr] = True
            new = np.einsum("qd,qkd->qk", q[live], self.vectors[np.maximum(nbr, 0)])
            new = np.where(fresh, new, -2).astype(np.float32)
            all_s, all_i = np.concatenate([sims[live], new], 1), np.concatenate([ids[live], nbr], 1)
            all_d = np.concatenate([done[live], ~fresh], 1)
            at = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sims[live], ids[live], done[live] = (np.take_along_axis(x, at, 1) for x in (all_s, all_i, all_d))
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(len(self.links) - 1, 0, -1):
            entry = self.search_level(q, entry, k, 4)[1][:, :4]
        return self.search_level(q, entry, 0, beam)

    def exact(self, q: np.ndarray, least: float):
        """(query, node) of all nodes at ``least`` or nearer, by comparing with all."""
        return np.nonzero(q @ self.vectors.T >= least)

    def near(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) with similarity ``least`` or more. A beam full of such nodes is widened until one is below."""
        rows, nodes = [], []
        todo = np.arange(len(q))
        while len(todo) and beam < len(self.vectors):
            full = []
            for a in range(0, len(todo), BATCH):
                part = todo[a: a + BATCH]
                sims, ids = self.search(q[part], beam)
                wide = (sims[:, -1] >= least) & (ids[:, -1] >= 0)
                hit = (sims >= least) & (ids >= 0) & ~wide[:, None]
                r, c = np.nonzero(hit)
                rows.append(part[r])
                nodes.append(ids[r, c])
                full.append(part[wide])
            todo, beam = np.concatenate(full), 2 * beam
        for a in range(0, len(todo), BATCH):
            r, c = self.exact(q[todo[a: a + BATCH]], least)
            rows.append(todo[a: a + BATCH][r])
            nodes.append(c)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows).astype(np.int64), np.concatenate(nodes).astype(np.int64)

    def audited(self, q: np.ndarray, own: np.ndarray, least: float, beam: int, audit: int, recall: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Links as in :meth:`near`, with the beam doubled until audited queries lose few of their links.

        ``own`` is each query's own node here, or -1; it counts as no link. At first ``audit`` queries are compared with all
        nodes, then more until they have :data:`LINKS_SEEN` links among them or all queries are audited, so a beam
        never passes without links to find as long as there are any. Links that an audit saw are given out too.
        """
        n = len(self.vectors)
        order = np.random.default_rng(len(q)).permutation(len(q))
        truth, done = [], 0
        while done < len(q) and sum(map(len, truth)) < LINKS_SEEN:
            more = order[done: max(audit, 4 * done)]
            for a in range(0, len(more), BATCH):
                part = more[a: a + BATCH]
                r, c = self.exact(q[part], least)
                other = own[part[r]] != c
                truth.append(part[r[other]] * n + c[other])
            done += len(more)
        known = np.concatenate(truth) if truth else np.zeros(0, np.int64)
        checked = order[:done]
        while True:
            rows, nodes = self.near(q[checked], least, beam)
            found = checked[rows] * n + nodes
            if beam >= n or np.isin(known, found).sum() >= recall * len(known):
                break
            beam *= 2
        if done < len(q):
            rows, nodes = self.near(q, least, beam)
            found = rows * n + nodes
        found = np.union1d(found, known)
        return found // n, found % n, beam

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, level=self.level, **{f"links{k}": x for k, x in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Graph:
        held = np.load(io.BytesIO(blob))
        g = cls.__new__(cls)
        g.vectors, g.level = held["vectors"], held["level"]
        g.links = [held[f"links{k}"] for k in range(len(held.files) - 2)]
        return g
