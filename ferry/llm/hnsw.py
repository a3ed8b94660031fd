"""A hierarchical navigable small-world graph over one shard, in numpy.

Queries move in lockstep: one step widens the beams of all queries at once,
so the work is done by a few large array operations. Similarity is the inner
product of unit vectors.
"""

from __future__ import annotations

import math

import numpy as np

# Links per node (twice as many on the ground layer), beam while
# building, nodes that one step opens, queries that move together.
LINKS = 12
BUILD_BEAM = 48
OPEN = 4
LOCKSTEP = 1024


class Graph:
    """``layers[l]`` is an ``(n, width)`` array of neighbours, -1 for none."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 11) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(1.0 - rng.random(n)) / math.log(LINKS)).astype(int), 12)
        order = rng.permutation(n)
        # The highest node goes first, so it is the entry of every search.
        top = int(np.argmax(levels))
        order = np.concatenate(([top], order[order != top]))
        layers = [np.full((n, LINKS * 2 if k == 0 else LINKS), -1, np.int32)
                  for k in range(levels[top] + 1)]
        g = cls(vectors, layers, top)
        done = 1
        while done < n:
            batch = order[done:done + min(done, LOCKSTEP // 2)]
            g._insert(batch, levels[batch])
            done += len(batch)
        return g

    def _insert(self, batch: np.ndarray, levels: np.ndarray) -> None:
        q = self.vectors[batch]
        at = np.full(len(batch), self.entry)
        for k in range(len(self.layers) - 1, -1, -1):
            here = levels >= k
            if here.any():
                ids, sims = self._beam(k, q[here], at[here], BUILD_BEAM)
                at[here] = ids[:, 0]
                near = batch[here]
                # Nodes of the same batch cannot be found yet: add the closest.
                own = q[here] @ q[here].T
                np.fill_diagonal(own, -2)
                c = min(LINKS, len(near) - 1)
                if c > 0:
                    pick = np.argpartition(-own, c - 1, axis=1)[:, :c]
                    ids = np.hstack((ids, near[pick]))
                    sims = np.hstack((sims, np.take_along_axis(own, pick, 1)))
                self._link(k, near, ids, sims)
            rest = ~here
            if rest.any():
                at[rest] = self._greedy(k, q[rest], at[rest])

    def _spread(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` neighbours per row: the closest first, and after
        that only those closer to the node than to any chosen one; places left
        are filled with the closest of the others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        b, c = ids.shape
        v = self.vectors[np.maximum(ids, 0)]
        cross = v @ v.transpose(0, 2, 1)
        real = (ids >= 0) & (sims > -2)
        real[:, 1:] &= ids[:, 1:] != ids[:, :-1]
        chosen = np.zeros((b, c), bool)
        count = np.zeros(b, int)
        for j in range(c):
            closest = np.where(chosen, cross[:, :, j], -3.0).max(axis=1)
            ok = real[:, j] & (count < width) & (closest < sims[:, j])
            chosen[:, j] = ok
            count += ok
        rank = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)) * c + np.arange(c), axis=1)
        take = np.take_along_axis(np.where(real, ids, -1), rank, 1)[:, :width]
        if take.shape[1] < width:
            take = np.pad(take, ((0, 0), (0, width - take.shape[1])), constant_values=-1)
        return take

    def _link(self, k: int, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        adj = self.layers[k]
        width = adj.shape[1]
        # The same node may come from the beam and from the batch.
        order = np.argsort(ids, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        again = np.zeros(ids.shape, bool)
        again[:, 1:] = ids[:, 1:] == ids[:, :-1]
        ids = np.where(again | (ids == nodes[:, None]), -1, ids)
        picked = self._spread(ids, np.where(ids >= 0, sims, -2), min(width, LINKS))
        adj[nodes, :picked.shape[1]] = picked
        # Links back: old neighbours choose anew among theirs and the newcomers.
        to, new = picked.ravel(), np.repeat(nodes, picked.shape[1])
        to, new = to[to >= 0], new[to >= 0]
        order = np.argsort(to, kind="stable")
        to, new = to[order], new[order]
        who, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        for lo in range(0, int(count.max(initial=0)), width):
            part = (place >= lo) & (place < lo + width)
            rows = np.searchsorted(who, to[part])
            mine = np.unique(rows)
            extra = np.full((len(mine), width), -1, np.int32)
            extra[np.searchsorted(mine, rows), place[part] - lo] = new[part]
            node = who[mine]
            cand = np.hstack((adj[node], extra))
            cand.sort(axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            s = np.einsum("bd,bcd->bc", self.vectors[node], self.vectors[np.maximum(cand, 0)])
            adj[node] = self._spread(cand, np.where(cand >= 0, s, -2), width)

    def _greedy(self, k: int, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        best = np.einsum("qd,qd->q", q, self.vectors[at])
        moving = np.arange(len(q))
        at = at.copy()
        while len(moving):
            near = self.layers[k][at[moving]]
            s = np.einsum("qd,qcd->qc", q[moving], self.vectors[np.maximum(near, 0)])
            s[near < 0] = -2
            j = s.argmax(axis=1)
            top = s[np.arange(len(j)), j]
            up = top > best[moving]
            moving = moving[up]
            at[moving] = near[up, j[up]]
            best[moving] = top[up]
        return at

    def _beam(self, k: int, q: np.ndarray, at: np.ndarray,
              ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Beams of ``ef`` on layer ``k``: ids (-1 for none) and similarities,
        best first."""
        m, n = len(q), len(self.vectors)
        ef = min(ef, n)
        seen = np.zeros((m, n), bool)
        ids = np.full((m, ef), -1, np.int32)
        sims = np.full((m, ef), -2, np.float32)
        closed = np.ones((m, ef), bool)
        ids[:, 0], closed[:, 0] = at, False
        sims[:, 0] = np.einsum("qd,qd->q", q, self.vectors[at])
        seen[np.arange(m), at] = True
        live = np.arange(m)
        width = self.layers[k].shape[1]
        while len(live):
            score = np.where(closed[live], -3, sims[live])
            w = min(OPEN, ef)
            pick = np.argpartition(-score, w - 1, axis=1)[:, :w]
            open_ = np.take_along_axis(score, pick, 1) > -3
            more = open_.any(axis=1)
            live, pick, open_ = live[more], pick[more], open_[more]
            if not len(live):
                break
            node = np.where(open_, np.take_along_axis(ids[live], pick, 1), -1)
            flat = closed[live]
            np.put_along_axis(flat, pick, True, 1)
            closed[live] = flat
            near = np.where((node >= 0)[:, :, None], self.layers[k][np.maximum(node, 0)], -1)
            near = near.reshape(len(live), w * width)
            row, col = np.nonzero(near >= 0)
            cand = near[row, col]
            fresh = ~seen[live[row], cand]
            row, cand = row[fresh], cand[fresh]
            # A node reached twice in one step counts once.
            _, one = np.unique(row.astype(np.int64) * n + cand, return_index=True)
            row, cand = row[one], cand[one]
            if not len(row):
                continue
            seen[live[row], cand] = True
            s = np.einsum("xd,xd->x", q[live[row]], self.vectors[cand])
            count = np.bincount(row, minlength=len(live))
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            wide = int(count.max())
            new_ids = np.full((len(live), wide), -1, np.int32)
            new_sims = np.full((len(live), wide), -2, np.float32)
            new_ids[row, place], new_sims[row, place] = cand, s
            all_ids = np.hstack((ids[live], new_ids))
            all_sims = np.hstack((sims[live], new_sims))
            all_closed = np.hstack((closed[live], new_ids < 0))
            keep = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
            ids[live] = np.take_along_axis(all_ids, keep, 1)
            sims[live] = np.take_along_axis(all_sims, keep, 1)
            closed[live] = np.take_along_axis(all_closed, keep, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.full(len(q), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            at = self._greedy(k, q, at)
        return self._beam(0, q, at, ef)

    def within(self, q: np.ndarray, floor: float, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """All found ``(query, node)`` with similarity >= ``floor``. A query
        whose whole beam lies above the floor searches again, four times as
        wide, until something below it is in the beam."""
        rows, nodes = [], []
        todo = np.arange(len(q))
        while len(todo):
            again = []
            step = max(1, min(LOCKSTEP, (64 << 20) // max(len(self.vectors), 12 * ef)))
            for lo in range(0, len(todo), step):
                part = todo[lo:lo + step]
                ids, sims = self.search(q[part], ef)
                full = (sims[:, -1] >= floor) & (ef < len(self.vectors))
                hit = (sims >= floor) & (ids >= 0) & ~full[:, None]
                r, c = np.nonzero(hit)
                rows.append(part[r])
                nodes.append(ids[r, c])
                again.append(part[full])
            todo = np.concatenate(again)
            ef *= 4
        return np.concatenate(rows), np.concatenate(nodes)
