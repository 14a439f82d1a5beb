"""Embedding near-dedup by a hierarchical navigable small-world graph.

A sample of the vectors, none within ``least`` of another, are pivots; one
layered graph over them leads every vector to the pivots nearest to it, its
cells.  Vectors that share a cell are compared: exactly, in double precision
where single cannot tell.  A pair that shares several cells counts in its first.
Two audits hold this against brute force, each probe counting alike: vectors
bent to the threshold, and a sample of the rows against all rows.  Until both
pass, beams widen and vectors go to more cells; then pivots get fewer, down to
one cell that holds all.  Cells too large for a task are compared by pairs of
fragments, and what is dealt out at a time is bounded, so that neither memory
nor disk grows with a group or with the number of cells.  A task returns counts
and spanning edges of the links it found, not the links.

``query_block`` searches a single graph over all vectors of a shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch

MIN_SHARDS, SHARD_ROWS, PIVOT_BYTES = 64, 2048, 64 << 20  # pivots: at least so many, one for so many vectors, as far as they fit
REACH = ((16, 6), (24, 8), (32, 10), (32, 12), (48, 16), (64, 24), (128, 48))  # beam and cells of a vector, tried in turn
FRAGMENT, FRAGMENT_BYTES = 1 << 15, 8 << 20  # vectors of a cell compared by one task, and their bytes
SLICE = 1 << 30  # bytes dealt out at a time, or 1.5 times the table
DEGREE, BUILD_BEAM, BEAM = 16, 64, 16
DENSE = 128  # a beam this wide and full of links: the query is compared with all
STEP = 1 << 22  # cosines of a comparison held at once
HITS = 1 << 16  # candidate pairs looked at at once
MANY = 0.03  # share of candidates from which full products cost less than single ones
SLOTS = 1 << 13  # of a query's table of visited nodes
AUDIT, RECALL = 64, 0.99
PROBES = 256  # of each audit of the cells
SLACK = 1e-5  # of single against double precision


class Graph:
    """Unit vectors (n, d) in single precision, and neighbours by layer (n, degree), -1 where none."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    def beam(self, layer: int, q: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``width`` (ids, cosines) found for each query, in lockstep."""
        near, m = self.layers[layer], len(q)
        row = np.arange(m)[:, None]
        # a hashed table: a node that another has put out may be looked at, and found, again
        slots = min(SLOTS, 1 << max(1, len(self.x) - 1).bit_length())
        seen = np.full((m, slots), -1, np.int32)
        ids = np.full((m, width), -1)
        sims = np.full((m, width), -np.inf, np.float32)
        first = min(width, start.shape[1])
        ids[:, :first] = start[:, :first]
        sims[:, :first] = np.where(start[:, :first] < 0, -np.inf, np.einsum("md,mkd->mk", q, self.x[start[:, :first]]))
        seen[row, ids[:, :first] % slots] = ids[:, :first]
        fresh = ids >= 0
        active = row[:, 0]
        while len(active):
            s = np.where(fresh[active], sims[active], -np.inf)
            take = min(4, width)
            pick = np.argpartition(-s, take - 1, axis=1)[:, :take] if width > take else np.tile(np.arange(width), (len(active), 1))
            ok = np.take_along_axis(s, pick, 1) > -np.inf
            live = ok.any(axis=1)
            active, pick, ok = active[live], pick[live], ok[live]
            if not len(active):
                break
            at = active[:, None]
            fresh[at, pick] = False
            new = near[np.where(ok, ids[at, pick], -1)]
            new[~ok] = -1
            new = new.reshape(len(active), -1)
            new = np.where(seen[at, new % slots] == new, -1, new)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            seen[at, new % slots] = np.where(new < 0, seen[at, new % slots], new)
            # columns without a new node for any query are left out
            new = new[:, (new >= 0).any(axis=0)]
            if not new.shape[1]:
                continue
            got = np.where(new < 0, -np.inf, np.matmul(self.x[new], q[active][:, :, None])[:, :, 0]).astype(np.float32)
            all_s = np.concatenate([sims[active], got], axis=1)
            best = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            ids[active] = np.take_along_axis(np.concatenate([ids[active], new], axis=1), best, 1)
            sims[active] = np.take_along_axis(all_s, best, 1)
            fresh[active] = np.take_along_axis(np.concatenate([fresh[active], new >= 0], axis=1), best, 1)
        return ids, sims

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """Entry points (m, 1) for layer ``to``, greedily from the top."""
        at = np.full((len(q), 1), self.entry)
        for layer in range(len(self.layers) - 1, to, -1):
            ids, sims = self.beam(layer, q, at, 4)
            at = np.take_along_axis(ids, sims.argmax(axis=1)[:, None], 1)
        return at

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return self.beam(0, q, self.descend(q, 0), width)

    def at_least(self, q: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id) arrays of all found at ``least`` cosine, and the queries left out.

        Beams double while they end full of such, up to ``DENSE``; queries with
        more neighbours than that are left to a comparison with all."""
        todo, out = np.arange(len(q)), [np.empty((2, 0), int)]
        most = max(width, DENSE)
        while len(todo) and width <= most and width < len(self.x):
            again = []
            for i in range(0, len(todo), 256):
                part = todo[i : i + 256]
                ids, sims = self.search(q[part], width)
                hit = sims >= least
                full = hit.all(axis=1)
                again.append(part[full])
                hit[full] = False
                r, c = np.nonzero(hit)
                out.append(np.unique(np.stack([part[r], ids[r, c]]), axis=1))
            todo, width = np.concatenate(again), 2 * width
        return *np.concatenate(out, axis=1), todo


def varied(x: np.ndarray, node: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Of each node's candidates (-1: none), nearest first, those that are nearer to
    the node than to any chosen before; free places go to the nearest others."""
    sims = np.where(ids < 0, -np.inf, np.einsum("md,mkd->mk", x[node], x[ids]))
    order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * keep]
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    there = sims > -np.inf
    if ids.shape[1] > 1:
        v = x[ids]
        between = np.matmul(v, v.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, bool)
        for k in range(ids.shape[1]):
            covered = (chosen & (between[:, k] > sims[:, k, None])).any(axis=1)
            chosen[:, k] = there[:, k] & ~covered & (chosen.sum(axis=1) < keep)
        there = there.astype(np.int8) + chosen
    rank = np.argsort(-there.astype(np.int8), axis=1, kind="stable")[:, :keep]
    return np.where(np.take_along_axis(there, rank, 1) > 0, np.take_along_axis(ids, rank, 1), -1)


def build(x: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM, seed: int = 5) -> Graph:
    """Batches are inserted into the layers below their drawn top; links are
    mutual, and chosen to lead in different directions."""
    n = len(x)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n)) / math.log(degree)).astype(int), 6)
    order = np.concatenate([[int(level.argmax())], np.delete(np.arange(n), level.argmax())])
    top = int(level.max())
    layers = [np.full((n, 2 * degree if k == 0 else degree), -1) for k in range(top + 1)]
    g = Graph(x, layers, int(order[0]))
    done = 1
    while done < n:
        batch = order[done : done + max(1, min(512, done))]
        q = x[batch]
        inner = q @ q.T
        np.fill_diagonal(inner, -np.inf)
        at = np.full((len(batch), 1), g.entry)
        for k in range(top, -1, -1):
            mine = np.flatnonzero(level[batch] >= k)
            if len(mine):
                ids, _ = g.beam(k, q[mine], at[mine], min(width, n))
                there = level[batch] >= k
                peers = np.where(there[None, :], inner[mine], -np.inf)
                close = np.argpartition(-peers, min(degree, len(batch) - 1), axis=1)[:, :degree]
                near = np.where(np.take_along_axis(peers, close, 1) > -np.inf, batch[close], -1)
                _connect(x, layers[k], batch[mine], varied(x, batch[mine], np.concatenate([ids, near], axis=1), degree))
            if k:
                ids, sims = g.beam(k, q, at, 4)
                at = np.take_along_axis(ids, sims.argmax(axis=1)[:, None], 1)
        done += len(batch)
    return g


def _connect(x, near, nodes, to):
    """Write the links of new nodes, and the backward ones; rows that are full
    choose again among all they have."""
    cap = near.shape[1]
    near[nodes, : to.shape[1]] = to
    src, dst = np.repeat(nodes, to.shape[1])[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
    if not len(dst):
        return
    heads = np.unique(dst)
    held = near[heads]
    old = np.stack([np.repeat(heads, cap)[held.ravel() >= 0], held.ravel()[held.ravel() >= 0]])
    pairs = np.unique(np.concatenate([old, np.stack([dst, src])], axis=1), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    heads, begin, count = np.unique(pairs[0], return_index=True, return_counts=True)
    place = np.arange(pairs.shape[1]) - np.repeat(begin, count)
    few = np.repeat(count <= cap, count)
    near[heads] = -1
    near[pairs[0, few], place[few]] = pairs[1, few]
    full = heads[count > cap]
    for i in range(0, len(full), 256):
        some = full[i : i + 256]
        mine = np.isin(pairs[0], some)
        wide = np.full((len(some), int(place[mine].max()) + 1), -1)
        wide[np.searchsorted(some, pairs[0, mine]), place[mine]] = pairs[1, mine]
        near[some] = varied(x, some, wide, cap)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def even(x: np.ndarray) -> np.ndarray:
    """Rows whose squares would over- or underflow, times a power of two: the
    cosines are the same."""
    most = np.abs(x).max(axis=1)
    odd = (most > 1e100) | (most < 1e-100)
    x[odd] = np.ldexp(x[odd], -np.frexp(most[odd])[1][:, None])
    return x


def compare(gx: np.ndarray, gid: np.ndarray, gn: np.ndarray, q: np.ndarray, qid: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries with all vectors: (links of each query, edges (a, b) that span
    what was found).  Holds ``STEP`` cosines at a time and no list of links."""
    links, own = np.zeros(len(q), np.int64), [np.empty((0, 2), np.int64)]
    group = names = np.arange(len(gx))  # of each vector, named by its first
    norm_q, norm_x, weight = np.sqrt((q * q).sum(axis=1)), np.sqrt((gx * gx).sum(axis=1)), gn.astype(np.float64)
    step = max(1, STEP // len(gx))
    for i in range(0, len(q), step):
        s = slice(i, i + step)
        near = (q[s] @ gx.T) / (norm_q[s, None] * norm_x) >= least
        near &= qid[s, None] != gid
        links[s] = near @ weight
        for me, row in zip(qid[s], near):
            at = np.flatnonzero(row)
            if not len(at):
                continue
            own.append(np.array([[me, gid[at[0]]]]))
            met = group[at]
            head = met.min()
            if met.max() != head:
                to = names.copy()
                to[met] = head
                group = to[group]
    tied = np.flatnonzero(group != names)
    return links, np.concatenate([*own, np.stack([gid[tied], gid[group[tied]]], axis=1)])


def query_block(g: Graph, gx: np.ndarray, gid: np.ndarray, gn: np.ndarray, q: np.ndarray, qid: np.ndarray, least: float):
    """(links of each query, edges (a, b) that span what was found)."""
    single = unit(q).astype(np.float32)
    width = BEAM
    # audit by brute force: own queries, and copies of the shard's vectors bent to the threshold
    planted = g.x[:: max(1, len(g.x) // AUDIT)][:AUDIT]
    noise = np.random.default_rng(11).standard_normal(planted.shape).astype(np.float32)
    noise = unit(noise - (noise * planted).sum(axis=1, keepdims=True) * planted) if g.x.shape[1] > 1 else 0 * noise
    probe = np.concatenate([single[:: max(1, len(single) // AUDIT)][:AUDIT], unit((least + 0.005) * planted + math.sqrt(max(0.0, 1 - (least + 0.005) ** 2)) * noise)])
    near = probe @ g.x.T >= least
    mine = qid[:: max(1, len(single) // AUDIT)][:AUDIT]
    near[: len(mine)] &= mine[:, None] != gid  # a vector itself is no link
    wanted = near.sum(axis=1)
    asked = wanted > 0
    while width * 2 * DEGREE < len(g.x):
        r, c, dense = g.at_least(probe, least, width)
        found = np.bincount(r, weights=near[r, c], minlength=len(probe))
        found[dense] = wanted[dense]
        if not asked.any() or (found[asked] / wanted[asked]).mean() >= RECALL:
            a, b, dense = g.at_least(single, least - SLACK, width)
            break
        width *= 2
    else:
        a, b, dense = np.empty(0, int), np.empty(0, int), np.arange(len(q))
    norm_q, norm_x = np.sqrt((q * q).sum(axis=1)), np.sqrt((gx * gx).sum(axis=1))
    keep = np.zeros(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        keep[s] = np.einsum("nd,nd->n", q[a[s]], gx[b[s]]) / (norm_q[a[s]] * norm_x[b[s]]) >= least
    a, b = a[keep], b[keep]
    own = qid[a] == gid[b]
    a, b = a[~own], b[~own]
    links = np.bincount(a, weights=gn[b], minlength=len(q)).astype(np.int64)
    links[dense], edges = compare(gx, gid, gn, q[dense], qid[dense], least)
    return links, np.concatenate([span(qid[a], gid[b]), edges])


def span(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A spanning forest of the links, as (node, smallest of its tree)."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return np.array([(x, r) for x in list(parent) if (r := find(x)) != x], np.int64).reshape(-1, 2)


def vectors(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lists of numbers as their bytes, and their lengths; null unless all are
    there and finite, and one is not zero."""
    size = np.diff(column.offsets.to_numpy()) * column.is_valid().to_numpy(zero_copy_only=False)
    x = column.flatten().to_numpy(zero_copy_only=False) + 0.0  # one zero
    start = np.concatenate([[0], np.cumsum(size)])
    sound = size > 0
    if sound.any():
        at = start[:-1][sound]
        sound[sound] = np.logical_and.reduceat(np.isfinite(x), at) & np.logical_or.reduceat(x != 0, at)
    place = (start * x.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(column), [pa.array(sound).buffers()[1], pa.py_buffer(place), pa.py_buffer(x)]), size


def matrix(column: pa.Array, exact: str) -> np.ndarray:
    """Rows of one length, in double precision, of a size that can be squared."""
    x = np.frombuffer(b"".join(column.to_pylist()), exact).astype(np.float64)
    return even(x.reshape(len(column), -1))


def lists(column: pa.Array) -> np.ndarray:
    """Lists of cells as a table, -1 where a row has fewer."""
    size = np.diff(column.offsets.to_numpy())
    out = np.full((len(size), max(1, size.max(initial=0))), -1, np.int32)
    out[np.arange(out.shape[1]) < size[:, None]] = column.flatten().to_numpy()
    return out


def apart(x: np.ndarray, least: float) -> np.ndarray:
    """Indices of a greedy choice of rows, none at ``least`` to another: a dense
    group has one pivot, whatever its size, and so one cell."""
    kept = np.empty((0, x.shape[1]), x.dtype)
    at = []
    for i in range(0, len(x), 512):
        part = np.arange(i, min(i + 512, len(x)))
        if len(kept):
            part = part[(x[part] @ kept.T).max(axis=1) < least]
        near = x[part] @ x[part].T >= least
        free = np.ones(len(part), bool)
        for k in range(len(part)):
            if free[k]:
                free[k + 1 :] &= ~near[k, k + 1 :]
        at.append(part[free])
        kept = np.concatenate([kept, x[at[-1]]])
    return np.concatenate(at)


def route(g: Graph, q: np.ndarray, beam: int, most: int, least: float) -> np.ndarray:
    """The pivots nearest to each query (n, most), -1 where fewer do.

    A pivot further off than the nearest one by over twice the threshold's angle
    is left out: no vector that links with the query can have it as its nearest."""
    most = min(most, len(g.x))
    out = np.full((len(q), most), -1, np.int32)
    for i in range(0, len(q), 256):
        ids, sims = g.search(q[i : i + 256], min(beam, len(g.x)))
        order = np.argsort(ids, axis=1)
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        sims[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
        order = np.argsort(-sims, axis=1)[:, :most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        far = np.arccos(np.clip(sims, -1, 1))
        out[i : i + 256] = np.where((sims > -np.inf) & (far <= far[:, :1] + 2 * math.acos(least) + 1e-3), ids, -1)
    return out


def bent(x: np.ndarray, cosine: float) -> np.ndarray:
    """Each unit vector turned in a random direction, to this cosine with itself."""
    noise = np.random.default_rng(11).standard_normal(x.shape).astype(np.float32)
    noise = unit(noise - (noise * x).sum(axis=1, keepdims=True) * x) if x.shape[1] > 1 else 0 * noise
    return unit(cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * noise).astype(np.float32)


def shared(a: np.ndarray, b: np.ndarray, below: int | None = None) -> np.ndarray:
    """Whether two lists of cells have one in common, and smaller than ``below``."""
    there = a >= 0 if below is None else (a >= 0) & (a < below)
    return ((a[:, :, None] == b[:, None, :]) & there[:, :, None]).any(axis=(1, 2))


def candidates(x: np.ndarray, other: np.ndarray | None, least: float):
    """Blocks of pairs (i, j, cosine), i of x and j of the other (or i < j of x), which hold
    all of at least this cosine.

    Cosines are first bounded from above by some components on the main axes of
    x and the lengths of what is left, which takes a third of the products."""
    n, d = x.shape
    y = x if other is None else other
    low_x = low_y = None
    if d >= 24 and len(y) >= 4 * d:
        axes = np.linalg.eigh(x[:: max(1, n // 4096)].T.astype(np.float64) @ x[:: max(1, n // 4096)])[1][:, -max(16, d // 3) :].astype(np.float32)

        def low(v):
            head = v @ axes
            return np.concatenate([head, np.sqrt(np.maximum(0, 1 - (head * head).sum(axis=1, keepdims=True)) + np.float32(1e-6))], axis=1)

        low_x = low(x)
        low_y = low_x if other is None else low(y)
    i = 0
    while i < n:
        first = i if other is None else 0
        step = max(1, STEP // (len(y) - first))
        whole = low_x is None
        if not whole:
            at = np.flatnonzero(low_x[i : i + step] @ low_y[first:].T >= least)
            whole = len(at) > MANY * min(step, n - i) * (len(y) - first)
        if whole:
            near = x[i : i + step] @ y[first:].T
            at = np.flatnonzero(near >= least)
        r, c = np.divmod(at, len(y) - first)
        if other is None:
            ahead = c > r
            at, r, c = at[ahead], r[ahead], c[ahead]
        for k in range(0, len(at), HITS):
            s = slice(k, k + HITS)
            a, b = r[s] + i, c[s] + first
            got = near.ravel()[at[s]] if whole else np.einsum("nd,nd->n", x[a], y[b])
            ok = got >= least
            yield a[ok], b[ok], got[ok]
        i += step


def meet(cell: int, side: np.ndarray, gid: np.ndarray, gn: np.ndarray, x: np.ndarray, cells: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each vector, spanning edges) of the pairs of a cell, or of its
    two fragments, that share no smaller cell."""
    norm = np.sqrt((x * x).sum(axis=1))
    single = (x / norm[:, None]).astype(np.float32)
    slack = SLACK + 6e-8 * x.shape[1]
    links, head = np.zeros(len(x), np.int64), np.arange(len(x))
    if side.min() == side.max():
        left = right = np.arange(len(x))
    else:
        left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    for a, b, got in candidates(single[left], None if left is right else single[right], least - slack):
        a, b = left[a], right[b]
        ok = ~shared(cells[a], cells[b], cell)
        close = np.flatnonzero(ok & (got < least + slack))
        ok[close] = np.einsum("nd,nd->n", x[a[close]], x[b[close]]) / (norm[a[close]] * norm[b[close]]) >= least
        a, b = a[ok], b[ok]
        np.add.at(links, a, gn[b])
        np.add.at(links, b, gn[a])
        while (head[a] != head[b]).any():
            p, q = head[a], head[b]
            np.minimum.at(head, np.maximum(p, q), np.minimum(p, q))
            while (head[head] != head).any():
                head = head[head]
    tied = np.flatnonzero(head != np.arange(len(x)))
    return links, np.stack([gid[tied], gid[head[tied]]], axis=1)


class Cells:
    """The pivots' graphs of each length of vectors, and how a vector is led to its cells."""

    def __init__(self, pivots: dict[int, np.ndarray], least: float, beam: int = 0, most: int = 0):
        self.least, self.beam, self.most, self.first, self.graphs = least, beam, most, {}, {}
        begin = 0
        for d, x in sorted(pivots.items()):
            self.graphs[d], self.first[d] = build(x), begin
            begin += len(x)

    def of(self, d: int, x: np.ndarray) -> np.ndarray:
        ids = route(self.graphs[d], x, self.beam, self.most, self.least)
        return np.where(ids < 0, -1, ids + self.first[d]).astype(np.int32)


def embedding_components(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9, min_shards: int = MIN_SHARDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    n_links counts the other vectors at ``least`` cosine or more, copies
    included; component_id is the smallest id reachable.  Null, empty and zero
    vectors, and those with null or non-finite components, link with nothing, as
    do vectors of different lengths with one another; components of any finite
    size are compared.  Repeated ids are vectors
    of their own; null ids take part but are never the smallest (kept is null).
    Of each length there are ``min_shards`` pivots at least, and one for ``shard_rows`` vectors.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hnsw")
    single = dict(rows.dtypes)[embedding] == "array<float>"
    exact = "<f4" if single else "<f8"  # holds the components as they came
    given = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("v"))
    id_type = given.schema["vec_id"].dataType.simpleString()

    def packed(batches):
        for b in batches:
            v, size = vectors(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), v, pa.array(size, pa.int32())], names=["vec_id", "v", "dim"])

    v = given.mapInArrow(packed, f"vec_id {id_type}, v binary, dim int")
    # 128 bits of hash stand for a vector where rows are grouped and joined
    keyed = v.select("vec_id", "v", "dim", *[F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(k), "v")).alias(f"k{k}") for k in (1, 2)])
    v = scratch.cut(keyed.select("vec_id", "k1", "k2"), "rows")
    classes = scratch.cut(keyed.where("v is not null").groupBy("k1", "k2").agg(F.first("v").alias("v"), F.first("dim").alias("dim"), F.count("*").alias("n"), F.min("vec_id").alias("rep")).select(F.monotonically_increasing_id().alias("node"), "*"), "classes")
    dims = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not dims:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    by_dim = lambda m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("dim"))
    room = PIVOT_BYTES // len(dims)
    every = {d: max(1, n // max(min_shards, min(n // shard_rows, room // (4 * d + 8 * DEGREE)))) for d, n in dims.items()}

    routed = _routed(scratch, classes, dims, every, by_dim, exact, least, f"node long, k1 long, k2 long, v binary, dim int, n long, rep {id_type}")
    scratch.drop(classes)
    row_bytes = 64 + 4 * 12 + max(dims) * int(exact[-1])
    most = max(1, min(FRAGMENT, FRAGMENT_BYTES // (4 * max(dims))))
    parts = F.ceil(F.col("count") / most).cast("int")
    sizes = scratch.cut(routed.select(F.explode("cells").alias("cell")).groupBy("cell").count(), "sizes")
    dealt = sizes.agg(F.sum(F.col("count") * parts)).first()[0]
    slices = max(1, -(-dealt * row_bytes // max(SLICE, 3 * sum(dims.values()) * row_bytes // 2)))
    large = F.broadcast(sizes.where(F.col("count") > most).select("cell", parts.alias("parts")))
    each = routed.select("node", "n", "v", "cells", F.explode("cells").alias("cell")).join(large, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    each = each.withColumn("side", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    each = each.select("cell", F.least("side", "to").alias("i"), F.greatest("side", "to").alias("j"), "side", "node", "n", "v", "cells")

    def met(t: pa.Table) -> pa.Table:
        kinds, a, b, n = [], [], [], []
        t = t.combine_chunks()
        side = t["side"].to_numpy()
        if len(t) > 1 and (side[0] != side.min() or side.min() != side.max() or t["i"][0] == t["j"][0]):
            gid = t["node"].to_numpy()
            links, edges = meet(t["cell"][0].as_py(), side, gid, t["n"].to_numpy(), matrix(t["v"], exact), lists(t["cells"].chunk(0)), least)
            some = np.flatnonzero(links)
            kinds, a, b, n = ["n"] * len(some) + ["e"] * len(edges), [gid[some], edges[:, 0]], [0 * some, edges[:, 1]], [links[some], 0 * edges[:, 0]]
        join = lambda x: pa.array(np.concatenate(x) if x else [], pa.int64())
        return pa.table({"kind": pa.array(kinds, pa.string()), "a": join(a), "b": join(b), "n": join(n)})

    found = None
    for k in range(slices):
        mine = each.where(F.pmod(F.xxhash64("cell", "i", "j"), F.lit(slices)) == k) if slices > 1 else each
        part = scratch.cut(mine.groupBy("cell", "i", "j").applyInArrow(met, "kind string, a long, b long, n long"), "found")
        scratch.collect()
        found = part if found is None else found.unionByName(part)
    counts = found.where("kind = 'n'").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    comp = components(found.where("kind = 'e'").select("a", "b"), scratch).withColumnRenamed("component", "c")
    told = scratch.cut(routed.select("node", "k1", "k2", "n", "rep").join(counts, "node", "left").join(comp, "node", "left").select("k1", "k2", "rep", F.coalesce("c", "node").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "told")
    low = scratch.cut(told.groupBy("c").agg(F.min("rep").alias("component_id")), "low")
    label = scratch.cut(told.join(low, "c").select("k1", "k2", "n_links", "component_id"), "label")
    scratch.keep(v, label)
    out = v.join(label, ["k1", "k2"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _routed(scratch, classes, dims, every, by_dim, exact, least, schema):
    """``classes`` with the cells of each, as few as pass both audits."""
    context = scratch.spark.sparkContext

    def drawn(rate, seed):
        """Unit vectors of each length, chosen by their hash; in an order of their own."""
        some = {d: [] for d in dims}
        for r in classes.where(F.pmod(F.xxhash64(F.lit(seed), "k1"), by_dim(rate)) == 0).select("dim", "k1", "k2", "node", "v").collect():
            some[r.dim].append((r.k1, r.k2, r.node, bytes(r.v)))
        some = {d: sorted(r) for d, r in some.items() if r}
        return {d: (np.array([r[2] for r in rs]), unit(even(np.frombuffer(b"".join(r[3] for r in rs), exact).astype(np.float64).reshape(-1, d))).astype(np.float32)) for d, rs in some.items()}

    probes = drawn({d: max(1, n // PROBES) for d, n in dims.items()}, 1)
    sample = {d: x for d, (_, x) in drawn(every, 2).items()}
    for d in dims.keys() - sample.keys():  # the draw may leave out a length of few vectors
        sample[d] = unit(even(np.frombuffer(classes.where(F.col("dim") == d).orderBy("k1", "k2").first().v, exact).astype(np.float64).reshape(1, d))).astype(np.float32)
    while True:
        cells = Cells({d: x[apart(x, least)] for d, x in sample.items()}, least)
        one = all(len(g.x) == 1 for g in cells.graphs.values())
        for cells.beam, cells.most in REACH:
            if not one and min(shared(cells.of(d, x), cells.of(d, bent(x, least + 0.005))).mean() for d, (_, x) in probes.items()) < RECALL:
                continue
            sent = context.broadcast(cells)

            def led(batches, sent=sent):
                for b in batches:
                    dim = b.column("dim").to_numpy()
                    out = np.full((len(dim), sent.value.most), -1, np.int32)
                    for d in np.unique(dim).tolist():
                        at = np.flatnonzero(dim == d)
                        got = sent.value.of(d, unit(matrix(b.column("v").take(pa.array(at)), exact)).astype(np.float32))
                        out[at, : got.shape[1]] = got
                    there = out >= 0
                    start = np.concatenate([[0], np.cumsum(there.sum(axis=1))])
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(out[there]))], names=[*b.schema.names, "cells"])

            routed = scratch.cut(classes.select("node", "k1", "k2", "v", "dim", "n", "rep").mapInArrow(led, schema + ", cells array<int>"), "routed")
            if one or _audit(context, routed, {d: (*p, cells.of(d, p[1])) for d, p in probes.items()}, exact, least) >= RECALL:
                return routed
            scratch.drop(routed)
        sample = {d: x[::8] for d, x in sample.items()}


def _audit(context, routed, probes, exact, least) -> float:
    """Share of the probes' links, by brute force, that their cells bring: the mean over the probes with links."""
    sent = context.broadcast(probes)

    def asked(batches):
        wanted, found = {}, {}
        for b in batches:
            dim, node = b.column("dim").to_numpy(), b.column("node").to_numpy()
            for d in np.unique(dim).tolist():
                if d not in sent.value:
                    continue
                ids, q, own = sent.value[d]
                at = np.flatnonzero(dim == d)
                x = unit(matrix(b.column("v").take(pa.array(at)), exact)).astype(np.float32)
                theirs = lists(b.column("cells").take(pa.array(at)))
                r, c = np.nonzero((q @ x.T >= least) & (ids[:, None] != node[at]))
                for k in range(0, len(r), HITS):
                    p, o = r[k : k + HITS], c[k : k + HITS]
                    for total, part in ((wanted, p), (found, p[shared(own[p], theirs[o])])):
                        for i, n in zip(*np.unique(part, return_counts=True)):
                            total[int(ids[i])] = total.get(int(ids[i]), 0) + int(n)
        names = list(wanted)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([wanted[i] for i in names], pa.int64()), pa.array([found.get(i, 0) for i in names], pa.int64())], names=["probe", "wanted", "found"])

    told = routed.select("node", "dim", "v", "cells").mapInArrow(asked, "probe long, wanted long, found long")
    mean = told.groupBy("probe").agg((F.sum("found") / F.sum("wanted")).alias("recall")).agg(F.avg("recall")).first()[0]
    return 1.0 if mean is None else mean
