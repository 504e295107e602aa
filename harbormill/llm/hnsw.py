"""A hierarchical navigable small-world graph over the rows of a matrix, built and searched in batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 24  # links of a node
BUILD_BEAM = 48
LEVEL_RATIO = 16  # a level has so many times fewer nodes than the one below
CHUNK = 256


@dataclass
class Level:
    nodes: np.ndarray  # rows of the matrix
    links: np.ndarray  # positions in nodes, -1 where there is none


def _best(sims: np.ndarray, k: int) -> np.ndarray:
    k = min(k, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1)


def _search(vectors: np.ndarray, level: Level, queries: np.ndarray, entry: np.ndarray, beam: int, seen_rows: int):
    """Beam search of all queries at once: (positions, similarities), best first; -1 where the beam is not full.

    ``entry`` holds start positions per query, -1 for none.
    """
    q = len(queries)
    beam = min(beam, seen_rows)
    seen = np.zeros((q, seen_rows + 1), dtype=bool)  # the last column stands for "no node"
    rows = np.arange(q)[:, None]
    seen[rows, entry] = True
    at = vectors[level.nodes[entry]]
    sims = np.where(entry >= 0, np.einsum("qed,qd->qe", at, queries), -np.inf)
    width = max(beam, entry.shape[1])
    ids = np.full((q, width), -1)
    score = np.full((q, width), -np.inf, dtype=queries.dtype)
    ids[:, : entry.shape[1]], score[:, : entry.shape[1]] = entry, sims
    done = ids < 0
    while True:
        waiting = np.where(done, -np.inf, score)
        pick = waiting.argmax(axis=1)
        active = np.nonzero(waiting[np.arange(q), pick] > -np.inf)[0]
        if not len(active):
            break
        done[active, pick[active]] = True
        near = level.links[ids[active, pick[active]]]
        fresh = ~seen[active[:, None], near] & (near >= 0)
        near = np.where(fresh, near, -1)
        seen[active[:, None], near] = True
        s = np.where(fresh, np.einsum("qed,qd->qe", vectors[level.nodes[near]], queries[active]), -np.inf)
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_score = np.concatenate([score[active], s], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        keep = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, keep, 1)
        score[active] = np.take_along_axis(all_score, keep, 1)
        done[active] = np.take_along_axis(all_done, keep, 1)
    order = np.argsort(-score, axis=1, kind="stable")[:, :beam]
    score = np.take_along_axis(score, order, 1)
    return np.where(score > -np.inf, np.take_along_axis(ids, order, 1), -1), score


def _choose(vectors: np.ndarray, nodes: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (positions, -1 for none, best first) those nearer to the row than to any chosen one;
    places left over go to the best of the rest."""
    out = np.full((len(own), degree), -1)
    for lo in range(0, len(own), CHUNK):
        c = candidates[lo : lo + CHUNK]
        at = vectors[nodes[c]]
        to_own = np.where(c >= 0, np.einsum("qed,qd->qe", at, vectors[nodes[own[lo : lo + CHUNK]]]), -np.inf)
        order = np.argsort(-to_own, axis=1, kind="stable")
        c, to_own = np.take_along_axis(c, order, 1), np.take_along_axis(to_own, order, 1)
        at = np.take_along_axis(at, order[:, :, None], 1)
        between = at @ at.transpose(0, 2, 1)
        chosen = np.zeros(c.shape, dtype=bool)
        for j in range(c.shape[1]):
            nearest = np.where(chosen[:, :j], between[:, j, :j], -np.inf).max(axis=1, initial=-np.inf)
            chosen[:, j] = (to_own[:, j] > nearest) & (c[:, j] >= 0) & (chosen.sum(axis=1) < degree)
        rank = np.where(c < 0, 2, np.where(chosen, 0, 1)) * c.shape[1] + np.arange(c.shape[1])
        take = np.argsort(rank, axis=1)[:, :degree]
        out[lo : lo + CHUNK, : take.shape[1]] = np.take_along_axis(c, take, 1)
    return out


def _repeats_out(candidates: np.ndarray) -> np.ndarray:
    """Each row's ids once; the others become -1."""
    c = np.sort(candidates, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    return c


def _insert(vectors: np.ndarray, level: Level, new: np.ndarray, found: np.ndarray) -> None:
    """Link the new positions to the best of ``found`` and back."""
    level.links[new] = _choose(vectors, level.nodes, new, found, DEGREE)
    source = np.repeat(new, DEGREE)
    target = level.links[new].ravel()
    ok = target >= 0
    source, target = source[ok], target[ok]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    ends, first, count = np.unique(target, return_index=True, return_counts=True)
    for lo in range(0, len(ends), CHUNK):
        e, f, n = ends[lo : lo + CHUNK], first[lo : lo + CHUNK], count[lo : lo + CHUNK]
        wide = int(n.max())
        back = np.full((len(e), wide), -1)
        place = np.arange(wide)[None, :]
        mask = place < n[:, None]
        back[mask] = source[(f[:, None] + place)[mask]]
        merged = np.concatenate([level.links[e], back], axis=1)
        merged = _repeats_out(np.where(merged == e[:, None], -1, merged))
        if merged.shape[1] > 4 * DEGREE:  # a hub: its nearest ends are enough to choose from
            s = np.where(merged >= 0, np.einsum("qed,qd->qe", vectors[level.nodes[merged]], vectors[level.nodes[e]]), -np.inf)
            merged = np.take_along_axis(merged, _best(s, 4 * DEGREE), 1)
        level.links[e] = _choose(vectors, level.nodes, e, merged, DEGREE)


def build(vectors: np.ndarray, seed: int = 0) -> list[Level]:
    """Levels from the top (fewest nodes) down. Nodes are inserted in growing batches: each batch searches what is
    already linked, from the nodes the level above leads to, and is compared with itself."""
    n = len(vectors)
    order = np.random.default_rng(seed).permutation(n)
    sizes = [n]
    while sizes[-1] > 4 * CHUNK:
        sizes.append(sizes[-1] // LEVEL_RATIO)
    levels: list[Level] = []
    for size in reversed(sizes):
        level = Level(order[:size], np.full((size, DEGREE), -1))
        at = 0
        while at < size:
            batch = min(size - at, max(64, min(at, 2 * CHUNK)))
            new = np.arange(at, at + batch)
            own = vectors[level.nodes[new]]
            inside = own @ own.T
            np.fill_diagonal(inside, -np.inf)
            near = at + _best(inside, min(BUILD_BEAM, batch)) if batch > 1 else np.full((batch, 1), -1)
            near = np.where(near == new[:, None], -1, near)
            if at:
                entry = _descend(vectors, levels, own)
                entry = np.where(entry < at, entry, 0)
                old, _ = _search(vectors, level, own, entry, BUILD_BEAM, at)
                near = np.concatenate([near, old], axis=1)
            _insert(vectors, level, new, near)
            at += batch
        levels.append(level)
    return levels


def _descend(vectors: np.ndarray, levels: list[Level], queries: np.ndarray) -> np.ndarray:
    """Start positions for the level below the given ones. Positions of a level are the first ones of the next."""
    entry = np.zeros((len(queries), 1), dtype=np.int64)
    for level in levels:
        entry, _ = _search(vectors, level, queries, entry, 4, len(level.nodes))
    return entry


def search(vectors: np.ndarray, levels: list[Level], queries: np.ndarray, beam: int):
    """(rows of the matrix, similarities) per query, best first; -1 where there is none. A beam as wide as the
    matrix is a scan and is done as one."""
    n = len(vectors)
    if beam >= n:
        sims = queries @ vectors.T
        order = np.argsort(-sims, axis=1, kind="stable")
        return order, np.take_along_axis(sims, order, 1)
    bottom = levels[-1]
    found, sims = _search(vectors, bottom, queries, _descend(vectors, levels[:-1], queries), beam, n)
    return np.where(found >= 0, bottom.nodes[found], -1), sims
