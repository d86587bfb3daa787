"""Small in-memory counterparts the Spark results are compared with."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np


def plain_pagerank(vertices, edges, seeds=None, max_iter=20, epsilon=1e-3, damping=0.85):
    """Ranks by id and the L1 change of every round, by dense vectors."""
    ids = sorted(vertices)
    place = {v: i for i, v in enumerate(ids)}
    n = len(ids)
    degree = defaultdict(int)
    for src, _ in edges:
        degree[src] += 1
    known = [(place[s], place[t], 1.0 / degree[s]) for s, t in edges if s in place and t in place]
    src = np.array([k[0] for k in known], dtype=int)
    dst = np.array([k[1] for k in known], dtype=int)
    weight = np.array([k[2] for k in known])
    dangling = np.array([degree[v] == 0 for v in ids])
    if seeds is None:
        jump = np.full(n, (1 - damping) / n)
    else:
        chosen = set(seeds)
        jump = np.array([(1 - damping) / len(chosen) if v in chosen else 0.0 for v in ids])
    rank = np.full(n, 1.0 / n)
    changes = []
    for _ in range(max_iter):
        got = np.bincount(dst, weights=rank[src] * weight, minlength=n) if len(src) else np.zeros(n)
        after = jump + damping * (got + rank[dangling].sum() / n)
        changes.append(float(np.abs(after - rank).sum()))
        rank = after
        if changes[-1] < epsilon:
            break
    return dict(zip(ids, rank.tolist())), changes


def library_random_edges(num_nodes: int, num_edges: int, seed: int) -> list[tuple[int, int]]:
    """Distinct non-loop pairs drawn one number at a time from Python's own generator."""
    draw = random.Random(seed)
    kept: dict[tuple[int, int], None] = {}
    for _ in range(10 * num_edges):
        if len(kept) == num_edges:
            break
        pair = tuple(draw.randint(0, num_nodes - 1) for _ in range(2))
        if pair[0] != pair[1]:
            kept.setdefault(pair)
    return list(kept)
