"""Nearest points within one task's arrays: a search by cells, in batches."""

from __future__ import annotations

import numpy as np


def nearest_points(points: np.ndarray, places: np.ndarray, k: int, room: int = 400_000) -> np.ndarray:
    """For each place the indices of its k nearest points, unordered. Points are looked for in the cells around the
    place's; a place that isn't sure of its k nearest there is looked up again in cells of twice the size. room: distances
    held at once."""
    n, dims = points.shape
    k = min(k, n)
    low, span = np.minimum(points.min(0), places.min(0)), np.maximum(points.max(0), places.max(0))
    extent = np.maximum(span - low, 1e-3)
    size = max(1e-3, float(np.prod(extent) * k / n) ** (1 / dims))
    offsets = np.stack(np.meshgrid(*[np.arange(-1, 2)] * dims, indexing="ij"), -1).reshape(-1, dims)
    out, todo = np.empty((len(places), k), np.int64), np.arange(len(places))
    while len(todo):
        cells = np.floor(extent / size).astype(np.int64) + 4
        weight = np.append(np.cumprod(cells[::-1])[::-1][1:], 1)
        code = (np.floor((points - low) / size).astype(np.int64) + 1) @ weight
        asked = (np.floor((places[todo] - low) / size).astype(np.int64) + 1) @ weight
        order = np.argsort(code, kind="stable")
        known, starts = np.unique(code[order], return_index=True)
        ends = np.append(starts[1:], n)
        whole, left = size > extent.max(), []
        turn = np.argsort(asked, kind="stable")
        for own in np.split(turn, np.flatnonzero(np.diff(asked[turn])) + 1):
            cell = asked[own[0]] + offsets @ weight
            at = np.minimum(np.searchsorted(known, cell), len(known) - 1)
            at = at[known[at] == cell]
            own = todo[own]
            other = order[np.concatenate([np.arange(starts[i], ends[i]) for i in at])] if len(at) else at
            if len(other) < k:
                left.append(own)
                continue
            for part in np.array_split(own, max(1, len(own) * len(other) // room)):
                d = ((places[part, None] - points[None, other]) ** 2).sum(2)
                pick = np.argpartition(d, k - 1, axis=1)[:, :k]
                out[part] = other[pick]
                if not whole:
                    left.append(part[np.take_along_axis(d, pick, 1).max(1) > size * size])
        todo, size = np.concatenate(left) if left else todo[:0], 2 * size
    return out
