"""Bottom-up merging of a bounded number of weighted centres."""

from __future__ import annotations

import numpy as np

LINKAGES = ("ward", "complete", "average", "single")
DISTANCES = ("euclidean", "l1", "l2", "manhattan", "cosine")


def pair_distances(x: np.ndarray, distance: str) -> np.ndarray:
    if distance in ("euclidean", "l2"):
        return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    if distance in ("l1", "manhattan"):
        return np.abs(x[:, None] - x[None]).sum(axis=2)
    norm = np.linalg.norm(x, axis=1)
    norm[norm == 0] = 1.0
    return np.clip(1.0 - (x / norm[:, None]) @ (x / norm[:, None]).T, 0.0, 2.0)


def merge_centres(
    centres: np.ndarray, sizes: np.ndarray, k: int, linkage: str = "ward", distance: str = "euclidean"
) -> np.ndarray:
    """Group number (0..k-1) of each centre after merging down to ``k`` groups.

    Works on the micro-cluster centres only (a few hundred). Distances between
    merged groups follow the usual update rule of each linkage, with centre
    sizes as weights, so that distinct points as centres give the full result.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}, expected one of {LINKAGES}")
    if distance not in DISTANCES:
        raise ValueError(f"unknown distance {distance!r}, expected one of {DISTANCES}")
    if linkage == "ward" and distance not in ("euclidean", "l2"):
        raise ValueError("ward linkage needs euclidean distance")
    weight = sizes.astype(float).copy()
    gap = pair_distances(centres, distance)
    if linkage == "ward":
        gap = gap**2 * (weight[:, None] * weight[None]) / (weight[:, None] + weight[None])
    np.fill_diagonal(gap, np.inf)
    groups = np.arange(len(centres))
    for _ in range(len(centres) - k):
        a, b = sorted(np.unravel_index(gap.argmin(), gap.shape))
        wa, wb = weight[a], weight[b]
        if linkage == "single":
            row = np.minimum(gap[a], gap[b])
        elif linkage == "complete":
            row = np.maximum(gap[a], gap[b])
        elif linkage == "average":
            row = (wa * gap[a] + wb * gap[b]) / (wa + wb)
        else:
            row = ((wa + weight) * gap[a] + (wb + weight) * gap[b] - weight * gap[a, b]) / (wa + wb + weight)
        row[[a, b]] = np.inf
        row[~np.isfinite(gap[a])] = np.inf
        row[a] = np.inf
        gap[a], gap[:, a] = row, row
        gap[b], gap[:, b] = np.inf, np.inf
        weight[a] = wa + wb
        groups[groups == groups[b]] = groups[a]
    _, numbered = np.unique(groups, return_inverse=True)
    return numbered
