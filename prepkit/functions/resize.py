"""Separable image resizing by weight matrices, with the usual widened filter when shrinking."""

from __future__ import annotations

import numpy as np


def _triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 - np.abs(x))


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    x = np.abs(x)
    near = (a + 2) * x**3 - (a + 3) * x**2 + 1
    far = a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


FILTERS = {"bilinear": _triangle, "bicubic": _cubic}


# Matrices made so far in this worker; a plain dict, which travels with the functions that use it.
_made: dict[tuple[int, int, str], np.ndarray] = {}
MADE_LIMIT = 64


def axis_weights(old: int, new: int, resample: str) -> np.ndarray:
    """A new x old matrix; each row sums to 1."""
    found = _made.get((old, new, resample))
    if found is None:
        if len(_made) >= MADE_LIMIT:
            _made.clear()
        found = _made[(old, new, resample)] = _weights(old, new, resample)
    return found


def _weights(old: int, new: int, resample: str) -> np.ndarray:
    scale = old / new
    centres = (np.arange(new) + 0.5) * scale
    if resample == "nearest":
        weights = np.zeros((new, old))
        weights[np.arange(new), np.minimum(centres.astype(int), old - 1)] = 1.0
        return weights
    reach = max(scale, 1.0)
    weights = FILTERS[resample]((np.arange(old) + 0.5 - centres[:, None]) / reach)
    return weights / weights.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int, resample: str) -> np.ndarray:
    """Resize a height x width x channels array; values stay within 0..255, unrounded."""
    rows = axis_weights(image.shape[0], height, resample)
    cols = axis_weights(image.shape[1], width, resample)
    tall = np.tensordot(rows, image.astype("float64"), axes=(1, 0))
    return np.clip(np.tensordot(cols, tall, axes=(1, 1)).transpose(1, 0, 2), 0.0, 255.0)
