"""Plane transforms as 3 x 3 matrices, for points and boxes."""

from __future__ import annotations

from functools import reduce

import numpy as np


def then(*steps: np.ndarray) -> np.ndarray:
    """One transform that does the steps in order."""
    return reduce(lambda done, step: step @ done, steps)


def shift(dx: float, dy: float) -> np.ndarray:
    return np.array([[1, 0, dx], [0, 1, dy], [0, 0, 1]], float)


def about(m: np.ndarray, x: float, y: float) -> np.ndarray:
    """m with (x, y) as its origin."""
    return then(shift(-x, -y), m, shift(x, y))


def turn(degrees: float, scale: float) -> np.ndarray:
    c, s = np.cos(np.radians(degrees)) * scale, np.sin(np.radians(degrees)) * scale
    return np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])


def mirror(on: bool) -> np.ndarray:
    """Left and right exchanged about the origin, if ``on``."""
    return np.diag([-1.0 if on else 1.0, 1.0, 1.0])


def perspective(px: float, py: float) -> np.ndarray:
    return np.array([[1, 0, 0], [0, 1, 0], [px, py, 1]], float)


def moved(m: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """The upright boxes around the corners of boxes (rows of x1, y1, x2, y2) after the transform."""
    x1, y1, x2, y2 = boxes.T
    x, y = np.stack([x1, x2, x1, x2]), np.stack([y1, y1, y2, y2])
    depth = m[2, 0] * x + m[2, 1] * y + m[2, 2]
    u, v = (m[0, 0] * x + m[0, 1] * y + m[0, 2]) / depth, (m[1, 0] * x + m[1, 1] * y + m[1, 2]) / depth
    return np.stack([u.min(0), v.min(0), u.max(0), v.max(0)], axis=1)
