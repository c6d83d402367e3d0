"""Digamma for the mode-sized updates; the standard library has only lgamma."""

from __future__ import annotations

import math

import numpy as np

SHIFT = 8


def digamma(x):
    """Recurrence up by ``SHIFT``, then the asymptotic series."""
    x = np.asarray(x, dtype=float)
    below = sum(1.0 / (x + i) for i in range(SHIFT))
    y = x + SHIFT
    inv2 = 1.0 / (y * y)
    series = inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return np.log(y) - 0.5 / y - series - below


def log_gamma(x):
    return np.vectorize(math.lgamma, otypes=[float])(np.asarray(x, dtype=float))
