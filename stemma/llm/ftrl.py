"""Follow-the-regularised-leader (proximal) logistic regression over sparse rows."""

from __future__ import annotations

import numpy as np


def fit(rows, targets, weights, dims: int, alpha=0.5, beta=1.0, l1=1e-3, l2=1e-4, epochs=3, seed=7, free=None):
    """rows: (indices int32, values float32), indices distinct within a row. targets in 0..1 (soft labels allowed).
    free: where given, only these features may get negative weights. Returns float32 weights; the bias is an ordinary
    feature of the rows. No rows: all zero."""
    z, n, order = np.zeros(dims), np.zeros(dims), np.random.default_rng(seed)

    floor = np.full(dims, -np.inf if free is None else 0.0)
    if free is not None:
        floor[list(free)] = -np.inf

    def lazy(i):
        zi = z[i]
        return np.maximum(floor[i], np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)))

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, x = rows[k]
            w = lazy(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - targets[k]) * weights[k] * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    return lazy(np.arange(dims)).astype(np.float32)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
