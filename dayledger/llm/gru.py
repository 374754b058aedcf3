"""Gated recurrent units in numpy: forward, and back-propagation through time.

Arrays are feature-major, ``(features, sequences)`` per step, so that gates are
contiguous rows. A direction has the input table or projection outside, the
recurrent weights ``u`` (3H x H; update, reset, candidate) and ``c`` (H), the
bias of the candidate's recurrent part. A padded step has its update gate held
at one: the state passes through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

PAD_GATE = 30.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def scan(inputs: Callable[[int], np.ndarray], steps: range, n: int, u: np.ndarray, c: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step, (len(steps), H, n), stored at the step's own index."""
    h_size = len(c)
    out = np.empty((len(steps), h_size, n), np.float32)
    h = np.zeros((h_size, n), np.float32)
    bias = c[:, None]
    for t in steps:
        x, a = inputs(t), u @ h
        zr = np.tanh((x[: 2 * h_size] + a[: 2 * h_size]) * np.float32(0.5))
        zr *= np.float32(0.5)
        zr += np.float32(0.5)
        z, r = zr[:h_size], zr[h_size:]
        a[2 * h_size :] += bias
        m = np.tanh(x[2 * h_size :] + r * a[2 * h_size :])
        if keep is not None:
            keep.append((t, h, z, r, m, a[2 * h_size :]))
        h = m + z * (h - m)
        out[t] = h
    return out


def unscan(d_out: np.ndarray, keep: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the step inputs (steps, 3H, n), of ``u`` and of ``c``."""
    steps, h_size, n = d_out.shape
    d_x = np.empty((steps, 3 * h_size, n), np.float32)
    d_u, d_c, d_h = np.zeros_like(u), np.zeros(h_size, np.float32), np.zeros((h_size, n), np.float32)
    for t, h, z, r, m, a in reversed(keep):
        d = d_h + d_out[t]
        d_m = d * (1 - z) * (1 - m * m)
        d_z = d * (h - m) * z * (1 - z)
        d_r = d_m * a * r * (1 - r)
        d_a = np.concatenate([d_z, d_r, d_m * r])
        d_x[t] = np.concatenate([d_z, d_r, d_m])
        d_u += d_a @ h.T
        d_c += (d_m * r).sum(1)
        d_h = d * z + u.T @ d_a
    return d_x, d_u, d_c


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            np.clip(g, -1, 1, out=g)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            scale = self.rate * np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
            self.params[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-6)).astype(np.float32)
