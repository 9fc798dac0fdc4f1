"""A recurrent layer in numpy: long short-term memory, forward and back through time."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def forward(z: np.ndarray, w: np.ndarray, keep: bool = False, state: list | None = None) -> tuple[np.ndarray, list]:
    """States (time, batch, units) for input activations z (time, batch, 4 units: in, forget, out, new).

    ``keep`` also returns what `back` needs.  ``state``, a list, is where reading starts (when not empty) and is
    set to where it ends, so that a long input can be read in parts.
    """
    units = w.shape[0]
    h, c = state or [np.zeros((z.shape[1], units), dtype=z.dtype)] * 2
    out, kept = np.empty((*z.shape[:2], units), dtype=z.dtype), []
    for t in range(len(z)):
        g = z[t] + h @ w
        gates = sigmoid(g[:, :3 * units])
        i, f, o = gates[:, :units], gates[:, units:2 * units], gates[:, 2 * units:]
        new, last, before = np.tanh(g[:, 3 * units:]), h, c
        c = f * c + i * new
        tc = np.tanh(c)
        out[t] = h = o * tc
        if keep:
            kept.append((i, f, o, new, before, tc, last))
    if state is not None:
        state[:] = h, c
    return out, kept


def back(dout: np.ndarray, kept: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input activations and of the recurrent weights, given those of the states."""
    units = w.shape[0]
    dz, dw = np.empty((*dout.shape[:2], 4 * units), dtype=dout.dtype), np.zeros_like(w)
    dh = dc = np.zeros((dout.shape[1], units), dtype=dout.dtype)
    for t in range(len(dout) - 1, -1, -1):
        i, f, o, new, before, tc, last = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz[t] = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                dc * i * (1 - new * new)], axis=1)
        dw += last.T @ dz[t]
        dh, dc = dz[t] @ w.T, dc * f
    return dz, dw


class Adam:
    """Adam with gradients clipped to [-1, 1]."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.step = p, 0
        self.first = {k: np.zeros_like(v) for k, v in p.items()}
        self.second = {k: np.zeros_like(v) for k, v in p.items()}

    def apply(self, grad: dict[str, np.ndarray], rate: float) -> None:
        self.step += 1
        for k, g in grad.items():
            g = np.clip(g, -1, 1)
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.99 * self.second[k] + 0.01 * g * g
            move = (self.first[k] / (1 - 0.9 ** self.step)) / (np.sqrt(self.second[k] / (1 - 0.99 ** self.step)) + 1e-8)
            self.p[k] -= (rate * move).astype(self.p[k].dtype)
