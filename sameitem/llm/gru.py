"""A gated recurrent layer in numpy: scoring, and training by back-propagation through time.

The cell is the usual one (Cho et al., 2014)::

    z = sigmoid(x Wz + h Uz)      r = sigmoid(x Wr + h Ur)
    n = tanh(x Wn + r * (h Un))   h' = n + z * (h - n)

Inputs come as *gate inputs* ``x W + b`` (columns z, r, n), so that a caller
with few distinct inputs computes them once and looks them up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


def step(gate: np.ndarray, h: np.ndarray, u: np.ndarray) -> np.ndarray:
    """One step of all rows: ``gate`` (rows, 3H) and state ``h`` (rows, H)."""
    size = h.shape[1]
    own = h @ u
    zr = gate[:, :2 * size] + own[:, :2 * size]
    zr *= F32(0.5)
    np.tanh(zr, out=zr)
    zr *= F32(0.5)
    zr += F32(0.5)
    n = own[:, 2 * size:]
    n *= zr[:, size:]
    n += gate[:, 2 * size:]
    np.tanh(n, out=n)
    out = h - n
    out *= zr[:, :size]
    out += n
    return out


@dataclass
class Trace:
    """What the backward pass needs of one step."""

    h: np.ndarray
    z: np.ndarray
    r: np.ndarray
    n: np.ndarray
    un: np.ndarray


def step_traced(gate: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, Trace]:
    size = h.shape[1]
    own = h @ u
    z = sigmoid(gate[:, :size] + own[:, :size])
    r = sigmoid(gate[:, size:2 * size] + own[:, size:2 * size])
    un = own[:, 2 * size:]
    n = np.tanh(gate[:, 2 * size:] + r * un)
    return n + z * (h - n), Trace(h, z, r, n, un)


def step_back(grad: np.ndarray, t: Trace, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients for the gate inputs, the state before the step, and ``u``."""
    dn = grad * (1 - t.z) * (1 - t.n * t.n)
    dz = grad * (t.h - t.n) * t.z * (1 - t.z)
    dr = dn * t.un * t.r * (1 - t.r)
    own = np.concatenate([dz, dr, dn * t.r], axis=1)
    return np.concatenate([dz, dr, dn], axis=1), grad * t.z + own @ u.T, t.h.T @ own


class Cell:
    """The cell over a table of gate inputs, without traces: its columns lie apart, and halved where a sigmoid follows."""

    def __init__(self, gate: np.ndarray, u: np.ndarray):
        self.size = u.shape[0]
        cut = 2 * self.size
        self.gate_zr, self.gate_n = gate[:, :cut] * F32(0.5), np.ascontiguousarray(gate[:, cut:])
        self.u_zr, self.u_n = u[:, :cut] * F32(0.5), np.ascontiguousarray(u[:, cut:])

    def run(self, inputs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after each step, and the last: ``inputs`` (time, rows) are rows of the table."""
        out = np.empty((*inputs.shape, self.size), F32)
        for t, rows in enumerate(inputs):
            zr = h @ self.u_zr
            zr += self.gate_zr.take(rows, axis=0)
            np.tanh(zr, out=zr)
            zr *= F32(0.5)
            zr += F32(0.5)
            n = h @ self.u_n
            n *= zr[:, self.size:]
            n += self.gate_n.take(rows, axis=0)
            np.tanh(n, out=n)
            h = np.subtract(h, n, out=out[t])
            h *= zr[:, :self.size]
            h += n
        return out, h


def run_traced(gate: np.ndarray, inputs: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """As :meth:`Cell.run`, with what :func:`run_back` needs as a third result."""
    size, half = h.shape[1], F32(0.5)
    cell = Cell(gate, u)
    z, r, n, un = (np.empty((*inputs.shape, size), F32) for _ in range(4))
    states = np.empty((len(inputs) + 1, *h.shape), F32)
    states[0] = h
    for t, rows in enumerate(inputs):
        zr = states[t] @ cell.u_zr
        zr += cell.gate_zr.take(rows, axis=0)
        np.tanh(zr, out=zr)
        np.multiply(zr[:, :size], half, out=z[t])
        z[t] += half
        np.multiply(zr[:, size:], half, out=r[t])
        r[t] += half
        np.matmul(states[t], cell.u_n, out=un[t])
        np.multiply(un[t], r[t], out=n[t])
        n[t] += cell.gate_n.take(rows, axis=0)
        np.tanh(n[t], out=n[t])
        after = np.subtract(states[t], n[t], out=states[t + 1])
        after *= z[t]
        after += n[t]
    return states[1:], states[-1], (states, z, r, n, un)


def run_back(grad: np.ndarray, trace: tuple, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients for the gate inputs of a window, and for ``u``; ``grad``: of its states, (time, rows, H)."""
    states, z, r, n, un = trace
    time, rows, size = z.shape
    out, own = np.empty((time, rows, 3 * size), F32), np.empty((rows, 3 * size), F32)
    back, carry, g_u = np.ascontiguousarray(u.T), np.zeros((rows, size), F32), np.zeros_like(u)
    dz, dr, dn, rest, g = (np.empty((rows, size), F32) for _ in range(5))
    for t in range(time - 1, -1, -1):
        np.add(carry, grad[t], out=g)
        np.subtract(1, z[t], out=rest)
        np.multiply(n[t], n[t], out=dn)      # dn = g (1 - z) (1 - n n)
        np.subtract(1, dn, out=dn)
        dn *= rest
        dn *= g
        np.subtract(states[t], n[t], out=dz)  # dz = g (h - n) z (1 - z)
        dz *= z[t]
        dz *= rest
        dz *= g
        np.subtract(1, r[t], out=dr)          # dr = dn un r (1 - r)
        dr *= r[t]
        dr *= un[t]
        dr *= dn
        own[:, :size], own[:, size:2 * size] = dz, dr
        out[t, :, :2 * size], out[t, :, 2 * size:] = own[:, :2 * size], dn
        np.multiply(dn, r[t], out=own[:, 2 * size:])
        g_u += states[t].T @ own
        np.matmul(own, back, out=carry)
        g *= z[t]
        carry += g
    return out, g_u


def recurrent(rng: np.random.Generator, size: int) -> np.ndarray:
    """Start of ``u``: an orthogonal block for each gate."""
    return np.concatenate([np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(3)], axis=1).astype(F32)


class Adam:
    """Adam (Kingma and Ba, 2015) over a list of arrays, in place; gradients are clipped by their norm."""

    def __init__(self, params: list[np.ndarray], rate: float, clip: float = 5.0):
        self.params, self.rate, self.clip, self.n = params, rate, clip, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def update(self, grads: list[np.ndarray]) -> None:
        self.n += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        scale = min(1.0, self.clip / (norm + 1e-12))
        a, b = 1 - 0.9 ** self.n, 1 - 0.999 ** self.n
        for p, m, v, g in zip(self.params, self.m, self.v, grads, strict=True):
            g = g * F32(scale)
            m += F32(0.1) * (g - m)
            v += F32(0.001) * (g * g - v)
            p -= F32(self.rate / a) * m / (np.sqrt(v / F32(b)) + F32(1e-8))
