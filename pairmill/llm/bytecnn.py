"""Byte convolutional network for short texts, trained and applied in numpy.

Windows of LENGTH bytes pass through filters of several widths; a filter is a table of weights by byte and place, so
a convolution is a sum of table rows. Each filter's maximum over the window goes through a rectifier into a softmax, beside
it the shares of bytes that begin letters of the scripts, weighted by the softmax like any other feature.
For use, the tables of two neighbouring bytes are joined and held as 16-bit integers.
"""

from __future__ import annotations

import numpy as np

LENGTH = 64
WIDTHS = (2, 3, 4)
FILTERS = 16
SCALE = 1024.0
# Bytes that begin ASCII letters, other Latin letters, letters only Vietnamese has, Hangul, Han, kana, Cyrillic in UTF-8.
KINDS = ([*range(65, 91), *range(97, 123)], [0xC3], [0xC4, 0xC6, 0xE1], range(0xEA, 0xEE), range(0xE4, 0xEA), [0xE3], [0xD0, 0xD1])
DOUBTED = 0.3
#: A kind's share of a window's bytes counts so many times.
WEIGHT = 4.0


def _packed() -> np.ndarray:
    """Of each byte, its kind as one in the kind's byte of a 64-bit integer; the last byte counts bytes but the zeros that fill."""
    t = np.full(256, 1 << 56, np.uint64)
    t[0] = 0
    for k, members in enumerate(KINDS):
        t[list(members)] += np.uint64(1 << 8 * k)
    return t


_PACKED = _packed()


def shares(x: np.ndarray) -> np.ndarray:
    """Share of each kind of bytes in each window, times WEIGHT. A window has at most 255 bytes."""
    n = _PACKED[x].sum(1, dtype=np.uint64).view(np.uint8).reshape(-1, 8).astype(np.float32)
    return n[:, :7] * (WEIGHT / np.maximum(n[:, 7:], 1))


class ByteCNN:
    def __init__(self, classes: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.r, self.classes = r, classes
        self.tables = {w: r.normal(0, 0.08, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = r.normal(0, 0.1, (len(WIDTHS) * FILTERS + len(KINDS), classes)).astype(np.float32)
        self.out_bias = np.zeros(classes, np.float32)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        pooled, where = [], {}
        for w, table in self.tables.items():
            n = x.shape[1] - w + 1
            a = table[0][x[:, :n]]
            for j in range(1, w):
                a = a + table[j][x[:, j : j + n]]
            where[w] = a.argmax(1)
            pooled.append(np.take_along_axis(a, where[w][:, None, :], 1)[:, 0])
        return np.concatenate(pooled, 1) + self.bias, where

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 256, rate: float = 0.004) -> ByteCNN:
        """Adam on cross-entropy, classes weighted alike. After a third of the epochs, each leaves out rows that the network
        takes for another class (probability of their label under DOUBTED), since labels are noisy."""
        weight = 1.0 / np.maximum(np.bincount(y, minlength=self.classes), 1)
        weight *= len(y) / (weight > 0).sum()
        weight = np.minimum(weight, 20).astype(np.float32)
        params = [*self.tables.values(), self.bias, self.out, self.out_bias]
        m = [np.zeros_like(p) for p in params]
        v = [np.zeros_like(p) for p in params]
        step, keep = 0, np.ones(len(y), bool)
        for epoch in range(epochs):
            if epoch >= max(2, epochs // 3):
                keep = np.concatenate([self.probabilities(x[i : i + 4096])[np.arange(len(y[i : i + 4096])), y[i : i + 4096]] for i in range(0, len(y), 4096)]) > DOUBTED
            order = self.r.permutation(np.flatnonzero(keep))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                xb, yb = x[rows], y[rows]
                pre, where = self._forward(xb)
                h = np.maximum(pre, 0)
                drop = (self.r.random(h.shape) > 0.2).astype(np.float32) / 0.8
                hd = np.concatenate([h * drop, shares(xb)], 1)
                z = hd @ self.out + self.out_bias
                z -= z.max(1, keepdims=True)
                p = np.exp(z)
                p /= p.sum(1, keepdims=True)
                g = p
                g[np.arange(len(yb)), yb] -= 1
                g *= (weight[yb] / len(yb))[:, None]
                grads_out, grads_out_bias = hd.T @ g, g.sum(0)
                gh = (g @ self.out[: h.shape[1]].T) * drop * (pre > 0)
                grads = []
                for k, (w, table) in enumerate(self.tables.items()):
                    gw = gh[:, k * FILTERS : (k + 1) * FILTERS]
                    grad = np.zeros_like(table)
                    cols = np.broadcast_to(np.arange(FILTERS), where[w].shape)
                    for j in range(w):
                        byte = np.take_along_axis(xb, where[w] + j, 1)
                        grad[j] = np.bincount((byte.astype(np.intp) * FILTERS + cols).ravel(), gw.ravel(), 256 * FILTERS).reshape(256, FILTERS)
                    grads.append(grad)
                grads += [gh.sum(0), grads_out, grads_out_bias]
                step += 1
                lr = rate * (0.3 if epoch >= epochs - 1 else 1.0) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for q, g_, m_, v_ in zip(params, grads, m, v, strict=True):
                    m_ *= 0.9
                    m_ += 0.1 * g_
                    v_ *= 0.999
                    v_ += 0.001 * g_ * g_
                    q -= lr * m_ / (np.sqrt(v_) + 1e-8)
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([np.maximum(self._forward(x)[0], 0), shares(x)], 1) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


class Compiled:
    """The trained network with tables of byte pairs in 16-bit integers; picklable as the float weights alone."""

    def __init__(self, net: ByteCNN):
        self.weights = (net.tables, net.bias, net.out, net.out_bias)
        self.ready = None

    def __getstate__(self):
        return self.weights

    def __setstate__(self, state):
        self.weights, self.ready = state, None

    def _prepare(self):
        tables, bias, out, out_bias = self.weights
        pair = lambda t, j: np.ascontiguousarray(np.rint((t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, FILTERS) * SCALE).astype(np.int16))
        one = lambda t, j: np.rint(t[j] * SCALE).astype(np.int16)
        self.ready = (pair(tables[2], 0), pair(tables[3], 0), one(tables[3], 2), pair(tables[4], 0), pair(tables[4], 2), bias, out, out_bias)

    def log_probabilities(self, x: np.ndarray, chunk: int = 1024) -> np.ndarray:
        """Rows of LENGTH bytes -> log probability of each class."""
        if self.ready is None:
            self._prepare()
        two, three, three_b, four, four_b, bias, out, out_bias = self.ready
        res = np.empty((len(x), len(out_bias)), np.float32)
        for at in range(0, len(x), chunk):
            xb = x[at : at + chunk]
            pairs = (xb[:, :-1].astype(np.uint16) << 8) | xb[:, 1:]
            a = _top(two.take(pairs, 0))
            b = three.take(pairs[:, :-1], 0)
            b += three_b.take(xb[:, 2:], 0)
            c = four.take(pairs[:, :-2], 0)
            c += four_b.take(pairs[:, 2:], 0)
            h = np.concatenate([a, _top(b), _top(c)], 1).astype(np.float32) / SCALE + bias
            z = np.concatenate([np.maximum(h, 0), shares(xb)], 1) @ out + out_bias
            z -= z.max(1, keepdims=True)
            res[at : at + chunk] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return res


def _top(a: np.ndarray) -> np.ndarray:
    """Maximum over axis 1 by halving, which stays in long vector operations."""
    while (n := a.shape[1]) > 1:
        half = n // 2
        b = np.maximum(a[:, :half], a[:, half : 2 * half])
        if n % 2:
            np.maximum(b[:, :1], a[:, -1:], out=b[:, :1])
        a = b
    return a[:, 0]
