"""A bidirectional gated recurrent network over bytes, in numpy.

Every position of a window gets a class distribution from a state that has read the bytes
up to it and one that has read those after it. Gates and candidates are piecewise linear,
which costs a clip where a sigmoid would cost an exponential.
"""

from __future__ import annotations

import numpy as np

#: Bytes in a window, and positions of a batch of windows that is run in step.
WIDTH, TOGETHER = 96, 2048
HIDDEN = 8


class ByteGru:
    """``names``: classes in order; ``p``: parameters by name, f and b for the two directions."""

    def __init__(self, names: list[str], p: dict[str, np.ndarray]):
        self.names, self.p = names, p

    @staticmethod
    def fresh(names: list[str], seed: int = 7) -> ByteGru:
        rng, h = np.random.default_rng(seed), HIDDEN
        p = {"o": np.zeros(len(names))}
        for d in "fb":
            p["x" + d] = rng.normal(0, 0.3, (256, 3 * h))
            p["u" + d] = rng.normal(0, 0.3, (h, 3 * h))
            p["v" + d] = rng.normal(0, 0.3, (h, len(names)))
        return ByteGru(names, {k: v.astype(np.float32) for k, v in p.items()})

    def _step(self, d: str, h: np.ndarray, letters: np.ndarray):
        k = HIDDEN
        x, g = self.p["x" + d][letters], h @ self.p["u" + d]
        gates = np.clip(0.25 * (x[:, : 2 * k] + g[:, : 2 * k]) + 0.5, 0, 1)
        z, r = gates[:, :k], gates[:, k:]
        n = np.clip(x[:, 2 * k :] + r * g[:, 2 * k :], -1, 1)
        return h + z * (n - h), (h, gates, n, g[:, 2 * k :])

    def _back(self, d: str, dh: np.ndarray, letters: np.ndarray, kept, grad: dict) -> np.ndarray:
        """Gradient at the state before a step, from that at the state after it."""
        k = HIDDEN
        h, gates, n, gn = kept
        z, r = gates[:, :k], gates[:, k:]
        dn = dh * z * (np.abs(n) < 1)
        dgates = np.concatenate([dh * (n - h), dn * gn], axis=1) * (0.25 * ((gates > 0) & (gates < 1)))
        dx = np.concatenate([dgates, dn], axis=1)
        dg = np.concatenate([dgates, dn * r], axis=1)
        one_hot = np.zeros((len(letters), 256), dtype=dx.dtype)
        one_hot[np.arange(len(letters)), letters] = 1
        grad["x" + d] += one_hot.T @ dx
        grad["u" + d] += h.T @ dg
        return dh * (1 - z) + dg @ self.p["u" + d].T

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Loss per position and its gradients, by backpropagation through time both ways."""
        n, width = windows.shape
        columns = [windows[:, t] for t in range(width)]
        states, kept = {}, {}
        for d in "fb":
            h, states[d], kept[d] = np.zeros((n, HIDDEN), np.float32), [None] * width, [None] * width
            for t in range(width) if d == "f" else range(width - 1, -1, -1):
                h, kept[d][t] = self._step(d, h, columns[t])
                states[d][t] = h
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        ds, loss = [], 0.0
        for t in range(width):
            probs = _softmax(states["f"][t] @ self.p["vf"] + states["b"][t] @ self.p["vb"] + self.p["o"])
            loss -= float(np.log(probs[np.arange(n), labels] + 1e-9).mean()) / width
            probs[np.arange(n), labels] -= 1
            probs /= n * width
            ds.append(probs)
            grad["vf"] += states["f"][t].T @ probs
            grad["vb"] += states["b"][t].T @ probs
            grad["o"] += probs.sum(axis=0)
        for d in "fb":
            dh = np.zeros((n, HIDDEN), np.float32)
            for t in range(width - 1, -1, -1) if d == "f" else range(width):
                dh = self._back(d, dh + ds[t] @ self.p["v" + d].T, columns[t], kept[d][t], grad)
        return loss, grad

    def train(self, windows: np.ndarray, labels: np.ndarray, rounds: int = 160, batch: int = 128, rate: float = 0.03):
        """Adam over random batches in which every class has the same weight."""
        rng = np.random.default_rng(11)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        by_class = [np.flatnonzero(labels == c) for c in np.unique(labels)]
        for step in range(1, rounds + 1):
            chosen = np.concatenate([rng.choice(c, -(-batch // len(by_class))) for c in by_class])
            _, grad = self.gradients(windows[chosen], labels[chosen])
            now = rate * (1 - 0.9 * step / rounds)
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                by = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7
                self.p[k] -= (now * mean[k] / (1 - 0.9**step) / by).astype(np.float32)
        return self

    def window_sums(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum of the class probabilities of the first ``lengths`` positions of each window."""
        total = np.zeros((len(windows), len(self.names)), np.float32)
        for at in range(0, len(windows), TOGETHER):
            part = np.ascontiguousarray(windows[at : at + TOGETHER].T)
            size, width = lengths[at : at + TOGETHER], int(lengths[at : at + TOGETHER].max())
            n = part.shape[1]
            ahead = np.empty((width, n, len(self.names)), np.float32)
            for t, h in self._run("f", part, range(width), n):
                np.matmul(h, self.p["vf"], out=ahead[t])
            out = total[at : at + n]
            for t, h in self._run("b", part, range(width - 1, -1, -1), n):
                logits = h @ self.p["vb"]
                logits += ahead[t]
                logits += self.p["o"]
                np.clip(logits, -30, 30, out=logits)
                np.exp(logits, out=logits)
                logits *= ((size > t) / logits.sum(axis=1))[:, None]
                out += logits
        return total

    def _run(self, d: str, letters: np.ndarray, order, n: int):
        """The state after each position, in place: the steps of :meth:`_step` for prediction."""
        k = HIDDEN
        x, u = self.p["x" + d], self.p["u" + d]
        xz, xr, xn = (np.ascontiguousarray(m) for m in (0.25 * x[:, :k] + 0.5, 0.25 * x[:, k : 2 * k] + 0.5, x[:, 2 * k :]))
        uz, ur, un = (np.ascontiguousarray(m) for m in (0.25 * u[:, :k], 0.25 * u[:, k : 2 * k], u[:, 2 * k :]))
        h, z, r, c, g = (np.zeros((n, k), np.float32) for _ in range(5))
        for t in order:
            for into, table, weights in ((z, xz, uz), (r, xr, ur)):
                np.take(table, letters[t], axis=0, out=into, mode="clip")
                np.matmul(h, weights, out=g)
                np.add(into, g, out=into)
                np.clip(into, 0, 1, out=into)
            np.matmul(h, un, out=g)
            np.multiply(r, g, out=r)
            np.take(xn, letters[t], axis=0, out=c, mode="clip")
            np.add(c, r, out=c)
            np.clip(c, -1, 1, out=c)
            np.subtract(c, h, out=c)
            np.multiply(c, z, out=c)
            np.add(h, c, out=h)
            yield t, h


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, how many bytes each holds, and how many windows each text has."""
    counts = np.array([-(-len(t) // WIDTH) for t in texts], dtype=np.int64)
    raw = b"".join(t.ljust(int(c) * WIDTH, b" ") for t, c in zip(texts, counts, strict=True))
    lengths = np.full(int(counts.sum()), WIDTH, dtype=np.int64)
    last = np.cumsum(counts) - 1
    some = counts > 0
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    lengths[last[some]] = (sizes - (counts - 1) * WIDTH)[some]
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, WIDTH), lengths, counts
