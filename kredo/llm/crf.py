"""A character tagger in numpy: bidirectional LSTM, linear layer and CRF transitions.

Arrays are time-major.  Inputs are class numbers, so the input weights are a table that is looked
up.  Both directions run in the same loop, the second on the reversed input.  The CRF works on
probabilities that are normalised at every step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from kredo.llm.ngrams import Adam, sigmoid

_DIRECTIONS = np.arange(2)[:, None]


def both_ways(x: np.ndarray) -> np.ndarray:
    """(time, 2, batch): the input forward and backward."""
    return np.stack((x, x[::-1]), axis=1)


def run_lstm(x: np.ndarray, table: np.ndarray, recur: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (time, 2, batch, hidden) for x (time, 2, batch); steps are kept in ``trace`` for training."""
    steps, _, batch = x.shape
    n = recur.shape[1]
    h, c = np.zeros((2, batch, n), table.dtype), np.zeros((2, batch, n), table.dtype)
    out = np.empty((steps, 2, batch, n), table.dtype)
    for t in range(steps):
        z = table[_DIRECTIONS, x[t]] + h @ recur
        gates = sigmoid(z[..., :3 * n])
        i, f, o = gates[..., :n], gates[..., n:2 * n], gates[..., 2 * n:]
        g = np.tanh(z[..., 3 * n:])
        before, c = (h, c), f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[t] = h
        if trace is not None:
            trace.append((before, i, f, o, g, squashed))
    return out


def back_lstm(recur: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the looked-up rows (time, 2, batch, 4 hidden) and of the recurrent weights."""
    steps, _, batch, n = d_out.shape
    dz_all = np.empty((steps, 2, batch, 4 * n))
    d_recur = np.zeros_like(recur)
    back = recur.transpose(0, 2, 1)
    dh, dc = np.zeros((2, batch, n)), np.zeros((2, batch, n))
    for t in reversed(range(steps)):
        (h0, c0), i, f, o, g, squashed = trace[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        dz = dz_all[t]
        dz[..., :n] = dc * g * i * (1 - i)
        dz[..., n:2 * n] = dc * c0 * f * (1 - f)
        dz[..., 2 * n:3 * n] = dh * squashed * o * (1 - o)
        dz[..., 3 * n:] = dc * i * (1 - g * g)
        d_recur += h0.transpose(0, 2, 1) @ dz
        dh, dc = dz @ back, dc * f
    return dz_all, d_recur


@dataclass
class Tagger:
    table: np.ndarray      # 2 x classes x 4 hidden
    recur: np.ndarray      # 2 x hidden x 4 hidden
    out: np.ndarray        # 2 hidden x tags
    bias: np.ndarray
    moves: np.ndarray      # tags x tags
    first: np.ndarray

    @staticmethod
    def fresh(classes: int, hidden: int, tags: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.4, (2, classes, 4 * hidden))
        table[..., hidden:2 * hidden] += 1.0                    # remember by default
        return Tagger(table, rng.normal(0, hidden ** -0.5, (2, hidden, 4 * hidden)),
                      rng.normal(0, 0.2, (2 * hidden, tags)), np.zeros(tags), np.zeros((tags, tags)), np.zeros(tags))

    def params(self) -> list[np.ndarray]:
        return [self.table, self.recur, self.out, self.bias, self.moves, self.first]

    def as_float32(self) -> Tagger:
        return Tagger(*(p.astype(np.float32) for p in self.params()))

    def emissions(self, x: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        states = run_lstm(both_ways(x), self.table, self.recur, trace)
        both = np.concatenate((states[:, 0], states[::-1, 1]), axis=2)
        return both @ self.out + self.bias, both

    def quick_emissions(self, x: np.ndarray) -> np.ndarray:
        """``emissions`` without a trace: the batch lies last, so gates are contiguous, and one exponential gives all
        gates of a step (tanh(z) = 2 sigmoid(2 z) - 1)."""
        n, kind = self.recur.shape[1], self.table.dtype
        scale = np.repeat(np.array([-1, -2], kind), [3 * n, n])
        table = np.ascontiguousarray((self.table * scale).transpose(0, 2, 1))         # 2 x 4 hidden x classes
        recur = np.ascontiguousarray((self.recur * scale).transpose(0, 2, 1))
        out = np.ascontiguousarray(self.out.reshape(2, n, -1).transpose(0, 2, 1))
        steps, batch = x.shape
        z, look = np.empty((2, 4 * n, batch), kind), np.empty((2, 4 * n, batch), kind)
        h, c, tmp = (np.zeros((2, n, batch), kind) for _ in range(3))
        e = np.empty((2, steps, out.shape[1], batch), kind)
        i, f, o, g = (z[:, k * n:(k + 1) * n] for k in range(4))
        with np.errstate(over="ignore"):
            for t in range(steps):
                np.take(table[0], x[t], axis=1, out=look[0], mode="clip")
                np.take(table[1], x[steps - 1 - t], axis=1, out=look[1], mode="clip")
                np.matmul(recur, h, out=z)
                z += look
                np.exp(z, out=z)
                z += 1
                np.divide(1, z, out=z)
                g *= 2
                g -= 1
                np.multiply(i, g, out=tmp)
                c *= f
                c += tmp
                np.multiply(c, -2, out=tmp)
                np.exp(tmp, out=tmp)
                tmp += 1
                np.divide(2, tmp, out=tmp)
                tmp -= 1
                np.multiply(o, tmp, out=h)
                np.matmul(out[0], h[0], out=e[0, t])
                np.matmul(out[1], h[1], out=e[1, steps - 1 - t])
        both = e[0]
        both += e[1]
        both += self.bias[:, None]
        return both.transpose(0, 2, 1)

    def forward_backward(self, e: np.ndarray):
        """Normalised forward and backward probabilities, the emission factors over their step's norm, and
        exp(moves); their product per step is the posterior of each tag."""
        move = np.exp(self.moves)
        factor = np.exp(e - e.max(axis=2, keepdims=True))
        a, b = np.empty_like(factor), np.ones_like(factor)
        now = factor[0] * np.exp(self.first)
        for t in range(len(e)):
            if t:
                now = (a[t - 1] @ move) * factor[t]
            norm = now.sum(axis=1, keepdims=True)
            a[t] = now / norm
            factor[t] /= norm
        for t in reversed(range(len(e) - 1)):
            b[t] = (factor[t + 1] * b[t + 1]) @ move.T
        return a, b, factor, move

    def may_tag(self, e: np.ndarray) -> np.ndarray:
        """Columns of the batch whose best path may hold a tag other than 0: all tags but 0 count as one, with the
        best of their emissions and moves, so that no other column's best path holds one."""
        over = e[:, :, 1:].max(axis=2) - e[:, :, 0]
        m = self.moves - self.moves[0, 0]
        enter, stay, leave = m[0, 1:].max(), m[1:, 1:].max(), m[1:, 0].max()
        inside = (self.first[1:] - self.first[0]).max() + over[0]
        most = inside + leave
        for t in range(1, len(e)):
            inside = np.maximum(inside + stay, enter) + over[t]
            np.maximum(most, inside + leave, out=most)
        return np.flatnonzero(np.maximum(most, inside) > -1e-2)

    def decode_tagged(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``decode`` of the columns that may hold a tag other than 0, after their numbers."""
        e = self.quick_emissions(x)
        at = self.may_tag(e)
        return at, *self.best(e[:, at])

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (time, batch) and the posterior probability of each."""
        return self.best(self.emissions(x)[0])

    def best(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags and their posterior probabilities from the emissions."""
        steps, batch, tags = e.shape
        best = e[0] + self.first
        came = np.zeros((steps, batch, tags), np.int8)
        for t in range(1, steps):
            each = best[:, :, None] + self.moves
            came[t] = each.argmax(axis=1)
            best = e[t] + each.max(axis=1)
        path = np.empty((steps, batch), np.int64)
        path[-1] = best.argmax(axis=1)
        rows = np.arange(batch)
        for t in reversed(range(steps - 1)):
            path[t] = came[t + 1][rows, path[t + 1]]
        a, b, _, _ = self.forward_backward(e)
        return path, np.take_along_axis(a * b, path[:, :, None], 2)[:, :, 0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean negative log likelihood, in the order of ``params``."""
        trace: list = []
        e, both = self.emissions(x, trace)
        steps, batch, tags = e.shape
        a, b, factor, move = self.forward_backward(e)
        d_moves = move * (a[:-1].reshape(-1, tags).T @ (factor[1:] * b[1:]).reshape(-1, tags))
        np.subtract.at(d_moves, (y[:-1].ravel(), y[1:].ravel()), 1)
        de = a * b
        de[np.arange(steps)[:, None], np.arange(batch), y] -= 1
        de /= batch
        d_both = de @ self.out.T
        n = self.recur.shape[1]
        dz, d_recur = back_lstm(self.recur, trace, np.stack((d_both[:, :, :n], d_both[::-1, :, n:]), axis=1))
        d_table = np.zeros_like(self.table)
        np.add.at(d_table, (np.broadcast_to(_DIRECTIONS, dz.shape[:3]), both_ways(x)), dz)
        return [d_table, d_recur, both.reshape(-1, 2 * n).T @ de.reshape(-1, tags), de.sum(axis=(0, 1)),
                d_moves / batch, de[0].sum(axis=0)]


def train(x: np.ndarray, y: np.ndarray, classes: int, tags: int, hidden: int = 12, epochs: int = 12, batch: int = 16,
          rate: float = 0.03, seed: int = 4) -> Tagger:
    """x, y: windows x time."""
    net = Tagger.fresh(classes, hidden, tags, seed)
    adams = [Adam(p.size, rate) for p in net.params()]
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            grads = net.gradients(x[rows].T, y[rows].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for p, g, adam in zip(net.params(), grads, adams):
                adam.rate = rate * (1 - epoch / epochs)
                p[...] = adam.step(p.ravel(), (g / max(1.0, norm / 5)).ravel()).reshape(p.shape)
    return net.as_float32()
