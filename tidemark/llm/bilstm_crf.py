"""A bidirectional LSTM over symbols with a linear-chain CRF on top, in numpy: trained on tagged windows, decoded by Viterbi.

All windows have the same length. Both directions are stepped through together; what a symbol adds to the gates is a row of a table.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
EPOCHS = 16
BATCH = 64
RATE = 0.02


def _gates(z: np.ndarray, h: int) -> np.ndarray:
    """Input, forget and output gates by the logistic function, the candidate by tanh."""
    z[..., : 3 * h] *= 0.5
    np.tanh(z, out=z)
    z[..., : 3 * h] *= 0.5
    z[..., : 3 * h] += 0.5
    return z


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """``weights``: ``E`` and ``U`` by direction, ``O`` and ``b`` to the tags, ``A`` between tags, ``first`` for a window's first tag.

    ``barred`` tells which tag must not follow which.
    """

    def __init__(self, weights: dict[str, np.ndarray], barred: np.ndarray):
        self.weights, self.barred = weights, barred

    @staticmethod
    def fresh(symbols: int, tags: int, barred: np.ndarray, hidden: int = HIDDEN, seed: int = 0) -> Tagger:
        random = np.random.default_rng(seed)
        draw = lambda *shape, spread: random.normal(0, spread, shape).astype(np.float32)
        w = {"E": draw(2, symbols, 4 * hidden, spread=0.3), "U": draw(2, hidden, 4 * hidden, spread=hidden**-0.5), "O": draw(2, hidden, tags, spread=hidden**-0.5)}
        w["E"][:, :, hidden : 2 * hidden] += 1  # remember at first
        return Tagger(w | {"b": np.zeros(tags, np.float32), "A": np.zeros((tags, tags), np.float32), "first": np.zeros(tags, np.float32)}, barred)

    def _states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states by step, direction and window; the second direction's steps run from the end."""
        w = self.weights
        h, (n, steps) = w["U"].shape[1], x.shape
        hidden, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        out = np.empty((steps, 2, n, h), np.float32)
        for t in range(steps):
            z = np.matmul(hidden, w["U"])
            z[0] += w["E"][0][x[:, t]]
            z[1] += w["E"][1][x[:, steps - 1 - t]]
            z = _gates(z, h)
            before = cell
            cell = z[..., h : 2 * h] * cell + z[..., :h] * z[..., 3 * h :]
            squashed = np.tanh(cell)
            if keep is not None:
                keep.append((z, before, squashed, hidden))
            hidden = z[..., 2 * h : 3 * h] * squashed
            out[t] = hidden
        return out

    def _scores(self, states: np.ndarray) -> np.ndarray:
        """Scores of the tags by step and window."""
        w = self.weights
        return states[:, 0] @ w["O"][0] + states[::-1, 1] @ w["O"][1] + w["b"]

    def _between(self) -> np.ndarray:
        return np.where(self.barred, -1e4, self.weights["A"]).astype(np.float32)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags of each window, and by how much each symbol's tag is preferred to tag 0."""
        scores, between = self._scores(self._states(x)), self._between()
        steps, n, _ = scores.shape
        best, back = scores[0] + self.weights["first"], []
        for t in range(1, steps):
            paths = best[:, :, None] + between
            back.append(paths.argmax(axis=1).astype(np.uint8))
            best = np.take_along_axis(paths, back[-1][:, None, :].astype(np.int64), axis=1)[:, 0] + scores[t]
        tags = np.empty((n, steps), np.uint8)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(steps - 2, -1, -1):
            tags[:, t] = back[t][np.arange(n), tags[:, t + 1]]
        by_window = scores.transpose(1, 0, 2)
        return tags, np.take_along_axis(by_window, tags[:, :, None].astype(np.int64), axis=2)[:, :, 0] - by_window[:, :, 0]

    def loss(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the windows' tags, and its gradient."""
        w, keep = self.weights, []
        states = self._states(x, keep)
        scores, between = self._scores(states).astype(np.float64), self._between().astype(np.float64)
        steps, n, _ = scores.shape
        forward, backward = np.empty_like(scores), np.zeros_like(scores)
        forward[0] = scores[0] + w["first"]
        for t in range(1, steps):
            forward[t] = _log_sum(forward[t - 1][:, :, None] + between, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            backward[t] = _log_sum(between + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
        total = _log_sum(forward[-1], 1)
        marginal = np.exp(forward + backward - total[:, None])
        given = tags.T.astype(np.int64)
        rows = np.arange(n)
        gold = w["first"][given[0]].astype(np.float64) + np.take_along_axis(scores, given[:, :, None], 2)[:, :, 0].sum(axis=0) + between[given[:-1], given[1:]].sum(axis=0)
        d = marginal
        d[np.arange(steps)[:, None], rows, given] -= 1
        grad = {"first": d[0].sum(axis=0), "b": d.sum(axis=(0, 1))}
        after = (scores[1:] + backward[1:] - total[:, None])[:, :, None, :]
        grad["A"] = np.exp(forward[:-1, :, :, None] + between + after).sum(axis=(0, 1))
        np.add.at(grad["A"], (given[:-1], given[1:]), -1)
        d = d.astype(np.float32)
        grad["O"] = np.stack((np.einsum("tnh,tnk->hk", states[:, 0], d), np.einsum("tnh,tnk->hk", states[::-1, 1], d)))
        into = np.stack((d @ w["O"][0].T, (d @ w["O"][1].T)[::-1]), axis=1)
        h = w["U"].shape[1]
        grad["U"], into_gates = np.zeros_like(w["U"]), np.empty((2, steps, n, 4 * h), np.float32)
        d_hidden, d_cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            z, before, squashed, hidden = keep[t]
            i, f, o, g = (z[..., q * h : (q + 1) * h] for q in range(4))
            dh = into[t] + d_hidden
            dc = d_cell + dh * o * (1 - squashed**2)
            dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)), axis=2)
            into_gates[0, t], into_gates[1, steps - 1 - t] = dz
            grad["U"] += np.matmul(hidden.transpose(0, 2, 1), dz)
            d_hidden, d_cell = np.matmul(dz, w["U"].transpose(0, 2, 1)), dc * f
        seen = np.eye(w["E"].shape[1], dtype=np.float32)[x.T.ravel()]
        grad["E"] = np.stack([seen.T @ d.reshape(-1, 4 * h) for d in into_gates])
        return float((total - gold).mean()), {name: g / n for name, g in grad.items()}

    def train(self, x: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; the mean loss of every epoch. The same windows in the same order give the same weights."""
        random, losses, step = np.random.default_rng(seed), [], 0
        first, second = ({k: np.zeros(v.shape) for k, v in self.weights.items()} for _ in range(2))
        for epoch in range(epochs):
            order, seen = random.permutation(len(x)), []
            for low in range(0, len(order), BATCH):
                chosen = order[low : low + BATCH]
                value, grad = self.loss(x[chosen], tags[chosen])
                seen.append(value)
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for k, g in grad.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - change).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses
