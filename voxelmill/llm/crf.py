"""A linear-chain conditional random field in numpy, in batches of padded sequences."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(batch, time, features) of feature numbers, -1 where there is none, and the lengths."""
    if len(seqs) == 1:
        return seqs[0][None], np.array([len(seqs[0])])
    out = np.full((len(seqs), max(map(len, seqs)), max(s.shape[1] for s in seqs)), -1, np.int32)
    for k, s in enumerate(seqs):
        out[k, : len(s), : s.shape[1]] = s
    return out, np.array([len(s) for s in seqs])


@dataclass
class Crf:
    """``weights``: features x tags; ``moves``: tag to tag; ``begin``: first tag."""

    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray

    def _emissions(self, x: np.ndarray) -> np.ndarray:
        """Feature by feature, so that no more than the result and one summand are held."""
        table, out = np.vstack([self.weights, np.zeros((1, self.weights.shape[1]))]), np.zeros((*x.shape[:2], self.weights.shape[1]))
        for j in range(x.shape[2]):
            out += table[x[:, :, j]]
        return out

    @classmethod
    def fit(cls, seqs: list[np.ndarray], tags: list[np.ndarray], features: int, n_tags: int, epochs: int = 80, rate: float = 0.5, decay: float = 1e-4) -> Crf:
        """Maximum likelihood by AdaGrad over the whole table, with expected counts by forward-backward."""
        m = cls(np.zeros((features, n_tags)), np.zeros((n_tags, n_tags)), np.zeros(n_tags))
        x, length = _padded(seqs)
        b, t, _ = x.shape
        y = np.zeros((b, t), np.int64)
        for k, s in enumerate(tags):
            y[k, : len(s)] = s
        live = np.arange(t)[None] < length[:, None]
        one = np.eye(n_tags)[y] * live[..., None]
        steps = live[:, 1:, None, None]
        pairs = (one[:, :-1, :, None] * one[:, 1:, None, :] * steps).sum((0, 1))
        sums = [np.full_like(p, 1e-6) for p in (m.weights, m.moves, m.begin)]
        flat = np.where(x < 0, features, x)[live]
        for _ in range(epochs):
            # forward and backward in probabilities, scaled at every step
            e = np.ones((b, t, n_tags))
            own = m._emissions(x[live][None])[0]
            e[live] = np.exp(own - own.max(1, keepdims=True))
            move = np.exp(m.moves)
            fore, back, scale = np.zeros((b, t, n_tags)), np.ones((b, t, n_tags)), np.ones((b, t, 1))
            for i in range(t):
                step = (fore[:, i - 1] @ move if i else np.exp(m.begin)) * e[:, i]
                scale[:, i] = step.sum(1, keepdims=True)
                fore[:, i] = np.where(live[:, i, None], step / scale[:, i], fore[:, i - 1] if i else 0)
            after = np.zeros((b, t, n_tags))
            for i in range(t - 1, 0, -1):
                after[:, i] = e[:, i] * back[:, i] / scale[:, i] * live[:, i, None]
                back[:, i - 1] = np.where(live[:, i, None], after[:, i] @ move.T, 1)
            edge = move * (fore[:, :-1].reshape(-1, n_tags).T @ after[:, 1:].reshape(-1, n_tags))
            diff = one - fore * back * live[..., None]
            grad = np.stack([np.bincount(flat.ravel(), np.repeat(diff[live][:, k], flat.shape[1]), features + 1) for k in range(n_tags)], 1)
            for p, g, s in zip((m.weights, m.moves, m.begin), (grad[:-1], pairs - edge, diff[:, 0].sum(0)), sums, strict=True):
                g = g / b - decay * p
                s += g * g
                p += rate * g / np.sqrt(s)
        return m

    def decode(self, seqs: list[np.ndarray], most: int = 200_000, piece: int = 4096) -> list[np.ndarray]:
        """The best tags of each sequence, by Viterbi over batches of like length and at most ``most`` cells.
        A longer sequence is a batch of its own: scores are carried from piece to piece, and what is held of
        a whole sequence is one byte for each token and tag."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(seqs)
        order = [k for k in sorted(range(len(seqs)), key=lambda k: len(seqs[k])) if len(seqs[k])]
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to - at + 1) * len(seqs[order[to]]) <= most:
                to += 1
            x, length = _padded([seqs[k] for k in order[at:to]])
            steps = x.shape[1]
            came, rows = np.zeros((len(x), steps, self.weights.shape[1]), np.int8), np.arange(len(x))
            for i in range(steps):
                if i % piece == 0:
                    e = self._emissions(x[:, i : i + piece])
                if i == 0:
                    best = self.begin + e[:, 0]
                    continue
                options = best[:, :, None] + self.moves
                came[:, i] = options.argmax(1)
                step = options.max(1) + e[:, i % piece]
                best = np.where((i < length)[:, None], step, best)
            tag = best.argmax(1)
            path = np.zeros((len(x), steps), np.int8)
            for i in range(steps - 1, -1, -1):
                path[:, i] = tag
                inside = (i > 0) & (i < length)
                tag = np.where(inside, came[rows, i, tag], tag)
            for r, k in enumerate(order[at:to]):
                out[k] = path[r, : length[r]]
            at = to
        return out
