"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Windows are rows of character classes of one width, padded with class 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FORBIDDEN = -1e4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def lstm(x: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """States over time (steps, rows, units) for inputs (steps, rows, 4 * units), and what backward() needs."""
    steps, rows, four = x.shape
    units = four // 4
    h, c = np.zeros((rows, units), x.dtype), np.zeros((rows, units), x.dtype)
    out, kept = np.empty((steps, rows, units), x.dtype), []
    for t in range(steps):
        z = x[t] + h @ u
        gates = sigmoid(z[:, :3 * units])
        i, f, o = gates[:, :units], gates[:, units:2 * units], gates[:, 2 * units:]
        g = np.tanh(z[:, 3 * units:])
        kept.append((h, c, i, f, o, g))
        c = f * c + i * g
        h = o * np.tanh(c)
        out[t] = h
        kept[-1] += (c,)
    return out, kept


def lstm_backward(grad: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of ``u`` from those of the states."""
    steps, rows, units = grad.shape
    dx, du = np.empty((steps, rows, 4 * units), grad.dtype), np.zeros_like(u)
    dh_next, dc_next = np.zeros((rows, units), grad.dtype), np.zeros((rows, units), grad.dtype)
    for t in reversed(range(steps)):
        h, c, i, f, o, g, new_c = kept[t]
        dh, tanh_c = grad[t] + dh_next, np.tanh(new_c)
        dc = dc_next + dh * o * (1 - tanh_c ** 2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g ** 2)], 1)
        dx[t], dc_next = dz, dc * f
        dh_next = dz @ u.T
        du += h.T @ dz
    return dx, du


@dataclass
class Tagger:
    """Parameters by name; ``allowed`` masks transitions between tags."""

    weights: dict[str, np.ndarray]
    allowed: np.ndarray

    @classmethod
    def fresh(cls, classes: int, tags: int, allowed: np.ndarray, embedding: int, units: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        bias = np.zeros(4 * units, np.float32)
        bias[units:2 * units] = 1  # remember at first
        return cls({"embed": draw(classes, embedding) * np.sqrt(classes).astype(np.float32) * 0.3,
                    "w_fore": draw(embedding, 4 * units), "u_fore": draw(units, 4 * units), "b_fore": bias.copy(),
                    "w_back": draw(embedding, 4 * units), "u_back": draw(units, 4 * units), "b_back": bias.copy(),
                    "w_out": draw(2 * units, tags), "b_out": np.zeros(tags, np.float32),
                    "trans": np.zeros((tags, tags), np.float32)}, allowed)

    def transitions(self) -> np.ndarray:
        return self.weights["trans"] + np.where(self.allowed, 0, FORBIDDEN).astype(np.float32)

    def emissions(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores (steps, rows, tags) of windows (rows, steps)."""
        w, steps = self.weights, x.T
        fore, kept_fore = lstm((w["embed"] @ w["w_fore"] + w["b_fore"])[steps], w["u_fore"])
        back, kept_back = lstm((w["embed"] @ w["w_back"] + w["b_back"])[steps[::-1]], w["u_back"])
        states = np.concatenate([fore, back[::-1]], 2)
        return states @ w["w_out"] + w["b_out"], (states, kept_fore, kept_back)

    def decode(self, x: np.ndarray, rows_at_once: int = 512) -> np.ndarray:
        """The best tag of every character, window by window (Viterbi)."""
        trans, out = self.transitions(), np.empty(x.shape, np.int8)
        for at in range(0, len(x), rows_at_once):
            score, _ = self.emissions(x[at:at + rows_at_once])
            steps, rows, _ = score.shape
            best, back = score[0], []
            for t in range(1, steps):
                through = best[:, :, None] + trans
                back.append(through.argmax(1))
                best = through.max(1) + score[t]
            tag = best.argmax(1)
            out[at:at + rows, -1] = tag
            for t in range(steps - 2, -1, -1):
                tag = back[t][np.arange(rows), tag]
                out[at:at + rows, t] = tag
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags ``y`` (rows, steps), and its gradients."""
        w, trans, gold = self.weights, self.transitions(), y.T
        score, (states, kept_fore, kept_back) = self.emissions(x)
        steps, rows, tags = score.shape
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[0] = score[0]
        for t in range(1, steps):
            alpha[t] = score[t] + logsumexp(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = logsumexp(trans + (score[t + 1] + beta[t + 1])[:, None, :], 2)
        total = logsumexp(alpha[-1], 1)
        own = np.take_along_axis(score, gold[:, :, None], 2).sum((0, 2)) + trans[gold[:-1], gold[1:]].sum(0)
        d_score = np.exp(alpha + beta - total[None, :, None])
        np.put_along_axis(d_score, gold[:, :, None], np.take_along_axis(d_score, gold[:, :, None], 2) - 1, 2)
        both = np.exp(alpha[:-1, :, :, None] + trans + (score[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
        d_trans = both.sum((0, 1))
        np.add.at(d_trans, (gold[:-1].ravel(), gold[1:].ravel()), -1)
        d_score /= rows
        units = len(w["u_fore"])
        d_states = d_score @ w["w_out"].T
        dx_fore, du_fore = lstm_backward(d_states[:, :, :units], w["u_fore"], kept_fore)
        dx_back, du_back = lstm_backward(d_states[::-1, :, units:], w["u_back"], kept_back)
        grads = {"w_out": np.einsum("trs,trk->sk", states, d_score), "b_out": d_score.sum((0, 1)),
                 "trans": (d_trans / rows * self.allowed).astype(np.float32), "u_fore": du_fore, "u_back": du_back,
                 "embed": np.zeros_like(w["embed"])}
        for name, dx, steps_in in (("fore", dx_fore, x.T), ("back", dx_back, x.T[::-1])):
            by_class = np.zeros((len(w["embed"]), 4 * units), np.float32)
            np.add.at(by_class, steps_in.ravel(), dx.reshape(-1, 4 * units))
            grads[f"b_{name}"] = by_class.sum(0)
            grads[f"w_{name}"] = w["embed"].T @ by_class
            grads["embed"] += by_class @ w[f"w_{name}"].T
        return float((total - own).mean()), grads


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1, 5 / (norm + 1e-9))
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            mean, square = self.mean[k] / (1 - 0.9 ** self.step), self.square[k] / (1 - 0.99 ** self.step)
            self.weights[k] -= (self.rate * mean / (np.sqrt(square) + 1e-7)).astype(np.float32)
