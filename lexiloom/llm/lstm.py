"""A bidirectional LSTM with one output per step, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(gates: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, list]:
    """States (T, B, H) from input gates (T, B, 4H); what the way back needs."""
    steps, batch, size = gates.shape[0], gates.shape[1], recurrent.shape[0]
    h, c = np.zeros((batch, size), gates.dtype), np.zeros((batch, size), gates.dtype)
    states, kept = np.empty((steps, batch, size), gates.dtype), []
    for t in range(steps):
        z = gates[t] + h @ recurrent
        act = _sigmoid(z[:, : 3 * size])
        new = np.tanh(z[:, 3 * size :])
        before_c, before_h = c, h
        c = act[:, size : 2 * size] * c + act[:, :size] * new
        bent = np.tanh(c)
        h = act[:, 2 * size :] * bent
        states[t] = h
        kept.append((act, new, before_c, before_h, bent))
    return states, kept


def _back(slope: np.ndarray, kept: list, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the input gates and of the recurrent weights."""
    size = recurrent.shape[0]
    gates = np.empty((*slope.shape[:2], 4 * size), slope.dtype)
    weights = np.zeros_like(recurrent)
    dh, dc = np.zeros(slope.shape[1:], slope.dtype), np.zeros(slope.shape[1:], slope.dtype)
    for t in range(len(kept) - 1, -1, -1):
        act, new, before_c, before_h, bent = kept[t]
        i, f, o = act[:, :size], act[:, size : 2 * size], act[:, 2 * size :]
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - bent * bent)
        z = np.hstack([dc * new * i * (1 - i), dc * before_c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - new * new)])
        weights += before_h.T @ z
        gates[t], dh, dc = z, z @ recurrent.T, dc * f
    return gates, weights


def _reversal(lengths: np.ndarray, steps: int) -> np.ndarray:
    """(T, B) places that turn each sequence around and leave its padding behind it."""
    at = np.arange(steps)[:, None]
    return np.where(at < lengths[None, :], lengths[None, :] - 1 - at, at)


class BlockLabeller:
    """Probability of each block of a sequence, read from both ends."""

    def __init__(self, inputs: int, size: int, seed: int = 0):
        random = np.random.default_rng(seed)

        def scaled(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.size = size
        self.weights = {
            "in": scaled(inputs, 8 * size),
            "bias": np.zeros(8 * size, np.float32),
            "forward": scaled(size, 4 * size),
            "backward": scaled(size, 4 * size),
            "out": scaled(2 * size),
            "level": np.zeros(1, np.float32),
        }
        for half in (0, 4):  # remember at first
            self.weights["bias"][(half + 1) * size : (half + 2) * size] = 1

    def gates(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights["in"] + self.weights["bias"]

    def _states(self, gates: np.ndarray, lengths: np.ndarray):
        turn = _reversal(lengths, len(gates))
        column = np.arange(gates.shape[1])
        ahead, kept = _run(gates[:, :, : 4 * self.size], self.weights["forward"])
        turned, kept_turned = _run(gates[turn, column][:, :, 4 * self.size :], self.weights["backward"])
        return np.concatenate([ahead, turned[turn, column]], axis=2), kept, kept_turned, turn

    def probabilities(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Of sequences of input gates, as :meth:`gates` gives them."""
        lengths = np.array([len(s) for s in sequences])
        padded = np.zeros((max(lengths, default=0), len(sequences), 8 * self.size), np.float32)
        for b, s in enumerate(sequences):
            padded[: len(s), b] = s
        if not padded.size:
            return [np.zeros(0) for _ in sequences]
        states, *_ = self._states(padded, lengths)
        out = _sigmoid(states @ self.weights["out"] + self.weights["level"])
        return [out[:n, b] for b, n in enumerate(lengths)]

    def slopes(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and slopes for padded inputs (T, B, inputs) and labels (T, B)."""
        gates = self.gates(x)
        states, kept, kept_turned, turn = self._states(gates, lengths)
        out = _sigmoid(states @ self.weights["out"] + self.weights["level"])
        real = np.arange(len(x))[:, None] < lengths[None, :]
        n = max(int(real.sum()), 1)
        loss = -float(np.sum(np.where(real, np.log(np.where(y > 0.5, out, 1 - out) + 1e-9), 0))) / n
        error = (np.where(real, out - y, 0) / n).astype(np.float32)
        back = error[:, :, None] * self.weights["out"]
        column = np.arange(x.shape[1])
        ahead, d_forward = _back(back[:, :, : self.size], kept, self.weights["forward"])
        turned, d_backward = _back(back[turn, column][:, :, self.size :], kept_turned, self.weights["backward"])
        d_gates = np.concatenate([ahead, turned[turn, column]], axis=2)
        flat = d_gates.reshape(-1, d_gates.shape[2])
        return loss, {
            "in": x.reshape(-1, x.shape[2]).T @ flat,
            "bias": flat.sum(axis=0),
            "forward": d_forward,
            "backward": d_backward,
            "out": np.einsum("tb,tbh->h", error, states),
            "level": error.sum(keepdims=True).reshape(1),
        }

    def train(self, sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int, batch: int, rate: float, seed: int = 0) -> float:
        """Adam over (inputs, labels) sequences, in steps that shrink to a tenth; the
        last epoch's mean loss."""
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, mean = 0, 0.0
        steps = epochs * -(-len(sequences) // batch)
        for _ in range(epochs):
            losses = []
            order = random.permutation(len(sequences))
            for at in range(0, len(order), batch):
                chosen = [sequences[i] for i in order[at : at + batch]]
                lengths = np.array([len(x) for x, _ in chosen])
                x = np.zeros((lengths.max(), len(chosen), chosen[0][0].shape[1]), np.float32)
                y = np.zeros((lengths.max(), len(chosen)), np.float32)
                for b, (rows, labels) in enumerate(chosen):
                    x[: len(rows), b], y[: len(rows), b] = rows, labels
                loss, slopes = self.slopes(x, lengths, y)
                losses.append(loss)
                step += 1
                for k, slope in slopes.items():
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope * slope
                    fix = (1 - 0.9 * step / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[k] -= (rate * fix * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses)) if losses else 0.0
        return mean
