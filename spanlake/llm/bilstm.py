"""A character-level bidirectional LSTM with CRF transitions in numpy: training and decoding of windows."""

from __future__ import annotations

import numpy as np

#: Characters with a row of their own, one for all others, and one for padding.
CHARS = 130
_OTHER, PAD = 128, 129


def codes(text: str) -> np.ndarray:
    """Each code point as a row number of the input tables."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), _OTHER).astype(np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class BiLstmCrf:
    """Tags are 0 (outside) and, for kind k, 2k + 1 (first character) and 2k + 2 (further ones)."""

    def __init__(self, n_kinds: int, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tags, self.hidden = 2 * n_kinds + 1, hidden
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {}
        for way in ("f", "b"):
            self.weights |= {f"in_{way}": draw(CHARS, 4 * hidden, scale=0.3), f"rec_{way}": draw(hidden, 4 * hidden, scale=hidden**-0.5)}
            self.weights[f"in_{way}"][:, hidden : 2 * hidden] += 1  # to remember at first
        self.weights |= {"out": draw(2 * hidden, self.tags, scale=0.3), "bias": np.zeros(self.tags, np.float32), "move": np.zeros((self.tags, self.tags), np.float32)}
        self.banned = np.zeros((self.tags, self.tags), np.float32)
        for to in range(2, self.tags, 2):
            self.banned[[i for i in range(self.tags) if i not in (to, to - 1)], to] = -1e4
        self.start = np.zeros(self.tags, np.float32)
        self.start[2::2] = -1e4

    def _run(self, x: np.ndarray, way: str, keep: bool):
        """Hidden states over the columns of x (rows: windows), right to left for way b."""
        n, size, h = *x.shape, self.hidden
        table, rec = self.weights[f"in_{way}"], self.weights[f"rec_{way}"]
        out, state, cell, memory = np.empty((size, n, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        for t in range(size) if way == "f" else range(size - 1, -1, -1):
            z = table[x[:, t]] + state @ rec
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            before = cell
            cell = gates[:, h : 2 * h] * before + gates[:, :h] * new
            squashed = np.tanh(cell)
            if keep:
                memory.append((t, state, before, gates, new, squashed))
            state = gates[:, 2 * h :] * squashed
            out[t] = state
        return out, memory

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Emission scores: position, window, tag."""
        both = np.concatenate((self._run(x, "f", False)[0], self._run(x, "b", False)[0]), axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window under emissions and transitions (Viterbi)."""
        scores = self.scores(x)
        move = self.weights["move"] + self.banned
        best, back = scores[0] + self.start, np.empty(scores.shape, np.int8)
        for t in range(1, len(scores)):
            all_ = best[:, :, None] + move
            back[t] = all_.argmax(axis=1)
            best = all_.max(axis=1) + scores[t]
        out = np.empty(x.shape, np.int8)
        out[:, -1] = best.argmax(axis=1)
        for t in range(len(scores) - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(len(x)), out[:, t]]
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean negative log likelihood of tags y, and its gradient, through the CRF and back through time."""
        (n, size), h, w = x.shape, self.hidden, self.weights
        states = {way: self._run(x, way, True) for way in ("f", "b")}
        both = np.concatenate((states["f"][0], states["b"][0]), axis=2)
        scores, move = both @ w["out"] + w["bias"], w["move"] + self.banned
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + self.start
        for t in range(1, size):
            ahead[t] = _logsumexp(ahead[t - 1][:, :, None] + move, 1) + scores[t]
        for t in range(size - 2, -1, -1):
            behind[t] = _logsumexp(move + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _logsumexp(ahead[-1], 1)
        rows = np.arange(n)
        gold = self.start[y[:, 0]] + sum(scores[t][rows, y[:, t]] for t in range(size)) + sum(move[y[:, t - 1], y[:, t]] for t in range(1, size))
        d_scores = np.exp(ahead + behind - total[:, None])
        d_move = np.zeros_like(move)
        for t in range(1, size):
            d_move += np.exp(ahead[t - 1][:, :, None] + move + (scores[t] + behind[t])[:, None, :] - total[:, None, None]).sum(axis=0)
            np.add.at(d_move, (y[:, t - 1], y[:, t]), -1)
        for t in range(size):
            d_scores[t][rows, y[:, t]] -= 1
        d_scores /= n
        grads = {"move": d_move / n, "bias": d_scores.sum(axis=(0, 1)), "out": np.einsum("tnh,tnk->hk", both, d_scores)}
        d_both = d_scores @ w["out"].T
        for part, way in ((slice(0, h), "f"), (slice(h, None), "b")):
            d_table, d_rec = np.zeros_like(w[f"in_{way}"]), np.zeros_like(w[f"rec_{way}"])
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, state, before, gates, new, squashed in reversed(states[way][1]):
                d_h = d_both[t][:, part] + d_state
                i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
                d_c = d_cell + d_h * o * (1 - squashed**2)
                d_z = np.concatenate((d_c * new * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - new**2)), axis=1)
                np.add.at(d_table, x[:, t], d_z)
                d_rec += state.T @ d_z
                d_state, d_cell = d_z @ w[f"rec_{way}"].T, d_c * f
            grads |= {f"in_{way}": d_table, f"rec_{way}": d_rec}
        return float((total - gold).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, passes: int, batch: int = 64, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; returns the loss of each."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        first, second = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        steps = passes * (-(-len(x) // batch))
        for _ in range(passes):
            order = rng.permutation(len(x))
            for a in range(0, len(order), batch):
                loss, grads = self.gradient(x[order[a : a + batch]], y[order[a : a + batch]])
                losses.append(loss)
                step += 1
                pace = rate * (1 - 0.9 * step / steps)
                for k, g in grads.items():
                    g = np.clip(g, -5, 5)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.weights[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return losses
