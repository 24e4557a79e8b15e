"""A character-level bidirectional LSTM with a CRF on top, trained and run in numpy.

Sequences have one length; all steps are matrix products over a batch of sequences.
"""

import numpy as np

HIDDEN = 16


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


class Tagger:
    """Parameters and passes. `letters` is the alphabet's size, `tags` the number of tags."""

    def __init__(self, letters, tags, hidden=HIDDEN, seed=0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.hidden, self.tags = hidden, tags
        self.p = {}
        for d in ("f", "b"):  # forward and backward in the text
            self.p["W" + d] = (0.3 * rng.normal(0, 1, (letters, 4 * hidden))).astype(np.float32)
            self.p["U" + d] = draw(hidden, 4 * hidden)
            self.p["c" + d] = np.zeros(4 * hidden, np.float32)
            self.p["c" + d][hidden : 2 * hidden] = 1.0  # remember at first
        self.p["O"] = draw(2 * hidden, tags)
        self.p["o"] = np.zeros(tags, np.float32)
        self.p["A"] = np.zeros((tags, tags), np.float32)
        self.p["s"] = np.zeros(tags, np.float32)

    def _lstm(self, x, d):
        """Hidden states (steps, batch, hidden) and what the backward pass needs."""
        n, steps, h = x.shape[0], x.shape[1], self.hidden
        into = self.p["W" + d][x.T] + self.p["c" + d]
        hs, gates, cells = np.zeros((steps + 1, n, h), np.float32), [], [np.zeros((n, h), np.float32)]
        for t in range(steps):
            g = into[t] + hs[t] @ self.p["U" + d]
            ifo, new = _sigmoid(g[:, : 3 * h]), np.tanh(g[:, 3 * h :])
            cell = ifo[:, h : 2 * h] * cells[-1] + ifo[:, :h] * new
            hs[t + 1] = ifo[:, 2 * h :] * np.tanh(cell)
            gates.append((ifo, new))
            cells.append(cell)
        return hs, gates, cells

    def _lstm_back(self, x, d, state, dh, grads):
        hs, gates, cells = state
        h, steps = self.hidden, x.shape[1]
        into = np.zeros((steps, x.shape[0], 4 * h), np.float32)
        carry_h = carry_c = np.zeros((x.shape[0], h), np.float32)
        for t in reversed(range(steps)):
            ifo, new = gates[t]
            i, f, o = ifo[:, :h], ifo[:, h : 2 * h], ifo[:, 2 * h :]
            tanh_c = np.tanh(cells[t + 1])
            g_h = dh[t] + carry_h
            g_c = g_h * o * (1 - tanh_c**2) + carry_c
            g = np.concatenate(
                [g_c * new * i * (1 - i), g_c * cells[t] * f * (1 - f), g_h * tanh_c * o * (1 - o), g_c * i * (1 - new**2)], 1
            )
            into[t] = g
            carry_h, carry_c = g @ self.p["U" + d].T, g_c * f
        grads["U" + d] = np.einsum("tbh,tbg->hg", hs[:-1], into, optimize=True)
        grads["c" + d] = into.sum((0, 1))
        letters = (x.T.reshape(-1, 1) == np.arange(len(self.p["W" + d]))).astype(np.float32)
        grads["W" + d] = letters.T @ into.reshape(-1, 4 * h)

    def _states(self, x):
        return self._lstm(x, "f"), self._lstm(x[:, ::-1], "b")

    def emissions(self, x):
        """Scores of each tag, (steps, batch, tags)."""
        forward, backward = self._states(x)
        both = np.concatenate([forward[0][1:], backward[0][1:][::-1]], 2)
        return both @ self.p["O"] + self.p["o"]

    def loss_and_gradients(self, x, y):
        """Mean negative log-likelihood of tag sequences y, and its gradients."""
        n, steps = x.shape
        forward, backward = self._states(x)
        both = np.concatenate([forward[0][1:], backward[0][1:][::-1]], 2)
        e, a, s = both @ self.p["O"] + self.p["o"], self.p["A"], self.p["s"]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + s
        for t in range(1, steps):
            alpha[t] = e[t] + _logsumexp(alpha[t - 1][:, :, None] + a, 1)
        for t in reversed(range(steps - 1)):
            beta[t] = _logsumexp(a + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsumexp(alpha[-1], 1)
        share = np.exp(alpha + beta - z[:, None])
        rows, path = np.arange(n), y.T
        gold = s[path[0]] + e[np.arange(steps)[:, None], rows, path].sum(0) + a[path[:-1], path[1:]].sum(0)
        grads = {"s": share[0].sum(0) / n, "A": np.zeros_like(a)}
        np.add.at(grads["s"], path[0], -1.0 / n)
        for t in range(steps - 1):
            pair = alpha[t][:, :, None] + a + (e[t + 1] + beta[t + 1])[:, None, :] - z[:, None, None]
            grads["A"] += np.exp(pair).sum(0) / n
        np.add.at(grads["A"], (path[:-1], path[1:]), -1.0 / n)
        g = share
        g[np.arange(steps)[:, None], rows, path] -= 1
        g = (g / n).astype(np.float32)
        grads["o"], grads["O"] = g.sum((0, 1)), np.einsum("tbh,tbk->hk", both, g, optimize=True)
        dh = g @ self.p["O"].T
        self._lstm_back(x, "f", forward, dh[:, :, : self.hidden], grads)
        self._lstm_back(x[:, ::-1], "b", backward, dh[::-1, :, self.hidden :], grads)
        return float((z - gold).mean()), grads

    def fit(self, x, y, epochs, batch=64, rate=0.02, seed=0):
        """Adam with a decaying rate and clipped gradients."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        total, step = epochs * -(-len(x) // batch), 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                part = order[at : at + batch]
                _, grads = self.loss_and_gradients(x[part], y[part])
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                step += 1
                now = rate * (1 - 0.9 * step / total) * min(1.0, 5.0 / (norm + 1e-9))
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g**2
                    self.p[k] = (
                        self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
                    ).astype(np.float32)
        return self

    def decode(self, x):
        """Best tag sequences (batch, steps) by Viterbi."""
        e, a = self.emissions(x), self.p["A"]
        score, back = e[0] + self.p["s"], []
        for t in range(1, len(e)):
            step = score[:, :, None] + a
            back.append(step.argmax(1))
            score = step.max(1) + e[t]
        out = np.empty(x.shape, np.int64)
        out[:, -1] = score.argmax(1)
        rows = np.arange(len(x))
        for t in reversed(range(len(back))):
            out[:, t] = back[t][rows, out[:, t + 1]]
        return out
