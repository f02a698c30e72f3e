"""A gated recurrent network over token ids with a class-factored output, in numpy.

Ids below ``n_head`` are frequent words, one softmax within each class of ``width`` of them; ids
from n_head on are classes of rare words, whose own distribution is by counts, outside the network.
The input of a step is the row of a table for the token before, or its last row at the start of a
document, where the state is zero too.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 32
WIDTH = 32
STREAMS = 256
STEPS = 16
RATE = 0.02
UPDATES = 128  #: windows in each stream at least; few tokens make fewer streams
_OUTPUT_ROWS = 1 << 13
_TOGETHER = 1024  #: documents that advance together, those of like length


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place, by the exponential, which numpy computes faster."""
    x *= 2
    _sigmoid(x)
    x *= 2
    x -= 1
    return x


def _levelled(w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """(b less the highest logit that w and b can give, whether some exponential of each row then stays above zero).

    The entries of a state lie between -1 and 1, which bounds its logits without looking at it.
    """
    reach = np.abs(w).sum(axis=-2)
    top, low = (b + reach).max(axis=-1, keepdims=True), (b - reach).max(axis=-1, keepdims=True)
    return b - top, bool((top - low < 80).all())


def _exponentials(x: np.ndarray, wanted: np.ndarray, level: bool) -> tuple[np.ndarray, np.ndarray]:
    """Turns logits into exponentials in place; (logit at the wanted column, sum of the exponentials) of each row."""
    if not level:
        x -= x.max(axis=1, keepdims=True)
    found = x[np.arange(len(x)), wanted]
    np.exp(x, out=x)
    return found, x @ np.ones(x.shape[1], x.dtype)


class Network:
    """Parameters by name; ``flat`` and ``load`` turn them into one array and back."""

    def __init__(self, head_counts: np.ndarray, rare_mass: np.ndarray, hidden: int = HIDDEN, width: int = WIDTH, seed: int = 11):
        """Starts as the unigram distribution of the head's counts and the mass of rare classes."""
        self.n_head, self.n_rare, self.hidden, self.width = len(head_counts), len(rare_mass), hidden, width
        self.n_classes = -(-self.n_head // width)
        rng = np.random.default_rng(seed)
        inner = np.full((self.n_classes, width), -1e9, np.float32)
        inner.ravel()[: self.n_head] = np.log(head_counts + 0.5)
        mass = np.concatenate([np.exp(inner.astype(np.float64)).sum(axis=1), rare_mass])
        inputs = self.n_head + self.n_rare + 1
        self.p = {
            "x": rng.normal(0, 0.1, (inputs, 3 * hidden)),
            "u": rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden)),
            "bias": np.concatenate([np.ones(hidden), np.zeros(2 * hidden)]),
            "class_w": np.zeros((hidden, self.n_classes + self.n_rare)),
            "class_b": np.log(mass),
            "word_w": np.zeros((self.n_classes, hidden, width)),
            "word_b": inner,
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = values[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def _step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """(state, update gate, reset gate, inner, new) after input rows x and states h."""
        n, u = self.hidden, self.p["u"]
        z, r, inner = h @ u[:, :n], h @ u[:, n : 2 * n], h @ u[:, 2 * n :]
        z += x[:, :n]
        r += x[:, n : 2 * n]
        _sigmoid(z)
        _sigmoid(r)
        new = r * inner
        new += x[:, 2 * n :]
        _tanh(new)
        state = h - new
        state *= z
        state += new
        return state, z, r, inner, new

    def _by_class(self, which: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of head words in the order of their classes, and where each class begins."""
        head = np.flatnonzero(~rare)
        head = head[np.argsort(which[head], kind="stable")]
        return head, np.searchsorted(which[head], np.arange(self.n_classes + 1))

    def _log_p(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each id, rare classes as a whole, after state h."""
        p, rare = self.p, ids >= self.n_head
        which = np.where(rare, ids - self.n_head + self.n_classes, ids // self.width)
        bias, level = _levelled(p["class_w"], p["class_b"])
        logits = h @ p["class_w"]
        logits += bias
        out, total = _exponentials(logits, which, level)
        out -= np.log(total)
        head, edges = self._by_class(which, rare)
        logits, level = self._word_logits(h[head], edges)
        inner, total = _exponentials(logits, ids[head] % self.width, level)
        out[head] += inner - np.log(total)
        return out

    def _word_logits(self, states: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, bool]:
        """Logits of the words of each state's class, and whether they need no further levelling."""
        bias, level = _levelled(self.p["word_w"], self.p["word_b"])
        logits = np.empty((len(states), self.width), states.dtype)
        for c in np.flatnonzero(np.diff(edges)).tolist():
            own = logits[edges[c] : edges[c + 1]]
            np.matmul(states[edges[c] : edges[c + 1]], self.p["word_w"][c], out=own)
            own += bias[c]
        return logits, level

    def log_likelihood(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log-likelihood of each whole document ids[bounds[i]:bounds[i + 1]].

        Documents of like length advance together, a token at a time; the state of each is carried
        through the windows of steps after which the output layer is applied to what has gathered.
        """
        lengths = np.diff(bounds)
        ordered = np.argsort(-lengths, kind="stable")
        table = self.p["x"] + self.p["bias"]
        total = np.zeros(len(lengths))
        for lo in range(0, len(ordered), _TOGETHER):
            order = ordered[lo : lo + _TOGETHER]
            active = np.searchsorted(-lengths[order], -np.arange(int(lengths[order[0]])), "left")
            first = bounds[:-1][order]
            h = np.zeros((len(order), self.hidden), np.float32)
            states, wanted, owners, held = [], [], [], 0
            for t, k in enumerate(active.tolist()):
                x = np.broadcast_to(table[-1], (k, table.shape[1])) if t == 0 else table[ids[first[:k] + t - 1]]
                h = self._step(x, h[:k])[0]
                states.append(h)
                wanted.append(ids[first[:k] + t])
                owners.append(np.arange(k))
                held += k
                if held >= _OUTPUT_ROWS or t == len(active) - 1:
                    found = self._log_p(np.concatenate(states), np.concatenate(wanted))
                    total[lo : lo + len(order)] += np.bincount(np.concatenate(owners), found, len(order))
                    states, wanted, owners, held = [], [], [], 0
        out = np.empty_like(total)
        out[ordered] = total
        return out

    def train(self, docs: list[np.ndarray], rate: float = RATE, streams: int = STREAMS, steps: int = STEPS) -> int:
        """One pass of truncated backpropagation over the documents; returns the tokens used.

        The documents follow one another in parallel streams. The state is carried from window to
        window and gradients stop at a window's first step. The tokens that the streams leave over
        follow the last stream, in windows of their own that count by their tokens.
        """
        if not docs:
            return 0
        ids = np.concatenate(docs)
        before = np.concatenate([np.r_[self.n_head + self.n_rare, d[:-1]] for d in docs])
        streams = max(1, min(streams, len(ids) // (steps * UPDATES)))
        n = len(ids) // streams
        rest = slice(n * streams, None)
        left, left_before = ids[rest, None], before[rest, None]
        ids, before = ids[: n * streams].reshape(streams, n).T, before[: n * streams].reshape(streams, n).T
        windows = [(before[lo : lo + steps], ids[lo : lo + steps], 1.0) for lo in range(0, n, steps)]
        windows += [(left_before[lo : lo + steps], left[lo : lo + steps], 1 / streams) for lo in range(0, len(left), steps)]
        h = np.zeros((streams, self.hidden), np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i, (prior, own, weight) in enumerate(windows, 1):
            h, gradients = self._window(prior, own, h[-own.shape[1] :])
            for k, g in gradients.items():
                g = np.clip(g, -1, 1) * np.float32(weight)
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                self.p[k] -= rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-6)
        return n * streams + len(left)

    def _window(self, before: np.ndarray, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        n, p = self.hidden, self.p
        x = np.take(p["x"] + p["bias"], before, axis=0)
        carried = (before != self.n_head + self.n_rare).astype(x.dtype)[:, :, None]  # 0 at the start of a document
        prior, states, z, r, inner, new = (np.empty((*ids.shape, n), x.dtype) for _ in range(6))
        for t in range(len(ids)):
            prior[t] = h * carried[t]
            h, z[t], r[t], inner[t], new[t] = self._step(x[t], prior[t])
            states[t] = h
        d_h, g = self._output_gradients(states.reshape(-1, n), ids.ravel())
        d_h = d_h.reshape(states.shape)
        by_new, by_z, by_r = (1 - z) * (1 - new * new), (prior - new) * z * (1 - z), inner * r * (1 - r)
        d_a, d_new = np.empty((*ids.shape, 3 * n), x.dtype), np.empty_like(new)
        carry, back = np.zeros_like(h), np.ascontiguousarray(p["u"].T)
        for t in range(len(ids) - 1, -1, -1):
            d, own = d_h[t], d_a[t]
            d += carry
            np.multiply(d, by_new[t], out=d_new[t])
            np.multiply(d, by_z[t], out=own[:, :n])
            np.multiply(d_new[t], by_r[t], out=own[:, n : 2 * n])
            np.multiply(d_new[t], r[t], out=own[:, 2 * n :])
            np.matmul(own, back, out=carry)
            d *= z[t]
            carry += d
            carry *= carried[t]
        g["u"] = prior.reshape(-1, n).T @ d_a.reshape(-1, 3 * n)
        d_a[:, :, 2 * n :] = d_new
        flat = d_a.reshape(-1, 3 * n)
        g["bias"] = flat.sum(axis=0)
        g["x"] = np.zeros_like(p["x"])
        order = np.argsort(before.ravel(), kind="stable")
        used = before.ravel()[order]
        heads = np.flatnonzero(np.r_[True, used[1:] != used[:-1]])
        g["x"][used[heads]] = np.add.reduceat(flat[order], heads, axis=0)
        return h, g

    def _output_gradients(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Gradients of the mean negative log-likelihood of a window's tokens."""
        p, scale = self.p, np.float32(1 / ids.size * STEPS)
        rare = ids >= self.n_head
        which = np.where(rare, ids - self.n_head + self.n_classes, ids // self.width)
        bias, level = _levelled(p["class_w"], p["class_b"])
        d = h @ p["class_w"]
        d += bias
        _, total = _exponentials(d, which, level)
        d *= (scale / total)[:, None]
        d[np.arange(len(ids)), which] -= scale
        g = {"class_w": h.T @ d, "class_b": d.sum(axis=0), "word_w": np.zeros_like(p["word_w"]), "word_b": np.zeros_like(p["word_b"])}
        d_h = d @ p["class_w"].T
        head, edges = self._by_class(which, rare)
        states, words = h[head], ids[head] % self.width
        e, level = self._word_logits(states, edges)
        _, total = _exponentials(e, words, level)
        e *= (scale / total)[:, None]
        e[np.arange(len(e)), words] -= scale
        d_states = np.empty_like(states)
        for c in np.flatnonzero(np.diff(edges)).tolist():
            at = slice(edges[c], edges[c + 1])
            np.matmul(states[at].T, e[at], out=g["word_w"][c])
            g["word_b"][c] = e[at].sum(axis=0)
            np.matmul(e[at], p["word_w"][c].T, out=d_states[at])
        d_h[head] += d_states
        return d_h, g
