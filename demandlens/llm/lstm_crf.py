"""A character-level bidirectional LSTM with CRF transitions in numpy.

Sequences have one length; arrays are (time, batch, features)."""

from __future__ import annotations

import ctypes
from functools import lru_cache
from pathlib import Path

import numpy as np

FORBIDDEN = -1e4


@lru_cache(1)
def one_thread() -> bool:
    """Matrix products of this process on one thread: those here are small, and
    threads that wait for each other's shares of them take more time than they
    save. True where numpy brings a library that can be told so."""
    for path in sorted((Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*")):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return True
    return False


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _lstm(x, wx, wh, b, reverse):
    """Hidden states of one direction and what its gradient needs."""
    steps, n, hidden = len(x), x.shape[1], wh.shape[0]
    z = x @ wx + b
    h, c = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    states = np.empty((steps, n, hidden), x.dtype)
    kept = [None] * steps
    for t in reversed(range(steps)) if reverse else range(steps):
        gates = z[t] + h @ wh
        ifo = _sigmoid(gates[:, : 3 * hidden])
        i, f, o = ifo[:, :hidden], ifo[:, hidden : 2 * hidden], ifo[:, 2 * hidden :]
        g = np.tanh(gates[:, 3 * hidden :])
        before = (h, c)
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[t] = h
        kept[t] = (before, i, f, o, g, tc)
    return states, kept


def _lstm_back(x, wx, wh, kept, grad, reverse):
    steps, n, hidden = len(x), x.shape[1], wh.shape[0]
    dz = np.empty((steps, n, 4 * hidden), x.dtype)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    for t in range(steps) if reverse else reversed(range(steps)):
        (h0, c0), i, f, o, g, tc = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - tc * tc)
        own = np.concatenate(
            [dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)],
            axis=1,
        )
        dz[t] = own
        dwh += h0.T @ own
        dh, dc = own @ wh.T, dc * f
    flat = dz.reshape(-1, 4 * hidden)
    return dz @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(0)


class BiLstmCrf:
    """``allowed`` (tags x tags) and ``start`` (tags) say which transitions
    and first tags exist; the others have no probability."""

    def __init__(self, symbols: int, allowed: np.ndarray, start: np.ndarray, embed=12, hidden=16, seed=7):
        rng = np.random.default_rng(seed)
        tags = len(start)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"e": draw(symbols, embed) * 3, "w": draw(2 * hidden, tags), "b": np.zeros(tags, np.float32)}
        for d in ("f", "r"):
            self.p |= {d + "x": draw(embed, 4 * hidden), d + "h": draw(hidden, 4 * hidden)}
            self.p[d + "b"] = np.zeros(4 * hidden, np.float32)
            self.p[d + "b"][hidden : 2 * hidden] = 1
        self.p["t"] = np.zeros((tags, tags), np.float32)
        self.mask = np.where(allowed, 0, FORBIDDEN).astype(np.float32)
        self.start = np.where(start, 0, FORBIDDEN).astype(np.float32)

    def after(self, symbol: int, steps: int) -> list:
        """State and cell of the direction from last to first when it has read
        the symbol 0, 1, .. ``steps`` times."""
        p = self.p
        x = p["e"][np.full((steps + 1, 1), symbol)]
        return [k[0] for k in reversed(_lstm(x, p["rx"], p["rh"], p["rb"], True)[1])]

    def emissions(self, ids: np.ndarray, after=None) -> np.ndarray:
        """(time, batch, tags) for ids (batch, time). Equals ``_run`` without
        what gradients need. What stands behind all sequences can be given as
        the state and cell that it leaves to the direction from last to first.

        Features come first, so that rows are contiguous, and both directions
        share the calls. With sigmoid(x) = 1 / (1 + exp(-x)) and tanh(x) =
        2 sigmoid(2 x) - 1 all gates are one exponential: weights take the signs
        and doublings, states are kept halved, cells times -2 (the input gate is
        -4 times its value). The product that gives a step's gates also gives
        the tags of the states before it."""
        one_thread()
        p, n, steps = self.p, *ids.shape
        hidden, embed, kind = p["fh"].shape[0], p["e"].shape[1], p["e"].dtype
        one, half = np.array(1, kind), np.array(0.5, kind)
        scale, over = np.full(4 * hidden, -1, kind), np.ones((4 * hidden, 1), kind)
        scale[3 * hidden :], over[:hidden] = -2, -4
        letters, order = np.ascontiguousarray(p["e"].T), np.ascontiguousarray(ids.T, np.intp)
        weights, tags = [], np.zeros((2, hidden + embed + 1, len(self.start)), kind)
        tags[:, :hidden], tags[0, -1] = 2 * p["w"].reshape(2, hidden, -1), p["b"]
        for d, to_tags in zip("fr", tags):
            to_gates = np.concatenate([2 * p[d + "h"], p[d + "x"], p[d + "b"][None]]) * scale
            weights.append(np.ascontiguousarray(np.concatenate([to_gates, to_tags], axis=1).T))
        put = np.ones((2, hidden + embed + 1, n), kind)  # halved state, letter, bias
        state, letter, c = put[:, :hidden], put[:, hidden:-1], np.zeros((2, hidden, n), kind)
        state[:] = 0
        if after is not None:
            state[1], c[1] = after[0].T / 2, after[1].T * -2
        got = np.empty((2, 4 * hidden + len(self.start), n), kind)
        gates, found = got[:, : 4 * hidden], got[:, 4 * hidden :]
        i, f, o, g = (gates[:, k * hidden : (k + 1) * hidden] for k in range(4))
        out = np.zeros((len(self.start), steps, n), kind)
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is the 0 that is meant
            for t in range(steps + 1):
                for k in range(2):
                    if t < steps:
                        np.take(letters, order[steps - 1 - t if k else t], axis=1, out=letter[k], mode="clip")
                    np.dot(weights[k], put[k], out=got[k])
                    if t:
                        out[:, steps - t if k else t - 1] += found[k]
                if t == steps:
                    break
                np.exp(gates, out=gates)
                gates += one
                np.divide(over, gates, out=gates)
                g -= half
                g *= i
                c *= f
                c += g
                np.exp(c, out=g)
                g += one
                np.divide(one, g, out=g)
                g -= half
                np.multiply(o, g, out=state)
        return out.transpose(1, 2, 0)

    def _run(self, ids):
        p = self.p
        x = p["e"][ids.T]
        f, kf = _lstm(x, p["fx"], p["fh"], p["fb"], False)
        r, kr = _lstm(x, p["rx"], p["rh"], p["rb"], True)
        h = np.concatenate([f, r], axis=2)
        return h @ p["w"] + p["b"], (x, h, kf, kr)

    def _chain(self, emit):
        """Log forward and backward sums and the log partition."""
        trans, steps = self.p["t"] + self.mask, len(emit)
        a, b = np.empty_like(emit), np.zeros_like(emit)
        a[0] = emit[0] + self.start
        for t in range(1, steps):
            a[t] = emit[t] + _logsumexp(a[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            b[t] = _logsumexp(trans[None] + (emit[t + 1] + b[t + 1])[:, None, :], 2)
        return a, b, _logsumexp(a[-1], 1), trans

    def marginals(self, emit: np.ndarray) -> np.ndarray:
        a, b, z, _ = self._chain(emit)
        return np.exp(a + b - z[:, None])

    def _together(self, emits: list[np.ndarray], together: int):
        """(indices, sizes, emissions (time, sequences, tags) filled up with
        zeros) of some non-empty sequences of like length at a time."""
        order = sorted((k for k in range(len(emits)) if len(emits[k])), key=lambda k: len(emits[k]))
        for first in range(0, len(order), together):
            group = order[first : first + together]
            sizes = np.array([len(emits[k]) for k in group])
            emit = np.zeros((sizes[-1], len(group), len(self.start)), emits[group[0]].dtype)
            for row, k in enumerate(group):
                emit[: len(emits[k]), row] = emits[k]
            yield group, sizes, emit

    def best_paths(self, emits: list[np.ndarray], together: int = 64) -> list[np.ndarray]:
        """Best tags of sequences (time, tags) of any lengths, as ``viterbi``
        gives them."""
        trans = np.ascontiguousarray((self.p["t"] + self.mask).T)  # to, from
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(emits)
        for group, sizes, emit in self._together(emits, together):
            rows, columns = np.arange(len(group))[:, None], np.arange(len(trans))
            score = emit[0] + self.start
            back = np.zeros(emit.shape, np.int64)
            last = score.argmax(1)
            for t in range(1, len(emit)):
                total = score[:, None, :] + trans
                back[t] = total.argmax(2)
                score = total[rows, columns, back[t]] + emit[t]
                last = np.where(t < sizes, score.argmax(1), last)
            tags = np.zeros((len(emit), len(group)), np.int64)
            tag = last
            for t in range(len(emit) - 1, -1, -1):
                tags[t] = tag
                tag = np.where(t < sizes, back[t][rows[:, 0], tag], tag)
            for row, k in enumerate(group):
                out[k] = tags[: sizes[row], row]
        return out

    def all_marginals(self, emits: list[np.ndarray], together: int = 64) -> list[np.ndarray]:
        """Tag probabilities (time, tags) of sequences of any lengths, as
        ``marginals`` gives them; sums are scaled anew at every step."""
        step = np.exp((self.p["t"] + self.mask).astype(np.float64))
        out: list[np.ndarray] = [np.empty((0, len(step)))] * len(emits)
        for group, sizes, emit in self._together(emits, together):
            likely = emit.astype(np.float64)
            likely = np.exp(likely - likely.max(2, keepdims=True))
            before, after = np.empty_like(likely), np.ones_like(likely)
            before[0] = likely[0] * np.exp(self.start.astype(np.float64))
            before[0] /= before[0].sum(1, keepdims=True)
            for t in range(1, len(emit)):
                now = (before[t - 1] @ step) * likely[t]
                before[t] = now / now.sum(1, keepdims=True)
            for t in range(len(emit) - 2, -1, -1):
                now = (likely[t + 1] * after[t + 1]) @ step.T
                now /= now.max(1, keepdims=True)
                after[t] = np.where((t < sizes - 1)[:, None], now, 1.0)
            both = before * after
            both /= both.sum(2, keepdims=True)
            for row, k in enumerate(group):
                out[k] = both[: sizes[row], row]
        return out

    def viterbi(self, emit: np.ndarray) -> np.ndarray:
        """Best tags of one sequence, emit (time, tags)."""
        trans = self.p["t"] + self.mask
        score = emit[0] + self.start
        back = np.zeros(emit.shape, np.int64)
        for t in range(1, len(emit)):
            total = score[:, None] + trans
            back[t] = total.argmax(0)
            score = total.max(0) + emit[t]
        tags = [int(score.argmax())]
        for t in range(len(emit) - 1, 0, -1):
            tags.append(int(back[t][tags[-1]]))
        return np.array(tags[::-1])

    def loss_and_gradient(self, ids, tags):
        p, n = self.p, len(ids)
        emit, (x, h, kf, kr) = self._run(ids)
        a, b, z, trans = self._chain(emit)
        steps, y = len(emit), tags.T
        rows = np.arange(n)
        grad = np.exp(a + b - z[:, None])
        gold = self.start[y[0]].sum() + emit[np.arange(steps)[:, None], rows, y].sum()
        gold += trans[y[:-1], y[1:]].sum()
        dt = np.zeros_like(p["t"])
        for t in range(steps - 1):
            dt += np.exp(
                a[t][:, :, None] + trans + (emit[t + 1] + b[t + 1])[:, None, :] - z[:, None, None]
            ).sum(0)
        np.add.at(dt, (y[:-1].ravel(), y[1:].ravel()), -1)
        grad[np.arange(steps)[:, None], rows, y] -= 1
        g = {"t": dt, "b": grad.sum((0, 1))}
        g["w"] = h.reshape(-1, h.shape[2]).T @ grad.reshape(-1, grad.shape[2])
        dh = grad @ p["w"].T
        half = p["fh"].shape[0]
        dx = 0
        for d, kept, part, rev in (("f", kf, dh[..., :half], False), ("r", kr, dh[..., half:], True)):
            own, g[d + "x"], g[d + "h"], g[d + "b"] = _lstm_back(x, p[d + "x"], p[d + "h"], kept, part, rev)
            dx = dx + own
        g["e"] = np.zeros_like(p["e"])
        np.add.at(g["e"], ids.T, dx)
        return float(z.sum() - gold) / n, {k: v / n for k, v in g.items()}

    def fit(self, ids, tags, steps=300, batch=128, rate=0.02, seed=11) -> float:
        """Adam; returns the mean loss of the last steps."""
        one_thread()
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(ids), batch)
            loss, g = self.loss_and_gradient(ids[pick], tags[pick])
            losses.append(loss)
            now = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k in self.p:
                x = g[k] * min(1.0, 5 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                fixed = (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                self.p[k] = (self.p[k] - now * fixed).astype(np.float32)
        return float(np.mean(losses[-20:]))
