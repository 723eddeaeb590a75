"""A gated recurrent network over token types with a class-factored softmax, in numpy: windows, truncated backpropagation.

Types are the vocabulary's own words, most frequent first, then OPEN classes of all other words. Own words are in classes of
about equal square-root frequency, so that the most frequent are in small ones. A token's probability is that of its class
given the state, times, for an own word, its probability within the class given the state; an open class counts as one type.
Texts are dealt to slots that advance together a window at a time; states are carried over from window to window and start
anew at a text's first token.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Steps of a window, through which errors are sent back.
WINDOW = 16
#: Tokens of a piece of text in training; a piece's state starts anew.
PIECE = 512
#: Longest gradient of a window's token, and the first step size.
CLIP, RATE = 1.0, 0.15


@dataclass(frozen=True)
class Shape:
    """Own words, open classes, and the first own word of each class of own words (and their number at the end)."""

    own: int
    open: int
    starts: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.starts) - 1 + self.open

    def class_of(self, types: np.ndarray) -> np.ndarray:
        """The class of each type."""
        return np.where(types < self.own, np.searchsorted(self.starts, types, "right") - 1, types - self.own + len(self.starts) - 1)


def shape(counts: np.ndarray, open_: int, classes: int) -> Shape:
    """Classes for own words with these descending counts."""
    mass = np.cumsum(np.sqrt(counts))
    part = np.minimum((mass - mass[0]) / mass[-1] * classes, classes - 1).astype(int) if len(counts) else np.empty(0, int)
    starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(counts) else np.empty(0, int)
    return Shape(len(counts), open_, np.append(starts, len(counts)).astype(np.int64))


def initial(s: Shape, hidden: int, counts: np.ndarray, open_counts: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters of a network that starts as the unigram model: biases are log shares, weights small and fixed by a seed.

    Gates (update, reset) have inputs xg and recurrent weights ug, candidates xn and un; c, cb are of classes, w, wb of words.
    """
    rng = np.random.default_rng(11)
    per_class = np.array([counts[a:b].sum() for a, b in zip(s.starts, s.starts[1:])] + open_counts.tolist(), float) + 1
    of_own = np.repeat(per_class[: len(s.starts) - 1], np.diff(s.starts))
    p = {
        "xg": rng.normal(0, 0.3, (s.own + s.open + 1, 2 * hidden)),
        "xn": rng.normal(0, 0.3, (s.own + s.open + 1, hidden)),
        "ug": rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 2 * hidden)),
        "un": rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, hidden)),
        "c": rng.normal(0, 0.05, (hidden, s.classes)),
        "cb": np.log(per_class / per_class.sum()),
        "w": rng.normal(0, 0.05, (s.own, hidden)),
        "wb": np.log((counts + 1) / of_own),
    }
    return {k: v.astype(np.float32) for k, v in p.items()}


class Streams:
    """Texts laid end to end in slots, the longest text first and each to the least filled slot; the fullest slot is the first.

    Held flat, slot after slot: types, inputs (the type before; at a text's first its lead), fresh starts and texts' numbers.
    """

    def __init__(self, texts: list[np.ndarray], leads: np.ndarray, most: int):
        lengths = np.array([len(t) for t in texts], np.int64)
        n = int(max(1, min(most, len(texts))))
        heap, chosen = [(0, i) for i in range(n)], [[] for _ in range(n)]
        for t in np.argsort(-lengths, kind="stable").tolist():
            size, i = heapq.heappop(heap)
            chosen[i].append(t)
            heapq.heappush(heap, (size + int(lengths[t]), i))
        fill = np.array([lengths[own].sum() for own in chosen], np.int64)
        by = np.argsort(-fill, kind="stable")
        order = np.array([t for i in by.tolist() for t in chosen[i]], np.int64)
        self.fill, self.starts = fill[by], np.cumsum(fill[by]) - fill[by]
        first = np.cumsum(lengths[order]) - lengths[order]
        self.types = np.concatenate([texts[t] for t in order.tolist()])
        self.text = np.repeat(order, lengths[order]).astype(np.int32)
        self.fresh = np.zeros(len(self.types), bool)
        self.fresh[first] = True
        self.inputs = np.concatenate([self.types[:1], self.types[:-1]])
        self.inputs[first] = leads[order]

    def windows(self):
        """Windows of WINDOW steps over the slots that have tokens left: (places in the flat arrays, filled)."""
        step = np.arange(WINDOW)[:, None]
        for a in range(0, int(self.fill[0]), WINDOW):
            k = int(np.searchsorted(-self.fill, -a, "left"))
            yield np.minimum(self.starts[:k] + a + step, len(self.types) - 1), a + step < self.fill[:k]


class Network:
    """The network over a number of slots. Arrays are made once and filled anew each window: new memory costs more than the sums."""

    def __init__(self, p: dict[str, np.ndarray], s: Shape, slots: int):
        f, hidden, most = np.float32, p["un"].shape[0], WINDOW * slots
        self.p, self.s, self.hidden, self.slots = p, s, hidden, slots
        self.h = np.zeros((WINDOW + 1, slots, hidden), f)  # states; the first is carried from the window before
        self.before, self.n, self.gn = (np.zeros((WINDOW, slots, hidden), f) for _ in range(3))
        self.zr = np.zeros((WINDOW, slots, 2 * hidden), f)
        self._g, self._t = np.zeros((slots, 2 * hidden), f), np.zeros((slots, hidden), f)
        self._sorted, self._sum = np.zeros((most, hidden), f), np.zeros(most, f)
        self._logits = np.zeros((most, s.classes), f)
        self._words = np.zeros(most * int(np.diff(s.starts).max(initial=1)), f)
        self._ones = np.ones(max(s.classes, int(np.diff(s.starts).max(initial=1))), f)
        self._class = s.class_of(np.arange(s.own + s.open)).astype(np.int16)

    def advance(self, inputs: np.ndarray, fresh: np.ndarray) -> None:
        """States of the first slots after each step's input (steps, slots), from the last state of the window before."""
        p, hidden, k = self.p, self.hidden, inputs.shape[1]
        g, t = self._g[:k], self._t[:k]
        self.h[0] = self.h[-1]
        for i in range(len(inputs)):
            before, zr, gn, n, out = self.before[i, :k], self.zr[i, :k], self.gn[i, :k], self.n[i, :k], self.h[i + 1, :k]
            np.copyto(before, self.h[i, :k])
            new = np.flatnonzero(fresh[i])
            if len(new):
                before[new] = 0
            np.take(p["xg"], inputs[i], axis=0, out=zr, mode="clip")
            np.matmul(before, p["ug"], out=g)
            zr += g
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.take(p["xn"], inputs[i], axis=0, out=n, mode="clip")
            np.matmul(before, p["un"], out=gn)
            np.multiply(zr[:, hidden:], gn, out=t)
            n += t
            np.tanh(n, out=n)
            np.subtract(before, n, out=out)
            out *= zr[:, :hidden]
            out += n

    def _softmax(self, a: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probabilities of columns `at` of rows of logits, which become exponents; their sums are left in _sum."""
        np.minimum(a, 60, out=a)  # an exponent of a single float ends at 88
        chosen, total = a[np.arange(len(a)), at], self._sum[: len(a)]
        np.exp(a, out=a)
        np.matmul(a, self._ones[: a.shape[1]], out=total)
        return chosen - np.log(total)

    def log_probabilities(self, types: np.ndarray, filled: np.ndarray, learn=None) -> np.ndarray:
        """Natural log probability of each filled step's type given its state; learn(kind, rows, ..) gets what gradients are made of."""
        s, p, states = self.s, self.p, self.h[1:].reshape(-1, self.hidden)
        place = (np.arange(WINDOW)[:, None] * self.slots + np.arange(types.shape[1]))[filled]
        types = types[filled]
        cls = self._class[types]
        order = np.argsort(cls, kind="stable")  # by class, so that a class' rows are one slice
        ends = np.searchsorted(cls[order], np.arange(s.classes + 1))
        h, logits = self._sorted[: len(order)], self._logits[: len(order)]
        np.take(states, place[order], axis=0, out=h, mode="clip")
        np.matmul(h, p["c"], out=logits)
        logits += p["cb"]
        of = cls[order]
        found = self._softmax(logits, of)
        if learn:
            learn("c", h, logits, self._sum[: len(h)], of, slice(None), slice(None))
        types = types[order]
        for g, (a, b) in enumerate(zip(s.starts.tolist(), s.starts[1:].tolist())):
            rows = slice(ends[g], ends[g + 1])
            k = rows.stop - rows.start
            if b - a > 1 and k:
                logits, word = self._words[: k * (b - a)].reshape(k, b - a), types[rows] - a
                np.matmul(h[rows], p["w"][a:b].T, out=logits)
                logits += p["wb"][a:b]
                found[rows] += self._softmax(logits, word)
                if learn:
                    learn("w", h[rows], logits, self._sum[:k], word, rows, slice(a, b))
        if learn:
            learn("end", place[order])
        out = np.empty(len(types))
        out[order] = found
        return out


def scored(p: dict, s: Shape, texts: list[np.ndarray], most: int = 512) -> np.ndarray:
    """Natural log likelihood of each whole text of types; every text has one token at least."""
    streams, out = Streams(texts, np.full(len(texts), s.own + s.open), most), np.zeros(len(texts))
    net = Network(p, s, len(streams.fill))
    for at, filled in streams.windows():
        net.advance(streams.inputs[at], streams.fresh[at] & filled)
        out += np.bincount(streams.text[at][filled], net.log_probabilities(streams.types[at], filled), len(texts))
    return out


class Learner(Network):
    """A network under training by truncated backpropagation, with step sizes that fall by the gradients seen (Adagrad)."""

    def __init__(self, p: dict[str, np.ndarray], s: Shape, slots: int):
        super().__init__({k: v.copy() for k, v in p.items()}, s, slots)
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in p.items()}
        self._grad = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}
        self._back, self._more = np.zeros_like(self._sorted), np.zeros_like(self._sorted)
        self._dh, self._dn, self._dgn, self._dzr = np.zeros_like(self.n), np.zeros_like(self.n), np.zeros_like(self.n), np.zeros_like(self.zr)
        self._a, self._b = np.zeros_like(self._t), np.zeros_like(self._t)
        self._wide = np.zeros((WINDOW * slots, 2 * self.hidden), np.float32)

    def learn(self, streams: Streams) -> None:
        """One pass over streams, states carried from window to window; errors of a window stay in it."""
        for at, filled in streams.windows():
            inputs, fresh = streams.inputs[at], streams.fresh[at] & filled
            self.advance(inputs, fresh)
            for g in self._grad.values():
                g.fill(0)
            self.log_probabilities(streams.types[at], filled, self._output)
            self._step_back(inputs, fresh, np.float32(1 / filled.sum()))

    def _output(self, kind: str, rows, *told) -> None:
        """Gradients of an output layer's parameters and of the states under it, from its exponents, their sums and the right columns."""
        if kind == "end":
            self._dh.reshape(-1, self.hidden)[...] = 0
            self._dh.reshape(-1, self.hidden)[rows] = self._back[: len(rows)]
            return
        d, total, right, at, own = told
        d /= total[:, None]
        d[np.arange(len(d)), right] -= 1
        if kind == "c":
            np.matmul(rows.T, d, out=self._grad["c"])
            np.sum(d, axis=0, out=self._grad["cb"])
            np.matmul(d, self.p["c"].T, out=self._back[: len(d)])
        else:
            np.matmul(d.T, rows, out=self._grad["w"][own])
            np.sum(d, axis=0, out=self._grad["wb"][own])
            more = self._more[: len(d)]
            np.matmul(d, self.p["w"][own], out=more)
            self._back[at] += more

    def _step_back(self, inputs: np.ndarray, fresh: np.ndarray, scale: np.float32) -> None:
        p, hidden, k = self.p, self.hidden, inputs.shape[1]
        a, b = self._a[:k], self._b[:k]
        carry = np.zeros((k, hidden), np.float32)
        for t in range(len(inputs) - 1, -1, -1):
            z, r, n, dn, dzr, dgn = self.zr[t, :k, :hidden], self.zr[t, :k, hidden:], self.n[t, :k], self._dn[t, :k], self._dzr[t, :k], self._dgn[t, :k]
            carry += self._dh[t, :k]
            np.subtract(1, z, out=a)
            np.multiply(n, n, out=b)
            np.subtract(1, b, out=b)
            np.multiply(carry, a, out=dn)
            dn *= b
            np.subtract(self.before[t, :k], n, out=b)
            b *= a
            b *= z
            np.multiply(b, carry, out=dzr[:, :hidden])
            np.multiply(dn, r, out=dgn)
            np.subtract(1, r, out=b)
            b *= self.gn[t, :k]
            np.multiply(b, dgn, out=dzr[:, hidden:])
            carry *= z
            np.matmul(dzr, p["ug"].T, out=a)
            carry += a
            np.matmul(dgn, p["un"].T, out=a)
            carry += a
            new = np.flatnonzero(fresh[t])
            if len(new):
                carry[new] = 0
        flat = self.before[:, :k].reshape(-1, hidden).T
        self._step("ug", slice(None), flat @ self._dzr[:, :k].reshape(-1, 2 * hidden), scale)
        self._step("un", slice(None), flat @ self._dgn[:, :k].reshape(-1, hidden), scale)
        for name, g in self._grad.items():
            self._step(name, slice(None), g, scale)
        ids = inputs.reshape(-1)
        order = np.argsort(ids, kind="stable")
        own, first = np.unique(ids[order], return_index=True)
        for name, d, buffer in (("xg", self._dzr, self._wide), ("xn", self._dn, self._more)):
            np.take(d[:, :k].reshape(len(ids), -1), order, axis=0, out=buffer[: len(ids)], mode="clip")
            self._step(name, own, np.add.reduceat(buffer[: len(ids)], first, axis=0), scale)

    def _step(self, k: str, at, g: np.ndarray, scale: np.float32) -> None:
        g *= scale
        np.clip(g, -CLIP, CLIP, out=g)
        self.seen[k][at] += g * g
        self.p[k][at] -= np.float32(RATE) * g / np.sqrt(self.seen[k][at])


def learned(p: dict, s: Shape, texts: list[np.ndarray], slots: int = 64) -> dict[str, np.ndarray]:
    """Parameters after one pass over texts, of which long ones are learned in pieces side by side."""
    pieces = [(t[a : a + PIECE], t[a - 1] if a else s.own + s.open) for t in texts for a in range(0, len(t), PIECE)]
    streams = Streams([t for t, _ in pieces], np.array([lead for _, lead in pieces]), slots)
    learner = Learner(p, s, len(streams.fill))
    learner.learn(streams)
    return learner.p
