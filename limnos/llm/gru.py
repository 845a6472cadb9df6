"""A gated recurrent language model in numpy.

Symbols are the words of a head vocabulary and the tail classes of all other words. The output is factored:
one softmax over classes (groups of head words, and the tail classes) and, in a group, one over its words.
Training backpropagates through windows of WINDOW steps; states go on from window to window, in training as
in scoring, and start anew with each document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 20
GROUP = 64
GROUPS = 32
TAILS = 64
WINDOW = 16
STREAMS = 128
#: Rows of states whose outputs are computed together (in training: PART), and documents whose states are, so that they stay in the cache.
ROWS = 8192
PART = 2048
TOGETHER = 1024
#: The exponents of a softmax may span so much before single precision loses its largest term.
SPAN = 60.0


@dataclass
class Gru:
    """Weights: symbol table (input side, three gates), recurrence, class output, word output by group."""

    table: np.ndarray  # symbols x 3H
    rec: np.ndarray  # H x 3H
    rec_b: np.ndarray  # H, of the candidate's recurrent part
    cls: np.ndarray  # H x classes
    cls_b: np.ndarray
    out: np.ndarray  # groups x H x GROUP
    out_b: np.ndarray  # groups x GROUP
    end: int = 0  # the symbol before a document's first

    NAMES = ("table", "rec", "rec_b", "cls", "cls_b", "out", "out_b")

    @staticmethod
    def new(head_counts: np.ndarray, tail_counts: np.ndarray, end: int, seed: int = 1) -> Gru:
        """Weights that start at the symbols' own frequencies. head_counts: by head word, most frequent first."""
        r = np.random.default_rng(seed)
        f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        full = np.zeros(GROUPS * GROUP)
        full[: len(head_counts)] = head_counts
        full = full.reshape(GROUPS, GROUP)
        masses = np.concatenate([full.sum(1), tail_counts]) + 0.5
        inside = np.where(full > 0, np.log(full + 0.5), -30.0)
        return Gru(
            f(GROUPS * GROUP + TAILS, 3 * HIDDEN, scale=0.3), f(HIDDEN, 3 * HIDDEN, scale=0.2), np.zeros(HIDDEN, np.float32), f(HIDDEN, GROUPS + TAILS, scale=0.02), np.log(masses / masses.sum()).astype(np.float32),
            f(GROUPS, HIDDEN, GROUP, scale=0.02), (inside - inside.max(1, keepdims=True)).astype(np.float32), end,
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def with_flat(self, values: np.ndarray) -> Gru:
        out, at = {}, 0
        for k in self.NAMES:
            a = getattr(self, k)
            out[k] = values[at : at + a.size].reshape(a.shape).astype(np.float32)
            at += a.size
        return Gru(**out, end=self.end)

    # ---- softmax ----

    @staticmethod
    def _shift(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bias less a bound of the logits, whether that may stand for their maximum): states are within -1 and 1."""
        most = np.abs(weights).sum(axis=-2)
        top = (bias + most).max(axis=-1)
        return (bias - top[..., None]).astype(bias.dtype), top - (bias - most).max(axis=-1) < SPAN

    @staticmethod
    def _with_one(h: np.ndarray) -> np.ndarray:
        """States and a one, which meets the bias as the last row of the weights."""
        out = np.empty((len(h), HIDDEN + 1), h.dtype)
        out[:, :HIDDEN], out[:, HIDDEN] = h, 1
        return out

    def _outer(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(class weights, bounded, word weights by group, bounded by group) with the shifted biases as last rows."""
        (cls_b, bounded), (out_b, inner) = self._shift(self.cls, self.cls_b), self._shift(self.out, self.out_b)
        return np.concatenate([self.cls, cls_b[None]]), bounded, np.concatenate([self.out, out_b[:, None]], axis=1), inner

    @staticmethod
    def _logits(h1: np.ndarray, weights: np.ndarray, bounded) -> np.ndarray:
        """Shifted logits."""
        logits = h1 @ weights
        if not bounded:
            logits -= logits.max(axis=1, keepdims=True)
        return logits

    def _grouped(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(class of each target, an order that sorts them by class, (class, start, end) in that order; head words come first)."""
        cls = np.where(targets < GROUPS * GROUP, targets // GROUP, targets - GROUPS * GROUP + GROUPS).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        edges = np.append(0, np.cumsum(np.bincount(cls, minlength=GROUPS + TAILS))).tolist()
        return cls, order, [(k, x, y) for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)) if y > x]

    # ---- scoring ----

    @staticmethod
    def _gates(w: np.ndarray) -> np.ndarray:
        """Columns by gate, each gate contiguous; those of the sigmoids are halved, as these are tanh of the half."""
        out = np.ascontiguousarray(np.moveaxis(w.reshape(*w.shape[:-1], 3, HIDDEN), -2, 0))
        out[:2] *= 0.5
        return out

    def _next(self, h: np.ndarray, x: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, both sigmoids, candidate, its recurrent part) after h. x: the input by gate; its sigmoids' part is lost."""
        g = np.matmul(h, rec)
        zr, gn = x[:2], g[2]
        zr += g[:2]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        gn += self.rec_b
        n = zr[1] * gn
        n += x[2]
        np.tanh(n, out=n)
        out = h - n
        out *= zr[0]
        out += n
        return out, zr, n, gn

    def step(self, h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        return self._next(h, self._gates(self.table.take(symbols, axis=0)), self._gates(self.rec))[0]

    def log_probs(self, h: np.ndarray, targets: np.ndarray, outer=None) -> np.ndarray:
        """Natural log of the probability of each target after its state. outer: _outer(), if at hand."""
        weights, bounded, inner, inner_bounded = outer or self._outer()
        cls, order, groups = self._grouped(targets)
        h1 = self._with_one(h)
        every = np.arange(len(h))
        e = self._logits(h1, weights, bounded)
        out = e[every, cls]
        np.exp(e, out=e)
        out -= np.log(e @ np.ones(e.shape[1], e.dtype))
        groups = [x for x in groups if x[0] < GROUPS]
        order = order[: groups[-1][2] if groups else 0]  # the head words
        states, words = h1.take(order, axis=0), targets[order] % GROUP
        found, sums, ones = np.empty(len(order), h.dtype), np.empty(len(order), h.dtype), np.ones(GROUP, h.dtype)
        for k, x, y in groups:
            e = self._logits(states[x:y], inner[k], inner_bounded[k])
            found[x:y] = e[every[: y - x], words[x:y]]
            np.exp(e, out=e)
            sums[x:y] = e @ ones
        found -= np.log(sums)
        out[order] += found
        return out

    def score(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural log-likelihood of each whole document (symbols[offsets[i]:offsets[i+1]], its end included)."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros(len(order))
        gates, outer = (self._gates(self.table), self._gates(self.rec)), self._outer()
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            out[some] = self._score(symbols, offsets[:-1][some], lengths[some], gates, outer)
        return out

    def _score(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, gates, outer) -> np.ndarray:
        """score() of documents side by side, the longest first."""
        total = np.zeros(len(starts))
        if not lengths[0]:
            return total
        table, rec = gates
        alive = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")  # documents longer than t
        h = np.zeros((int(alive[0]), HIDDEN), np.float32)
        before = np.full(len(h), self.end)
        states: list[np.ndarray] = []
        targets: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            got = self.log_probs(np.concatenate(states), np.concatenate(targets), outer)
            at = 0
            for t in targets:
                total[: len(t)] += got[at : at + len(t)]
                at += len(t)
            states.clear()
            targets.clear()

        for t, n in enumerate(alive.tolist()):
            h = self._next(h[:n], table.take(before[:n], axis=1), rec)[0]
            before = symbols[starts[:n] + t]
            states.append(h)
            targets.append(before)
            held += n
            if held >= ROWS:
                flush()
                held = 0
        if states:
            flush()
        return total

    # ---- training ----

    def train(self, symbols: np.ndarray, first: np.ndarray, rate: float = 0.08, epochs: int = 1, streams: int = STREAMS) -> Gru:
        """Adagrad over the text as parallel streams: many make fewer and cheaper steps. first: whether each symbol begins a document."""
        net = self.with_flat(self.flat())
        streams = max(1, min(streams, len(symbols) // (2 * WINDOW)))
        n = len(symbols) // streams
        if not n:
            return net
        grid, fresh = symbols[: streams * n].reshape(streams, n).T, first[: streams * n].reshape(streams, n).T
        before = np.vstack([np.full((1, streams), self.end), grid[:-1]])
        before[fresh] = self.end
        memory = [np.full(getattr(net, k).shape, 1e-3, np.float32) for k in net.NAMES]
        for _ in range(epochs):
            h = np.zeros((streams, HIDDEN), np.float32)
            for at in range(0, n, WINDOW):
                h = net._window(h, before[at : at + WINDOW], grid[at : at + WINDOW], fresh[at : at + WINDOW], memory, rate)
        return net

    def _window(self, h: np.ndarray, before: np.ndarray, targets: np.ndarray, fresh: np.ndarray, memory: list[np.ndarray], rate: float) -> np.ndarray:
        steps, streams = before.shape
        kind = h.dtype
        rec = self._gates(self.rec)
        xs = self._gates(self.table.take(before, axis=0))
        was, states, gn, n = (np.empty((steps, streams, HIDDEN), kind) for _ in range(4))
        zr = np.empty((2, steps, streams, HIDDEN), kind)
        anew = fresh.any(axis=1).tolist()
        for t in range(steps):
            if anew[t]:
                h = np.where(fresh[t][:, None], kind.type(0), h)
            was[t] = h
            h, zr[:, t], n[t], gn[t] = self._next(h, xs[:, t], rec)
            states[t] = h
        grads, d_flat = self._outputs(states.reshape(-1, HIDDEN), targets.ravel())
        d_states = d_flat.reshape(steps, streams, HIDDEN)
        # what doesn't depend on the steps behind is computed for all steps together
        z, r = zr
        to_n, to_z, to_r = (1 - z) * (1 - n * n), (was - n) * z * (1 - z), gn * r * (1 - r)
        d_x, d_g = (np.empty((steps, streams, 3 * HIDDEN), kind) for _ in range(2))
        d_h = np.zeros((streams, HIDDEN), kind)
        back = np.ascontiguousarray(self.rec.T)
        for t in range(steps - 1, -1, -1):
            d = d_states[t]
            d += d_h
            d_n = d * to_n[t]
            np.multiply(d, to_z[t], out=d_g[t, :, :HIDDEN])
            np.multiply(d_n, to_r[t], out=d_g[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(d_n, r[t], out=d_g[t, :, 2 * HIDDEN :])
            d_x[t, :, 2 * HIDDEN :] = d_n
            d_h = d_g[t] @ back
            d *= z[t]
            d_h += d
            if anew[t]:
                d_h[fresh[t]] = 0
        d_x[:, :, : 2 * HIDDEN] = d_g[:, :, : 2 * HIDDEN]
        d_rec = was.reshape(-1, HIDDEN).T @ d_g.reshape(-1, 3 * HIDDEN)
        d_rec_b = np.ones(steps * streams, kind) @ d_g.reshape(-1, 3 * HIDDEN)[:, 2 * HIDDEN :]
        self._adagrad("rec", d_rec, memory[1], rate)
        self._adagrad("rec_b", d_rec_b, memory[2], rate)
        for k, name in ((3, "cls"), (4, "cls_b"), (5, "out"), (6, "out_b")):
            self._adagrad(name, grads[name], memory[k], rate)
        rows = before.ravel().astype(np.int16 if len(self.table) < 1 << 15 else np.int64)
        order = np.argsort(rows, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) > 0]))
        sums = np.add.reduceat(d_x.reshape(-1, 3 * HIDDEN).take(order, axis=0), starts)
        names = rows[order][starts]
        held = memory[0][names] + sums * sums
        memory[0][names] = held
        self.table[names] -= rate * sums / np.sqrt(held)
        return h

    def _adagrad(self, name: str, grad: np.ndarray, memory: np.ndarray, rate: float) -> None:
        memory += grad * grad
        getattr(self, name)[...] -= rate * grad / np.sqrt(memory)

    def _outputs(self, h: np.ndarray, targets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean negative log-likelihood for the output weights and the states."""
        m = h.dtype.type(1 / len(h))
        weights, bounded, inner, inner_bounded = self._outer()
        cls, order, groups = self._grouped(targets)
        h1 = self._with_one(h)
        states = h1.take(order, axis=0)
        at = [x for _, x, _ in groups]
        back, ones = np.ascontiguousarray(self.cls.T), np.ones(len(self.cls_b), h.dtype)
        d_h, d_cls = np.empty_like(h), np.zeros_like(weights)
        for x in range(0, len(h), PART):
            some, d = h1[x : x + PART], d_h[x : x + PART]
            e = self._logits(some, weights, bounded)
            np.exp(e, out=e)
            scale = (m / (e @ ones))[:, None]  # makes e probabilities; applied to the narrower side
            np.matmul(e, back, out=d)
            d *= scale
            some *= scale
            d_cls += some.T @ e
        d_h -= (m * back).take(cls, axis=0)
        d_cls[:, [k for k, _, _ in groups]] -= m * np.add.reduceat(states, at).T
        d_out = np.zeros_like(inner)
        groups = [x for x in groups if x[0] < GROUPS]
        order = order[: groups[-1][2] if groups else 0]  # the head words
        places = np.arange(len(order)) * GROUP + targets[order] % GROUP
        d_states, ones = np.empty((len(order), HIDDEN), h.dtype), np.ones(GROUP, h.dtype)
        for k, x, y in groups:
            q = self._logits(states[x:y], inner[k], inner_bounded[k])
            np.exp(q, out=q)
            q *= (m / (q @ ones))[:, None]
            q.ravel()[places[x:y] - x * GROUP] -= m
            np.matmul(states[x:y].T, q, out=d_out[k])
            np.matmul(q, self.out[k].T, out=d_states[x:y])
        d_h[order] += d_states
        return {"cls": d_cls[:HIDDEN], "cls_b": d_cls[HIDDEN], "out": d_out[:, :HIDDEN], "out_b": d_out[:, HIDDEN]}, d_h
