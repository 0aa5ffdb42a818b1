"""A gated recurrent network over words and groups of words ("cells"), in numpy: truncated backpropagation through time and scoring.

Cells are numbered class by class, ``WIDTH`` numbers a class. The output is factored: a softmax over classes, and within the class a
softmax over its cells, both from the state. The input is the cell before, so a frequent word, which has a cell of its own, is seen as itself.

Many documents run side by side in lanes; a lane holds documents one after another, the state is carried from window to window and
begins anew with each document. For training, documents longer than a lane's share are cut into pieces that run in several lanes, so
that all tokens are learned from and lanes end together; a later piece begins with the state of the tokens before it.
"""

from __future__ import annotations

import numpy as np

HIDDEN, STEPS, LANES, RATE, WIDTH = 16, 16, 512, 0.02, 64
#: ``x`` and ``v``, of which a window touches part, are learned with Adagrad at this rate; the others with Adam.
SPARSE_RATE, DENSE = 0.4, ("u", "bias", "w")
WARM = 64  # tokens before a later piece from which its first state comes
SCORED = 1 << 12  # states for which outputs are computed at a time
NOWHERE = -30.0  # logit of numbers that stand for no cell


class Network:
    """``x``: each cell's contribution to the gates, so an input costs a lookup; its last row stands before a document's first token.

    ``w``: states (and a constant) to classes; ``v``: for each class, states (and a constant) to its cells.
    """

    NAMES = ("x", "u", "bias", "w", "v")

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        r = np.random.default_rng(seed)
        self.classes, self.hidden, self.start = classes, hidden, classes * WIDTH
        self.x = r.normal(0, 0.2, (self.start + 1, 3 * hidden)).astype(np.float32)
        self.u = r.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
        self.bias = np.zeros(3 * hidden, np.float32)
        self.w = np.r_[r.normal(0, 0.1, (hidden, classes)), np.zeros((1, classes))].astype(np.float32)
        self.v = np.zeros((classes, hidden + 1, WIDTH), np.float32)

    def begin_with(self, mass: np.ndarray) -> None:
        """Without a state, outputs follow the training counts of the cells (negative: no such cell)."""
        m = np.maximum(mass, 0).reshape(self.classes, WIDTH) + 1.0
        m[mass.reshape(m.shape) < 0] = 0
        with np.errstate(divide="ignore"):
            self.v[:, -1] = np.maximum(np.log(m / m.sum(axis=1, keepdims=True)), NOWHERE)
        self.w[-1] = np.log(m.sum(axis=1) / m.sum())

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    @classmethod
    def of(cls, flat: np.ndarray, classes: int, hidden: int = HIDDEN) -> Network:
        net, at = cls(classes, hidden), 0
        for n in cls.NAMES:
            old = getattr(net, n)
            setattr(net, n, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return net

    def step(self, h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gates and next state: update z, reset r, candidate c."""
        k = self.hidden
        a = self.x[before] + self.bias
        g = h @ self.u[:, : 2 * k]
        g += a[:, : 2 * k]
        np.negative(g, out=g)
        np.exp(g, out=g)
        g += 1
        np.reciprocal(g, out=g)
        z, r = g[:, :k], g[:, k:]
        rh = r * h
        c = np.tanh(a[:, 2 * k :] + rh @ self.u[:, 2 * k :])
        return z, r, rh, c, h + z * (c - h)


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first, each to the shortest lane."""
    import heapq

    heap = [(0, i) for i in range(min(lanes, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        n, i = heapq.heappop(heap)
        out[i].append(d)
        heapq.heappush(heap, (n + int(lengths[d]), i))
    return out


def grid(docs: list[np.ndarray], lanes: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """(targets, inputs, first, width by step, lanes) as time x lane arrays; lanes in falling order of length, so those still running come first."""
    lengths = np.array([len(d) for d in docs])
    dealt = lanes_of(lengths, lanes)
    sizes = np.array([int(lengths[x].sum()) for x in dealt])
    order = np.argsort(-sizes, kind="stable")
    dealt, sizes = [dealt[i] for i in order], sizes[order]
    targets = np.zeros((int(sizes[0]), len(dealt)), np.int32)
    first = np.zeros(targets.shape, bool)
    for i, own in enumerate(dealt):
        targets[: sizes[i], i] = np.concatenate([docs[d] for d in own])
        first[np.r_[0, np.cumsum(lengths[own])[:-1]], i] = True
    inputs = np.zeros_like(targets)
    inputs[1:] = targets[:-1]
    inputs[first] = start
    width = np.searchsorted(-sizes, -np.arange(len(targets)), side="left")
    return targets, inputs, first, width, dealt


def by_class(states: np.ndarray, goal: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """(order by the goal's class, states and a constant in that order, runs as (class, first, end))."""
    cls = goal // WIDTH
    order = np.argsort(cls.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(cls, minlength=classes)).tolist()
    runs = [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if b > a]
    ones = np.empty((len(goal), states.shape[1] + 1), np.float32)
    ones[:, :-1] = states[order]
    ones[:, -1] = 1
    return order, ones, runs


def log_outputs(net: Network, states: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each goal, given the state before it."""
    order, ones, runs = by_class(states, goal, net.classes)
    rows, sorted_ = np.arange(len(goal)), goal[order]
    outer, inner = ones @ net.w, np.empty((len(goal), WIDTH), np.float32)
    for c, a, b in runs:
        np.matmul(ones[a:b], net.v[c], out=inner[a:b])
    picked = outer[rows, sorted_ // WIDTH] + inner[rows, sorted_ % WIDTH]
    np.exp(outer, out=outer)
    np.exp(inner, out=inner)
    out = np.empty(len(goal), np.float32)
    out[order] = picked - np.log(outer.sum(axis=1) * inner.sum(axis=1))
    return out


def score(net: Network, docs: list[np.ndarray], lanes: int = LANES) -> np.ndarray:
    """log10 probability of each document's sequence of cells (documents must not be empty)."""
    if not docs:
        return np.empty(0)
    targets, inputs, first, width, dealt = grid(docs, lanes, net.start)
    found = np.zeros(targets.shape, np.float32)
    h = np.zeros((targets.shape[1], net.hidden), np.float32)
    held, since, n_held = [], 0, 0
    for t in range(len(targets)):
        n = width[t]
        h = h[:n]
        fresh = first[t, :n]
        if fresh.any():
            h = np.where(fresh[:, None], np.float32(0), h)
        h = net.step(h, inputs[t, :n])[-1]
        held.append(h)
        n_held += n
        if n_held >= SCORED or t == len(targets) - 1:
            logs = log_outputs(net, np.concatenate(held), np.concatenate([targets[i, : width[i]] for i in range(since, t + 1)]))
            ends = np.cumsum([len(x) for x in held])
            for i, x in zip(range(since, t + 1), np.split(logs, ends[:-1]), strict=True):
                found[i, : width[i]] = x
            held, since, n_held = [], t + 1, 0
    out = np.empty(len(docs))
    for i, own in enumerate(dealt):
        ends = np.cumsum([len(docs[d]) for d in own])
        column = found[: ends[-1], i].astype(np.float64)
        out[own] = np.add.reduceat(column, np.r_[0, ends[:-1]])
    return out / np.log(10)


def first_states(net: Network, docs: list[np.ndarray], cuts: list[tuple[int, int]], size: int) -> np.ndarray:
    """The state before each piece (document, offset; multiples of ``size``): zero for a document's first piece."""
    out, span = np.zeros((len(cuts), net.hidden), np.float32), min(WARM, size)
    later = [i for i, (_, a) in enumerate(cuts) if a]
    if not later:
        return out
    before = np.stack([docs[d][a - 1 - span : a - 1] if a > span else np.r_[net.start, docs[d][: a - 1]] for d, a in (cuts[i] for i in later)])
    h = out[later]
    for t in range(span):
        h = net.step(h, before[:, t])[-1]
    out[later] = h
    return out


def train(net: Network, docs: list[np.ndarray], steps: int = STEPS, lanes: int = LANES, rate: float = RATE, state: dict | None = None) -> dict:
    """One pass over all tokens of the documents; changes ``net``, returns the optimiser's state.

    A token weighs the same in every window of a call. ``tokens`` of the state counts what was learned from.
    """
    tokens = sum(map(len, docs))
    if not tokens:
        return state or {}
    lanes = int(min(lanes, max(8, tokens // (steps * 12))))
    size = -(-tokens // (lanes * steps)) * steps
    cuts = [(d, a) for d, x in enumerate(docs) for a in range(0, len(x), size)]
    targets, inputs, first, width, dealt = grid([docs[d][a : a + size] for d, a in cuts], lanes, net.start)
    number = np.zeros(first.shape, np.int32)
    for i, own in enumerate(dealt):
        number[first[:, i], i] = own
    inputs[first] = np.array([docs[d][a - 1] if a else net.start for d, a in cuts], np.int32)[number[first]]
    starts = first_states(net, docs, cuts, size)
    weight = np.float32(1 / (targets.shape[1] * min(steps, len(targets))))
    k = net.hidden
    state = state or {"n": 0, "tokens": 0, **{f"v{n}": np.zeros_like(getattr(net, n)) for n in net.NAMES}, **{f"m{n}": np.zeros_like(getattr(net, n)) for n in DENSE}}
    h = np.zeros((targets.shape[1], k), np.float32)
    for begin in range(0, len(targets), steps):
        window = range(begin, min(begin + steps, len(targets)))
        kept = []
        for t in window:
            n = int(width[t])
            h, fresh = h[:n], first[t, :n]
            if fresh.any():
                h = np.where(fresh[:, None], starts[number[t, :n]], h)
            z, r, rh, c, new = net.step(h, inputs[t, :n])
            kept.append((h, z, r, rh, c, new))
            h = new
        grads = {n: np.zeros_like(getattr(net, n)) for n in ("u", "v")}
        stacked = np.concatenate([x[-1] for x in kept])
        goal = np.concatenate([targets[t, : width[t]] for t in window])
        order, ones, runs = by_class(stacked, goal, net.classes)
        rows, sorted_ = np.arange(len(goal)), goal[order]
        p, q = ones @ net.w, np.empty((len(goal), WIDTH), np.float32)
        for c, i, j in runs:
            np.matmul(ones[i:j], net.v[c], out=q[i:j])
        for x, at in ((p, sorted_ // WIDTH), (q, sorted_ % WIDTH)):
            np.exp(x, out=x)  # states lie in (-1, 1), so logits stay small
            x *= (weight / x.sum(axis=1, dtype=np.float32))[:, None]
            x[rows, at] -= weight
        grads["w"] = ones.T @ p
        back = p @ net.w[:k].T
        for c, i, j in runs:
            np.matmul(ones[i:j].T, q[i:j], out=grads["v"][c])
            back[i:j] += q[i:j] @ net.v[c, :k].T
        out = np.empty_like(back)
        out[order] = back
        ends = np.cumsum([len(x[-1]) for x in kept])
        carry = np.zeros((0, k), np.float32)
        gates = [None] * len(kept)
        for i in range(len(kept) - 1, -1, -1):
            before, z, r, rh, c, new = kept[i]
            d = out[ends[i] - len(new) : ends[i]].copy()
            d[: len(carry)] += carry
            dc = d * z * (1 - c * c)
            drh = dc @ net.u[:, 2 * k :].T
            dz = d * (c - before) * z * (1 - z)
            dr = drh * before * r * (1 - r)
            gates[i] = np.concatenate([dz, dr, dc], axis=1)
            grads["u"][:, : 2 * k] += before.T @ gates[i][:, : 2 * k]
            grads["u"][:, 2 * k :] += rh.T @ dc
            carry = d * (1 - z) + drh * r + gates[i][:, : 2 * k] @ net.u[:, : 2 * k].T
            fresh = first[begin + i, : len(carry)]
            if fresh.any():
                carry = np.where(fresh[:, None], np.float32(0), carry)
        gate = np.concatenate(gates)
        grads["bias"] = gate.sum(axis=0)
        source = np.concatenate([inputs[t, : width[t]] for t in window])
        by = np.argsort(source, kind="stable")
        at = np.flatnonzero(np.r_[True, source[by][1:] != source[by][:-1]])
        touched, slopes = source[by][at], np.add.reduceat(gate[by], at)
        state["vx"][touched] += slopes * slopes
        net.x[touched] -= np.float32(SPARSE_RATE) * slopes / (np.sqrt(state["vx"][touched]) + np.float32(1e-8))
        state["n"] += 1
        state["tokens"] += len(goal)
        fix = np.sqrt(1 - 0.999 ** state["n"]) / (1 - 0.9 ** state["n"])
        state["vv"] += grads["v"] * grads["v"]
        net.v -= np.float32(SPARSE_RATE) * grads["v"] / (np.sqrt(state["vv"]) + np.float32(1e-8))
        for n in DENSE:
            m, v, g = state[f"m{n}"], state[f"v{n}"], grads[n]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            getattr(net, n)[...] -= np.float32(rate * fix) * m / (np.sqrt(v) + 1e-8)
    return state
