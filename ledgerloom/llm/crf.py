"""Linear-chain conditional random fields over blocks of sequences, in numpy.

A chain has S states, an emission score per position and state, and a transition score per pair.
All sequences of a block advance together, the longest first (``TimeMajor``), so a step is one
operation on a slice. Scores are logarithms; forward and backward messages are scaled sums.
"""

from __future__ import annotations

import numpy as np

from ._common import TimeMajor


#: Positions whose messages are held at once.
SPAN = 1_000_000


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, lay: TimeMajor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals per position (sequence-major), expected transition counts and the log partition
    function of each sequence. ``emit`` is sequence-major (positions x states). Messages are held for
    ``SPAN`` positions at a time; a first pass keeps those at the spans' borders."""
    a, first = np.exp(trans), np.exp(start)
    o, n, spans = lay.offset, lay.active, lay.spans(SPAN)
    border: list[np.ndarray | None] = [None] * len(spans)
    gamma, pairs, z = np.empty_like(emit), np.zeros_like(a), np.zeros(len(lay.lengths))
    of = np.repeat(np.arange(len(lay.lengths)), lay.lengths)

    def forward(k: int, keep: bool):
        t0, t1 = spans[k]
        at = lay.index[o[t0] : o[t1]]
        e = emit[at]
        top = e.max(1, keepdims=True)
        e = np.exp(e - top)
        alpha, scale, state = (np.empty_like(e), np.empty(len(e)), border[k]) if keep else (e, e, border[k])
        for t in range(t0, t1):
            here = slice(o[t] - o[t0], o[t + 1] - o[t0])
            x = (first if t == 0 else state[: n[t]] @ a) * e[here]
            c = x.sum(1)
            state = x / c[:, None]
            if keep:
                alpha[here], scale[here] = state, c
        if k + 1 < len(spans):
            border[k + 1] = state
        return at, e, alpha, scale, top[:, 0]

    for k in range(len(spans) - 1):
        forward(k, False)
    later = None  # the message of the step behind
    for k in range(len(spans) - 1, -1, -1):
        t0, t1 = spans[k]
        at, e, alpha, scale, top = forward(k, True)
        z += np.bincount(of[at], weights=np.log(scale) + top, minlength=len(z))
        beta = np.ones_like(alpha)
        for t in range(t1 - 1, t0 - 1, -1):
            here = slice(o[t] - o[t0], o[t + 1] - o[t0])
            if later is not None:
                part = slice(here.start, here.start + len(later))
                pairs += a * (alpha[part].T @ later)
                beta[part] = later @ a.T
            later = e[here] * beta[here] / scale[here, None]
        gamma[at] = alpha * beta
    return gamma, pairs, z


def viterbi(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, lay: TimeMajor) -> np.ndarray:
    """The best state sequence of each chain, sequence-major; ties go to the lower state."""
    e = lay.take(emit)
    o, n, states = lay.offset, lay.active, emit.shape[1]
    back = np.zeros(e.shape, np.int8)
    path = np.zeros(len(e), np.int8)
    score = None
    final = np.empty((len(lay.lengths), states))
    for t in range(lay.steps):
        s = slice(o[t], o[t + 1])
        if t == 0:
            score = start + e[s]
        else:
            score = score[: n[t]]
            best = np.zeros((n[t], states), np.int8)
            value = score[:, :1] + trans[0]
            for k in range(1, states):
                other = score[:, k : k + 1] + trans[k]
                better = other > value
                best[better] = k
                value = np.where(better, other, value)
            back[s] = best
            score = value + e[s]
        ends = n[t + 1] if t + 1 < lay.steps else 0
        final[ends : n[t]] = score[ends:]
    last = final.argmax(1).astype(np.int8) if lay.steps else np.empty(0, np.int8)
    for t in range(lay.steps - 1, -1, -1):
        ends = n[t + 1] if t + 1 < lay.steps else 0
        s0 = o[t]
        path[s0 + ends : s0 + n[t]] = last[ends : n[t]]
        if ends:
            nxt = o[t + 1]
            path[s0 : s0 + ends] = back[np.arange(nxt, nxt + ends), path[nxt : nxt + ends]]
    return lay.put(path)


def fit(features: list[np.ndarray], sizes: list[int], labels: np.ndarray, lengths: np.ndarray, states: int, steps: int = 30, l2: float = 1.0, rate: float = 0.5) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Maximum conditional likelihood of labelled chains by Adam on the full gradient.

    ``features``: arrays of feature ids, one per template, aligned with the positions; id 0 means
    none and keeps weight 0. Returns weights per template (size x states), transitions, start."""
    lay = TimeMajor(lengths)
    total = max(1, len(labels))
    first = np.r_[0, np.cumsum(lengths)][:-1][lengths > 0]
    inside = np.ones(len(labels), bool)
    inside[first] = False
    at = np.flatnonzero(inside)
    gold = np.zeros((states, states))
    np.add.at(gold, (labels[at - 1], labels[at]), 1)
    gold_start = np.bincount(labels[first], minlength=states).astype(float)
    one = np.eye(states)[labels]
    params = [np.zeros((m, states)) for m in sizes] + [np.zeros((states, states)), np.zeros(states)]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def gather(values: np.ndarray, f: np.ndarray, m: int) -> np.ndarray:
        return np.stack([np.bincount(f, weights=values[:, k], minlength=m) for k in range(states)], 1)

    for step in range(1, steps + 1):
        emit = sum(w[f] for w, f in zip(params, features, strict=False))
        gamma, pairs, _ = forward_backward(emit, params[-2], params[-1], lay)
        diff = one - gamma
        grads = [gather(diff, f, m) for f, m in zip(features, sizes, strict=True)]
        grads += [gold - pairs, gold_start - gamma[first].sum(0)]
        for i, (p, g) in enumerate(zip(params, grads, strict=True)):
            g = (g - l2 * p) / total
            if i < len(sizes):
                g[0] = 0
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.99 * m2[i] + 0.01 * g * g
            p += rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.99**step)) + 1e-9)
    return params[:-2], params[-2], params[-1]
