"""Linear-chain conditional random fields over many ragged sequences at once.

Scores of the tokens of all sequences stand in one array. Sequences are cut into short
blocks; the effect of a block on its border states is a small matrix, so all blocks of all
sequences advance together, step by step, and a sequence of any length costs a few more
border steps only.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.blocks import ranges

STEPS = 32


class _Blocks:
    def __init__(self, first: np.ndarray):
        length = np.diff(first)
        self.per = -(-length // STEPS)
        self.begin = np.cumsum(self.per) - self.per  # a sequence's first block
        start = np.repeat(first[:-1], self.per) + ranges(self.per) * STEPS
        size = np.minimum(STEPS, np.repeat(first[1:], self.per) - start)
        self.count = len(start)
        self.heads = np.zeros(self.count, bool)  # no transition leads into these
        self.heads[self.begin[self.per > 0]] = True
        self.inside = np.arange(STEPS) < size[:, None]
        self.index = np.where(self.inside, start[:, None] + np.arange(STEPS), 0)

    def rows(self, k: int) -> np.ndarray:
        """The k-th block of each sequence that has one."""
        return self.begin[self.per > k] + k

    def flat(self, padded: np.ndarray) -> np.ndarray:
        return padded[self.inside]


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Posterior of every state at every token, by forward-backward; states start alike.

    The expected number of each transition is added to ``pairs``.
    """
    states = scores.shape[1]
    if not len(scores):
        return np.zeros((0, states))
    b = _Blocks(first)
    heads = b.heads
    step = np.exp(transitions - transitions.max())
    gain = np.exp(scores - scores.max(1, keepdims=True))[b.index]
    product = np.broadcast_to(np.eye(states), (b.count, states, states)).copy()
    for t in range(STEPS):
        new = (product.reshape(-1, states) @ step).reshape(product.shape)
        if t == 0:
            new = np.where(heads[:, None, None], product, new)
        new *= gain[:, t, None, :]
        new /= new.sum((1, 2), keepdims=True)
        product = np.where(b.inside[:, t, None, None], new, product)
    enter = np.full((b.count, states), 1 / states)
    leave = np.ones((b.count, states))
    for k in range(1, int(b.per.max())):
        at = b.rows(k)
        now = np.einsum("ni,nij->nj", enter[at - 1], product[at - 1])
        enter[at] = now / now.sum(1, keepdims=True)
    for k in range(int(b.per.max()) - 1, 0, -1):
        at = b.rows(k)
        now = np.einsum("nij,nj->ni", product[at], leave[at])
        leave[at - 1] = now / now.sum(1, keepdims=True)
    ahead = np.empty((b.count, STEPS, states))
    now = enter
    for t in range(STEPS):
        new = (now @ step if t else np.where(heads[:, None], now, now @ step)) * gain[:, t]
        now = np.where(b.inside[:, t, None], new / new.sum(1, keepdims=True), now)
        ahead[:, t] = now
    now = leave
    for t in range(STEPS - 1, -1, -1):
        if pairs is not None:
            before = ahead[:, t - 1] if t else enter
            both = before[:, :, None] * step * (gain[:, t] * now)[:, None, :]
            both /= both.sum((1, 2), keepdims=True)
            pairs += both[b.inside[:, t] & (~heads if t == 0 else True)].sum(0)
        ahead[:, t] *= now
        new = (now * gain[:, t]) @ step.T
        now = np.where(b.inside[:, t, None], new / new.sum(1, keepdims=True), now)
    out = b.flat(ahead)
    return out / out.sum(1, keepdims=True)


def viterbi(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The best state of every token on its sequence's best path.

    The best score of a path through each state comes from a forward and a backward pass
    over maxima; the path is where it is highest (the lower state where two tie).
    """
    states = scores.shape[1]
    if not len(scores):
        return np.zeros(0, np.int64)
    b = _Blocks(first)
    gain = scores[b.index]

    def through(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        best = left[..., 0, None] + right[..., 0, :]
        for k in range(1, states):
            best = np.maximum(best, left[..., k, None] + right[..., k, :])
        return best

    product = np.where(np.eye(states, dtype=bool), 0.0, -1e18) + np.zeros((b.count, 1, 1))
    for t in range(STEPS):
        moved = through(product, transitions)
        if t == 0:
            moved = np.where(b.heads[:, None, None], product, moved)
        product = np.where(b.inside[:, t, None, None], moved + gain[:, t, None, :], product)
    enter, leave = np.zeros((b.count, states)), np.zeros((b.count, states))
    for k in range(1, int(b.per.max())):
        at = b.rows(k)
        enter[at] = (enter[at - 1, :, None] + product[at - 1]).max(1)
    for k in range(int(b.per.max()) - 1, 0, -1):
        at = b.rows(k)
        leave[at - 1] = (product[at] + leave[at, None, :]).max(2)
    ahead = np.empty((b.count, STEPS, states))
    now = enter
    for t in range(STEPS):
        moved = through(now, transitions) if t else np.where(b.heads[:, None], now, through(now, transitions))
        now = np.where(b.inside[:, t, None], moved + gain[:, t], now)
        ahead[:, t] = now
    now = leave
    for t in range(STEPS - 1, -1, -1):
        ahead[:, t] += now
        now = np.where(b.inside[:, t, None], through(now + gain[:, t], transitions.T), now)
    return b.flat(ahead).argmax(1)


def fit(
    features: np.ndarray, owner: np.ndarray, types: np.ndarray, labels: np.ndarray, first: np.ndarray,
    states: int, width: int, rounds: int, rate: float = 0.5, decay: float = 1e-6,
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, transitions) that maximise the likelihood of the labels, by AdaGrad over all sequences.

    Token i is of type ``types[i]``; feature ``features[j]`` belongs to type ``owner[j]``.
    """
    kinds = int(types.max()) + 1
    weights, transitions = np.zeros((width, states)), np.zeros((states, states))
    seen_w, seen_t = np.full_like(weights, 1e-12), np.full_like(transitions, 1e-12)
    truth = np.eye(states)[labels]
    inner = np.ones(len(labels), bool)
    inner[first[:-1]] = False
    inner = np.flatnonzero(inner)
    pairs = np.zeros((states, states))
    np.add.at(pairs, (labels[inner - 1], labels[inner]), 1)
    for _ in range(rounds):
        scores = np.stack([np.bincount(owner, weights[features, s], kinds) for s in range(states)], 1)[types]
        expected = np.zeros((states, states))
        posterior = marginals(scores, first, transitions, expected)
        gap = truth - posterior
        per_type = np.stack([np.bincount(types, gap[:, s], kinds) for s in range(states)], 1)
        slope = np.stack([np.bincount(features, per_type[owner, s], width) for s in range(states)], 1) / len(types) - decay * weights
        turn = (pairs - expected) / len(types) - decay * transitions
        seen_w += slope**2
        seen_t += turn**2
        weights += rate * slope / np.sqrt(seen_w)
        transitions += rate * turn / np.sqrt(seen_t)
    return weights, transitions
