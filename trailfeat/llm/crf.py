"""A small linear-chain conditional random field in numpy.

Tokens are given as rows of feature ids (hashed, a fixed number per token) and
tagged with ``O``, ``B-kind`` and ``I-kind``. ``train`` maximises the
regularised log-likelihood by full forward-backward passes over a bounded table
of labelled sequences; ``decode_chains`` runs Viterbi over padded batches of chains
of similar length, so memory is bounded by the batch, and a very long chain goes
block by block, all blocks at the same time. A training tag of ``OPEN`` is not known: such a
token is summed over all its tags and teaches nothing by itself.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

FEATURE_ROWS = 1 << 14
OPEN = -1
_NEVER = -1e4


def feature_ids(names: list[str], slots: int) -> list[int]:
    """Ids of at most ``slots`` feature names; 0 stands for an absent one."""
    ids = [1 + zlib.crc32(n.encode("utf-8", "surrogatepass")) % (FEATURE_ROWS - 1) for n in names[:slots]]
    return ids + [0] * (slots - len(ids))


@dataclass
class Crf:
    kinds: list[str]
    weights: np.ndarray  # (FEATURE_ROWS, tags)
    moves: np.ndarray    # (tags + 1, tags): from a tag, or from the start, to a tag

    @property
    def tags(self) -> list[str]:
        return ["O"] + [f"{p}-{k}" for k in self.kinds for p in "BI"]


def allowed(kinds: list[str]) -> np.ndarray:
    """Which moves are possible: an inside tag follows its own begin or inside tag only."""
    n = 1 + 2 * len(kinds)
    ok = np.ones((n + 1, n), bool)
    for k in range(len(kinds)):
        inside = 2 + 2 * k
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = max(len(s) for s in sequences)
    x = np.zeros((len(sequences), size, sequences[0].shape[1]), np.int32)
    for i, s in enumerate(sequences):
        x[i, :len(s)] = s
    return x, np.array([len(s) for s in sequences])


def _marginals(e: np.ndarray, t: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag probabilities by forward-backward, and the expected number of each move."""
    rows, size, n = e.shape
    a = np.zeros((rows, size, n))
    a[:, 0] = t[n] + e[:, 0]
    for i in range(1, size):
        a[:, i] = e[:, i] + np.logaddexp.reduce(a[:, i - 1, :, None] + t[None, :n], axis=1)
    b = np.zeros((rows, size, n))
    for i in range(size - 2, -1, -1):
        inner = np.logaddexp.reduce(t[None, :n] + (e[:, i + 1] + b[:, i + 1])[:, None, :], axis=2)
        b[:, i] = np.where((i + 1 < lengths)[:, None], inner, 0.0)
    z = np.logaddexp.reduce(a[np.arange(rows), lengths - 1], axis=1)
    p = np.exp(a + b - z[:, None, None])
    moves = np.zeros((n + 1, n))
    moves[n] = p[:, 0].sum(axis=0)
    for i in range(1, size):
        on = i < lengths
        pair = a[on, i - 1, :, None] + t[None, :n] + (e[on, i] + b[on, i])[:, None, :] - z[on, None, None]
        moves[:n] += np.exp(pair).sum(axis=0)
    return p, moves


def train(sequences: list[np.ndarray], tags: list[np.ndarray], kinds: list[str], rounds: int = 120,
          rate: float = 0.15, ridge: float = 0.02, longest: int = 24) -> Crf:
    """Fit by Adam on the whole table; sequences are cut to pieces of ``longest`` tokens."""
    n = 1 + 2 * len(kinds)
    gate = np.where(allowed(kinds), 0.0, _NEVER)
    if not sequences:
        return Crf(kinds, np.zeros((FEATURE_ROWS, n)), gate)
    cut = [(s[i:i + longest], t[i:i + longest]) for s, t in zip(sequences, tags, strict=True)
           for i in range(0, len(s), longest)]
    x, lengths = _padded([s for s, _ in cut])
    rows, size = x.shape[:2]
    y = np.zeros((rows, size), np.int64)
    for i, (_, t) in enumerate(cut):
        y[i, :len(t)] = t
    live = np.arange(size)[None, :] < lengths[:, None]
    used, slot = np.unique(x[live], return_inverse=True)  # only features that occur have weights
    slot = slot.reshape(-1, x.shape[2])
    w, m = np.zeros((len(used), n)), np.zeros((n + 1, n))
    state = [np.zeros_like(v) for v in (w, w, m, m)]
    at = np.flatnonzero(live.ravel())
    part = (y == OPEN).any(axis=1)  # sequences with open tags
    shut = np.where((y[part] != OPEN)[:, :, None] & (np.arange(n) != y[part][:, :, None]), _NEVER, 0.0)
    gold = np.zeros((rows, size, n))
    whole = live & ~part[:, None]
    gold[whole, y[whole]] = 1
    before = np.concatenate([np.full((rows, 1), n), y[:, :-1]], axis=1)
    gold_moves = np.zeros((n + 1, n))
    np.add.at(gold_moves, (before[whole], y[whole]), 1)
    for step in range(1, rounds + 1):
        e = np.zeros((rows * size, n))
        e[at] = w[slot].sum(axis=1)
        e = e.reshape(rows, size, n)
        t = m + gate
        p, gm = _marginals(e, t, lengths)
        gm -= gold_moves
        if part.any():
            gold[part], open_moves = _marginals(e[part] + shut, t, lengths[part])
            gm -= open_moves
        diff = (p - gold).reshape(rows * size, n)[at]
        gw = np.zeros_like(w)
        for k in range(slot.shape[1]):
            np.add.at(gw, slot[:, k], diff)
        for v, g, first, second in ((w, gw + ridge * w, 0, 1), (m, gm + ridge * m, 2, 3)):
            state[first] = 0.9 * state[first] + 0.1 * g
            state[second] = 0.99 * state[second] + 0.01 * g * g
            v -= rate * (state[first] / (1 - 0.9 ** step)) / (np.sqrt(state[second] / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros((FEATURE_ROWS, n))
    weights[used] = w
    return Crf(kinds, weights, m + gate)


def emissions(model: Crf, x: np.ndarray, block: int = 20_000) -> np.ndarray:
    """The score of every tag for each token, block by block."""
    out = np.empty((len(x), model.weights.shape[1]), np.float32)
    for at in range(0, len(x), block):
        out[at:at + block] = model.weights[x[at:at + block]].sum(axis=1)
    return out


def _together(moves: np.ndarray, e: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Viterbi over padded chains: ``e (chains, longest, tags)``."""
    rows, size, n = e.shape
    back = np.zeros((rows, size, n), np.int8)
    score = moves[n] + e[:, 0]
    for t in range(1, size):
        ways = score[:, :, None] + moves[None, :n]
        best = ways.argmax(axis=1)
        live = (t < sizes)[:, None]
        back[:, t] = np.where(live, best, np.arange(n))
        score = np.where(live, np.take_along_axis(ways, best[:, None], axis=1)[:, 0] + e[:, t], score)
    tag = score.argmax(axis=1)
    found = np.zeros((rows, size), np.int64)
    for t in range(size - 1, -1, -1):
        found[:, t] = tag
        tag = back[np.arange(rows), t, tag]
    return found


def _alone(moves: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Viterbi over one long chain, all its blocks of about the root of its length at the same time.

    The best score from each tag before a block to each of its last tags is found for
    every block first; these give the scores with which each block is entered.
    """
    n = e.shape[1]
    size = max(1, int((len(e) - 1) ** 0.5))
    blocks = -(-(len(e) - 1) // size)
    part = np.zeros((blocks, size, n))
    part.reshape(-1, n)[:len(e) - 1] = e[1:]
    live = np.arange(blocks * size).reshape(blocks, size) < len(e) - 1
    stay = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)
    across = np.broadcast_to(stay, (blocks, n, n)).copy()
    ways = [np.flatnonzero(moves[i] > _NEVER / 2) for i in range(n)]  # tags that can follow a tag
    for t in range(size):
        new = np.full_like(across, -np.inf)
        for i, to in enumerate(ways):
            if len(to) == n:
                np.maximum(new, across[:, :, i, None] + moves[i], out=new)
            else:
                new[:, :, to] = np.maximum(new[:, :, to], across[:, :, i, None] + moves[i, to])
        new += part[:, t, None]
        across = new if live[:, t].all() else np.where(live[:, t, None, None], new, across)
    enter = np.empty((blocks, n))
    score = moves[n] + e[0]
    for b in range(blocks):
        enter[b] = score
        score = (score[:, None] + across[b]).max(axis=0)
    back = np.zeros((blocks, size, n), np.int8)
    here = enter
    for t in range(size):
        ways = here[:, :, None] + moves[None, :n]
        best = ways.argmax(axis=1)
        on = live[:, t, None]
        back[:, t] = np.where(on, best, np.arange(n))
        here = np.where(on, np.take_along_axis(ways, best[:, None], axis=1)[:, 0] + part[:, t], here)
    origin = np.broadcast_to(np.arange(n), (blocks, n)).copy()  # by last tag of a block: the tag before it
    for t in range(size - 1, -1, -1):
        origin = np.take_along_axis(back[:, t].astype(np.int64), origin, axis=1)
    last = np.empty(blocks, np.int64)
    tag = int(score.argmax())
    for b in range(blocks - 1, -1, -1):
        last[b] = tag
        tag = int(origin[b, tag])
    found = np.empty((blocks, size), np.int64)
    now = last
    for t in range(size - 1, -1, -1):
        found[:, t] = now
        now = back[np.arange(blocks), t, now].astype(np.int64)
    return np.concatenate([[tag], found.ravel()[:len(e) - 1]])


#: Chains of more tokens than this are decoded alone.
LONG_CHAIN = 600


def decode_chains(model: Crf, scores: np.ndarray, sizes: np.ndarray, batch_tokens: int = 100_000) -> np.ndarray:
    """The best tags of all tokens from their ``emissions``; ``sizes`` are the lengths of the chains that follow one another."""
    out = np.zeros(len(scores), np.int64)
    sizes = np.asarray(sizes, np.int64)
    first = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        long = int(sizes[order[at]])
        if long > LONG_CHAIN:
            k = first[order[at]]
            out[k:k + long] = _alone(model.moves, scores[k:k + long])
            at += 1
            continue
        upto = at + max(1, batch_tokens // long)  # chains get longer: fewer may fit
        chunk = order[at:upto]
        chunk = chunk[sizes[chunk] <= min(LONG_CHAIN, max(8, 2 * long))]
        own = sizes[chunk]
        place = np.arange(own.max())[None, :] < own[:, None]
        rows = np.repeat(first[chunk], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        e = np.zeros((*place.shape, model.weights.shape[1]))
        e[place] = scores[rows]
        out[rows] = _together(model.moves, e, own)[place]
        at += len(chunk)
    return out


def decode(model: Crf, sequences: list[np.ndarray], batch_tokens: int = 100_000) -> list[np.ndarray]:
    """The best tag sequence of each sequence."""
    if not any(len(s) for s in sequences):
        return [np.zeros(0, np.int64) for _ in sequences]
    sizes = [len(s) for s in sequences]
    tags = decode_chains(model, emissions(model, np.concatenate([s for s in sequences if len(s)])), np.array(sizes), batch_tokens)
    return np.split(tags, np.cumsum(sizes)[:-1])


def tagged_spans(tags: np.ndarray, kinds: list[str]) -> list[tuple[str, int, int]]:
    """``(kind, first token, last token)`` of each tagged entity."""
    out, tags = [], tags.tolist()
    i = 0
    while i < len(tags):
        if tags[i] == 0:
            i += 1
            continue
        kind, j = (tags[i] - 1) // 2, i + 1
        while j < len(tags) and tags[j] == 2 + 2 * kind:
            j += 1
        out.append((kinds[kind], i, j - 1))
        i = j
    return out
