"""BagMinHash signatures: equal components with the probability of the weighted Jaccard similarity.

A shingle with count w covers the weights (0, w].  The weights are cut at 1, 2,
4, 8 ...; every piece of every shingle has a Poisson process of points of its
own, with a rate of the piece's width, whose times and targets depend on
nothing but shingle and piece.  A piece that w covers in part is split in
halves down to whole weights: each point goes to one half by a hash, so that
texts with other counts see the same points.  A point hits one component of the
signature; a component is the earliest point that hits it.  Two texts agree in
a component exactly if the earliest point lies in the weights both cover.

Points come in order of time, so only those before a horizon are made.  The
horizon is what the text's total weight needs to hit all components with high
probability; for texts where it was too short it is doubled.
"""

from __future__ import annotations

import math

import numpy as np

from shelfwise.llm.shingles import bags, mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Above 0, at most 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def _earliest(owner, key, count, horizon, size, best):
    """Lower ``best`` (flat, one row of ``size`` per text) to the times of the points before each text's horizon.

    Times are kept as the bits of the double, which order like the times and
    tell points apart.
    """
    low = 0
    while len(owner):
        high = 1 if low == 0 else low * 2
        width = high - low
        who, most, t = owner, np.minimum(count, high), np.zeros(len(owner))
        state = mix64(key + np.uint64(high * int(_STEP) & (2**64 - 1)))
        while len(who):
            state = mix64(state + _STEP)
            t = t - np.log(_uniform(state)) / width
            live = t <= horizon[who]
            who, state, most, t = who[live], state[live], most[live], t[live]
            hit = mix64(state ^ np.uint64(0xD6E8FEB86659FD93))
            slot = who * size + (hit % np.uint64(size)).astype(np.int64)
            at = t
            if width > 1:  # down to whole weights: the choices of halves are bits of the hash
                kept = low + (mix64(hit) % np.uint64(width)).astype(np.int64) < most
                slot, at = slot[kept], t[kept]
            np.minimum.at(best, slot, at.view(np.uint64))
        more = count > high
        owner, key, count = owner[more], key[more], count[more]
        low = high


def signatures(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (one row of ``size`` 32-bit values per text) and total weights.

    A text without words has weight 0 and a row of zeros.
    """
    owner, key, count = bags(texts)
    weight = np.bincount(owner, count, len(texts)).astype(np.int64)
    out = np.zeros((len(texts), size), np.uint32)
    todo = weight > 0
    need = size * (math.log(size) + 4.0)
    factor = np.ones(len(texts))
    never = np.uint64(2**64 - 1)
    best = np.full(len(texts) * size, never)
    while todo.any():
        horizon = np.where(todo, factor * need / np.maximum(weight, 1), -1.0)
        mine = todo[owner]
        _earliest(owner[mine], key[mine], count[mine], horizon, size, best)
        full = (best.reshape(-1, size) != never).all(1)
        done = todo & full
        out[done] = (mix64(best.reshape(-1, size)[done]) >> np.uint64(32)).astype(np.uint32)
        factor[todo & ~full] *= 2.0
        todo &= ~full
    return out, weight
