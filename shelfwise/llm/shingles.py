"""Word shingles of many texts at once, as hashed multisets in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_OTHER = np.arange(256) < 128
_OTHER[[*range(48, 58), *range(97, 123)]] = False


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them well."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    """Powers 0 ... n - 1 of an odd number, modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, _ODD
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, (step * step) & (2**64 - 1)
    return out


def word_hashes(texts: list[str | None], folded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after the other, and each text's number of words.

    Words are runs of other than ASCII white space; if ``folded``, of lower-case
    ASCII letters, digits and characters beyond ASCII.

    Works on the joined bytes: a word's bytes, weighted by powers of an odd
    number within the word, are a difference of prefix sums modulo 2 ** 64.
    """
    parts = [((t or "").lower() if folded else t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]) or b" ", np.uint8)
    blank = (_OTHER if folded else _SPACE)[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate(([0], edge))
    if not blank[-1]:
        edge = np.concatenate((edge, [len(data)]))
    starts, ends = edge[0::2], edge[1::2]
    inside = ~blank
    sizes = ends - starts
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    powers = _powers(int(sizes.max()) if len(sizes) else 1)
    weighted = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)))
    last = np.cumsum(sizes)
    hashes = mix64((total[last] - total[last - sizes]) + sizes.astype(np.uint64) * _GOLD)
    text_ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, text_ends)))) if len(parts) else np.zeros(0, int)
    return hashes, counts


def shingles(texts: list[str | None], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, in order, and each text's number of them.

    A text with fewer words has one shingle of all its words; one without words
    has none.
    """
    hashes, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    left = counts[owner] - (np.arange(len(hashes)) - first[owner])  # words from here to the text's end
    value = np.zeros(len(hashes), np.uint64)
    for k in range(n):
        nxt = np.zeros_like(hashes)
        nxt[: len(hashes) - k] = hashes[k:]
        value = np.where(left > k, mix64(value * _ODD_U + nxt + _GOLD), value)
    short = counts[owner] < n
    keep = np.where(short, left == counts[owner], left >= n)
    return value[keep], np.bincount(owner[keep], minlength=len(counts)).astype(np.int64)


_ODD_U = np.uint64(_ODD)


def bags(texts: list[str | None], n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: (text's number, shingle, count), sorted."""
    value, counts = shingles(texts, n)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], value[at], np.diff(np.append(at, len(value)))
