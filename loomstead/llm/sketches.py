"""Words, shingles and bit fingerprints of texts, computed a batch at a time."""

from __future__ import annotations

import re

import numpy as np

# fixed values: each Chinese or Japanese character is a word of its own
CJK = "々-〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{CJK}]|[^\W_{CJK}]+")
_WHOLE_RUN = re.compile(r"[^\W_]+")

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits; each Chinese or Japanese character is a word. Null has none."""
    return _WORD.findall((text or "").lower())


def runs(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits, whatever the script."""
    return _WHOLE_RUN.findall((text or "").lower())


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Vocabulary:
    """64-bit hashes of words, kept between batches; forgotten when there are too many, so memory is bounded."""

    def __init__(self, most: int = 400_000):
        import xxhash

        self.hash, self.seen, self.most = xxhash.xxh64_intdigest, {}, most

    def ids(self, tokens: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > self.most:
            seen.clear()
        h = self.hash
        out = np.empty(len(tokens), dtype=np.uint64)
        for i, t in enumerate(tokens):
            v = seen.get(t)
            if v is None:
                v = seen[t] = h(t)
            out[i] = v
        return out


def shingle_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the distinct runs of n words, sorted; fewer than n words make one run of all."""
    if len(ids) == 0:
        return np.empty(0, dtype=np.uint64)
    n = min(n, len(ids))
    h = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for k in range(n):
        h = mix(h + ids[k : len(ids) - n + 1 + k] + np.uint64(k + 1))
    return np.unique(h)


def min_sketch(sets: list[np.ndarray], n: int, bits: int, seed: int = 11, block: int = 64) -> np.ndarray:
    """Min-hash fingerprints, a row of ``n`` symbols of up to 8 ``bits`` per set: two sets agree in a symbol with chance J + (1 - J) / 2^bits at Jaccard J."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**32, size=n, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, size=n, dtype=np.uint32)
    out = np.zeros((len(sets), n), dtype=np.uint8)
    for lo in range(0, len(sets), block):
        part = sets[lo : lo + block]
        flat = np.concatenate(part)
        x = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in part[:-1]])
        y = np.empty_like(x)
        least = np.empty((n, len(part)), dtype=np.uint32)
        for k in range(n):
            np.bitwise_xor(x, b[k], out=y)
            np.multiply(y, a[k], out=y)
            np.minimum.reduceat(y, starts, out=least[k])
        least = least ^ (least >> np.uint32(15))
        out[lo : lo + len(part)] = ((least * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)).astype(np.uint8).T
    return out


def segments(symbols: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The symbols of ``bits`` bits as whole numbers of ``width`` symbols each."""
    n, total = symbols.shape
    return (symbols.reshape(n, total // width, width).astype(np.int64) << (np.arange(width) * bits)).sum(axis=2)
