"""Interpolated Kneser-Ney character models of several languages in one set of sorted arrays.

An n-gram's key packs the numbers of its characters, so equal keys are equal n-grams. For every n-gram seen in any language
the arrays hold each language's interpolated probability and, as a context, its back-off weight; a score needs one search
per order and position for all languages together.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

#: Order, bits of a character's number (ORDER of them make a key of one long), discount.
ORDER, BITS, DISCOUNT = 4, 15, 0.75
#: Different letters the numbers leave room for, more than a bounded training sample of any living scripts holds. Those
#: beyond, the rarest, would share the number of unknown letters; no text is left out for them.
MOST_CHARS = (1 << BITS) - 3
BLANK, OTHER = 1, 2
_RUN = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower-cased letters with single blanks for all else, and a blank at both ends."""
    return f" {_RUN.sub(' ', text.lower()).strip()} "


def grams(chars: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    """Keys of the n-grams that end at each position; those that reach before the start of their sentence hold zeros."""
    key = np.zeros(len(chars), dtype=np.int64)
    for k in range(n):
        key[k:] |= chars[: len(chars) - k] << (BITS * k)
    ends = np.append(starts[1:], len(chars))
    for k in range(n - 1):
        at = (starts + k)[starts + k < ends]
        key[at] &= (1 << (BITS * (k + 1))) - 1
    return key


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 if it is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class CharModels:
    def __init__(self, texts: dict[str, Sequence[str]]):
        """``texts`` gives the training sentences of each language; there must be one with a letter for each."""
        self.languages = sorted(texts)
        parts = {l: list(map(plain, texts[l])) for l in self.languages}
        streams = {l: "".join(parts[l]) for l in self.languages}
        seen: dict[str, int] = {}
        for s in streams.values():
            for c in s:
                seen[c] = seen.get(c, 0) + 1
        seen.pop(" ", None)
        common = sorted(seen, key=lambda c: (-seen[c], c))[:MOST_CHARS]
        self.numbers = {" ": BLANK} | {c: i + 3 for i, c in enumerate(common)}
        coded = [(self.encode(streams[l]), starts_of(np.array([len(x) for x in parts[l]], dtype=np.int64))) for l in self.languages]
        self.keys: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.logb: list[np.ndarray] = []
        counts = []
        for n in range(1, ORDER + 1):
            # whole n-grams within one sentence
            per = [np.unique(g[g >> (BITS * (n - 1)) > 0], return_counts=True) for g in (grams(c, n, at) for c, at in coded)]
            counts.append(per)
            self.keys.append(np.unique(np.concatenate([k for k, _ in per])))
        nl = len(self.languages)
        lower = np.full((1, nl), 1.0 / (len(self.numbers) + 1))  # one more for all unknown characters
        for n in range(1, ORDER + 1):
            keys = self.keys[n - 1]
            contexts = self.keys[n - 2] if n > 1 else np.zeros(1, dtype=np.int64)
            p, weight = np.zeros((len(keys), nl)), np.ones((len(contexts), nl))
            context_at = find(contexts, keys >> BITS) if n > 1 else np.zeros(len(keys), dtype=np.int64)
            lower_at = find(self.keys[n - 2], keys & ((1 << (BITS * (n - 1))) - 1)) if n > 1 else np.zeros(len(keys), dtype=np.int64)
            for l in range(nl):
                k, c = counts[n - 1][l]
                if n < ORDER:  # continuation counts: how many different characters come before
                    longer = counts[n][l][0]
                    tail, c2 = np.unique(longer & ((1 << (BITS * n)) - 1), return_counts=True)
                    at = find(tail, k)
                    c = np.where(at >= 0, c2[at], 1)
                at, ctx = find(keys, k), None
                ctx = context_at[at]
                total = np.bincount(ctx, weights=c, minlength=len(contexts))
                kinds = np.bincount(ctx, minlength=len(contexts))
                known = total > 0
                weight[known, l] = DISCOUNT * kinds[known] / total[known]
                p[at, l] = (c - DISCOUNT) / total[ctx]
            p += weight[context_at] * lower[lower_at]
            if n == 1:
                self.unseen = np.log(weight[0] * lower[0]).astype(np.float32)
            else:
                self.logb.append(np.log(weight).astype(np.float32))
            self.logp.append(np.log(p).astype(np.float32))
            lower = p

    def encode(self, text: str) -> np.ndarray:
        get = self.numbers.get
        return np.fromiter((get(c, OTHER) for c in text), dtype=np.int64, count=len(text))

    def scores(self, sentences: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability per language of each plain sentence, and its length in characters.

        A sentence's score is its own: no context reaches over its start, whatever is scored with it.
        """
        sizes = np.array([len(s) for s in sentences], dtype=np.int64)
        total = np.zeros((len(sentences), len(self.languages)))
        lo = 0
        while lo < len(sentences):  # blocks that stay in the cache
            hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), 60_000)))
            chars, starts = self.encode("".join(sentences[lo:hi])), starts_of(sizes[lo:hi])
            at = find(self.keys[0], chars)
            logp = np.where((at >= 0)[:, None], self.logp[0][at], self.unseen)
            for n in range(2, ORDER + 1):
                now = find(self.keys[n - 1], grams(chars, n, starts))
                before = np.concatenate([[-1], at[:-1]])
                before[starts] = -1
                back = np.where((before >= 0)[:, None], self.logb[n - 2][before], np.float32(0))
                logp = np.where((now >= 0)[:, None], self.logp[n - 1][now], logp + back)
                at = now
            total[lo:hi] = np.add.reduceat(logp.astype(np.float64), starts, axis=0)
            lo = hi
        return total, sizes
