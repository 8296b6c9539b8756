"""Held-out passages in training documents: suffix arrays over shards of the documents, searched for every test suffix.

A shard's suffix array holds the suffixes of all its words, whole and in order up to the end of their document. A test
suffix narrows the range of suffixes that begin like it, word by word and by binary search, until none is left; what drops
out at a word matches up to there. Matches that could begin a word earlier are left out, so what remains are the longest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.functions.text import clean_value
from loomstead.llm.sketches import runs

#: Words of test items searched in one pass (about 20 MB on each worker); more items make more passes over the documents, none is left out.
BLOCK_WORDS = 4_000_000
#: Words of documents in one suffix array; a longer document is an array of its own.
SHARD_WORDS = 400_000
#: Locations looked at together.
STEP = 1 << 20
MATCHES = "doc_id long, item_id long, n_words long, at_word long"


class Items:
    """Test items as one row of word numbers with an end after each item, -1."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        numbers: dict[str, int] = {}
        flat = [x for _, w in items for x in (*(numbers.setdefault(y, len(numbers)) for y in w), -1)]
        self.words, self.tokens = list(numbers), np.array(flat, dtype=np.int32)
        self.ids = np.array([i for i, _ in items], dtype=np.int64)
        sizes = np.array([len(w) for _, w in items], dtype=np.int64)
        self.ends = np.cumsum(sizes + 1) - 1

    def suffixes(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, number of the item) of the suffixes of ``least`` words or more."""
        at = np.arange(len(self.tokens))
        item = np.searchsorted(self.ends, at)
        long = self.ends[item] - at >= least
        return at[long], item[long]


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling; only what is still alike is sorted again.

    Each document must end in a number of its own, below those of all words, so no comparison runs past it.
    """
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    key, at, rank, width = tokens[order].astype(np.int64), np.arange(n), np.empty(n, dtype=np.int64), 1
    while len(at):
        # places whose key differs from the one before begin a group, and a group's first place is its rank
        new = np.append(True, key[1:] != key[:-1])
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        alone = new & np.append(new[1:], True)
        at = at[~alone]
        key = rank[order[at]] * n + rank[np.minimum(order[at] + width, n - 1)]
        again = np.argsort(key, kind="stable")
        order[at], key = order[at][again], key[again]
        width *= 2
    return order


class Shard:
    """The suffix array of some documents (doc_id, words)."""

    def __init__(self, docs: list[tuple[int, list[str]]]):
        self.ids = np.array([i for i, _ in docs], dtype=np.int64)
        self.numbers: dict[str, int] = {}
        add, base = self.numbers.setdefault, len(docs)
        flat = [x for k, (_, w) in enumerate(docs) for x in (*[add(y, base + len(self.numbers)) for y in w], k)]
        self.tokens = np.array(flat, dtype=np.int32)
        self.starts = np.cumsum([0] + [len(w) + 1 for _, w in docs[:-1]])
        self.array = suffix_array(self.tokens)

    def _bound(self, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, depth: int, after: bool) -> np.ndarray:
        """First place of each range whose suffix has at ``depth`` a word not before ``word`` (after it, with ``after``)."""
        lo, hi = lo.copy(), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            there = self.tokens[self.array[mid] + depth]
            before = there <= word[open_] if after else there < word[open_]
            lo[open_[before]], hi[open_[~before]] = mid[before] + 1, mid[~before]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def search(self, items: Items, least: int) -> pd.DataFrame:
        """The longest verbatim match of each document and item with at least ``least`` words, and the word it starts at."""
        own = np.array([self.numbers.get(w, -1) for w in items.words] + [-1], dtype=np.int64)
        test = own[items.tokens]  # the end of an item, -1, is in no document, as an unknown word
        start, item = items.suffixes(least)
        lo, hi = np.zeros(len(start), dtype=np.int64), np.full(len(start), len(self.array))
        found, depth = [], 0
        while len(start):
            word = test[start + depth]
            left, right = self._bound(lo, hi, word, depth, False), self._bound(lo, hi, word, depth, True)
            if depth >= least:
                for a, b in ((lo, left), (right, hi)):
                    found += self._dropped(a, b, test, start, item, depth)
            on = left < right
            start, item, lo, hi, depth = start[on], item[on], left[on], right[on], depth + 1
        best = pd.concat([pd.DataFrame(columns=["doc", "item", "n", "at"], dtype=np.int64), *found])
        best = best.sort_values(["n", "at"], ascending=[False, True]).drop_duplicates(["doc", "item"])
        doc = best["doc"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"doc_id": self.ids[doc], "item_id": items.ids[best["item"].to_numpy(dtype=np.int64)], "n_words": best["n"].to_numpy(dtype=np.int64), "at_word": best["at"].to_numpy(dtype=np.int64) - self.starts[doc]})

    def _dropped(self, lo: np.ndarray, hi: np.ndarray, test: np.ndarray, start: np.ndarray, item: np.ndarray, depth: int) -> Iterator[pd.DataFrame]:
        """The locations of the ranges, in steps of bounded size, that match from no earlier word."""
        some = np.flatnonzero(lo < hi)
        size = (hi - lo)[some]
        before = np.cumsum(size) - size
        for first in range(0, int(size.sum()), STEP):
            place = np.arange(first, min(first + STEP, int(size.sum())))
            k = np.searchsorted(before, place, "right") - 1
            at, s = self.array[lo[some[k]] + place - before[k]], start[some[k]]
            earlier = (at > 0) & (s > 0) & (self.tokens[at - 1] == test[s - 1])
            at, i = at[~earlier], item[some[k]][~earlier]
            doc = np.searchsorted(self.starts, at, "right") - 1
            yield pd.DataFrame({"doc": doc, "item": i, "n": depth, "at": at}).sort_values("at").drop_duplicates(["doc", "item"])


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Blocks of items, each of at most BLOCK_WORDS words (or one item), read one after the other."""
    block, size = [], 0
    for row in items.where("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        w = runs(clean_value(row["text"]))
        if block and size + len(w) > BLOCK_WORDS:
            yield Items(block)
            block, size = [], 0
        block.append((row["item_id"], w))
        size += len(w)
    if block:
        yield Items(block)


def find_leaks(documents: DataFrame, items: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, item_id, n_words, at_word): documents that hold at least ``least`` consecutive words of an item.

    Both are cleaned first; words are lower-cased runs of letters and digits. Null or empty texts and shorter items match
    nothing, rows without an id are ignored, repeated rows count once, an empty table gives no rows. The longest match of
    each pair is reported, of equal ones the first. The driver holds one block of items at a time.
    """
    spark = documents.sparkSession

    def run(shared):
        def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            docs, size = [], 0
            for pdf in batches:
                for i, text in zip(pdf["doc_id"], pdf["text"]):
                    w = runs(clean_value(text))
                    if len(w) >= least:
                        docs.append((i, w))
                        size += len(w)
                    if size >= SHARD_WORDS:
                        yield Shard(docs).search(shared.value, least)
                        docs, size = [], 0
            if docs:
                yield Shard(docs).search(shared.value, least)

        return shards

    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    out = None
    for block in item_blocks(items):
        part = docs.mapInPandas(run(spark.sparkContext.broadcast(block)), MATCHES)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], MATCHES)
    best = F.max(F.struct("n_words", (-F.col("at_word")).alias("before"))).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("best.n_words").alias("n_words"), (-F.col("best.before")).alias("at_word"))


def without_leaks(documents: DataFrame, leaks: DataFrame) -> DataFrame:
    """The documents that hold no passage of an item."""
    return documents.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")
