"""Byte-level BPE of a public vocabulary: ranked merges as folds over byte arrays, in Spark's higher-order functions.

A rank is a piece's id. Words that are pieces themselves get their id at once, by a literal map from pieces; of all others
each distinct word is folded once and joined back to its places. A fold's state are the ids of the parts and the ranks of
their neighbours' merges, looked up by pairs of ids in a second literal map. Both maps are arrays of small maps, an entry's
place being a hash of its key, so that a lookup reads a handful of entries instead of the whole vocabulary. The files are
read by the driver alone.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.operators.joins import hot_keys, join_unique
from loomstead.sources.shared import Cuts

#: Where the rank files are; LOOMSTEAD_TOKENIZERS overrides it.
FOLDER = os.environ.get("LOOMSTEAD_TOKENIZERS", "/opt/tokenizers")
# fixed values: the pattern that splits text before the merges, with Unicode white space
PATTERN = r"""(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKETS = 16384
#: Words over so many bytes are merged with a heap over a linked list: a fold copies its arrays at each merge, so its time
#: grows with the square of the length (README has figures). Both give the same ids.
LONG_BYTES = 400


@functools.lru_cache(maxsize=4)
def read_ranks(name: str, folder: str = FOLDER) -> dict[bytes, int]:
    """Rank of each piece."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[bytes]:
    """The pieces of a word after all merges (of a rank under ``below``), the lowest rank first, of equal ones the leftmost."""
    parts = [word[i : i + 1] for i in range(len(word))]
    nxt, prev = [*range(1, len(parts)), -1], [-1, *range(len(parts) - 1)]

    def entry(i: int):
        whole = parts[i] + parts[nxt[i]]
        rank = ranks.get(whole)
        return None if rank is None or (below is not None and rank >= below) else (rank, i, whole)

    heap = [e for i in range(len(parts) - 1) if (e := entry(i))]
    heapq.heapify(heap)
    while heap:
        _, i, whole = heapq.heappop(heap)
        j = nxt[i]
        if not parts[i] or j < 0 or parts[i] + parts[j] != whole:  # one of the two was merged since
            continue
        parts[i], parts[j], nxt[i] = whole, b"", nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        for k in (prev[i], i):
            if k >= 0 and nxt[k] >= 0 and (e := entry(k)):
                heapq.heappush(heap, e)
    return [x for x in parts if x]


@functools.lru_cache(maxsize=4)
def merge_pairs(name: str, folder: str = FOLDER) -> dict[tuple[int, int], int]:
    """The two parts that are merged into each piece of two bytes or more, by their ids.

    While a piece's bytes stand between two borders that hold, they are merged as if they stood alone, so only the two
    parts that lower merges leave of it can ever meet. Of a piece that they leave in more parts, all splits are taken.
    """
    ranks, out = read_ranks(name, folder), {}
    for piece, rank in ranks.items():
        if len(piece) > 1:
            parts = merge(piece, ranks, rank)
            splits = [parts] if len(parts) == 2 else [(piece[:i], piece[i:]) for i in range(1, len(piece))]
            out |= {(ranks[x], ranks[y]): rank for x, y in splits if x in ranks and y in ranks}
    return out


def _literal(entries: list[tuple[int, str, int]]) -> Column:
    """The array of maps of (place, key, value), which Catalyst folds once. An expression should hold it once: see ``let``."""
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for place, key, value in entries:
        buckets[place % BUCKETS][key] = value
    return F.lit(json.dumps(buckets, separators=(",", ":"), ensure_ascii=False))


def piece_map(ranks: dict[bytes, int]) -> Column:
    """Ids of the pieces that are text."""
    import xxhash

    text = []
    for piece, rank in ranks.items():
        try:
            text.append((xxhash.xxh64_intdigest(piece, seed=42) - (xxhash.xxh64_intdigest(piece, seed=42) >> 63 << 64), piece.decode(), rank))
        except UnicodeDecodeError:
            pass
    return F.from_json(_literal(text), "array<map<string,int>>")


def piece_id(table: Column, word: Column) -> Column:
    """The id of a word that is a piece, else null."""
    return F.try_element_at(F.get(table, F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")), word)


def pair_map(pairs: dict[tuple[int, int], int]) -> Column:
    return F.from_json(_literal([(31 * a + b, str((a << 32) + b), r) for (a, b), r in pairs.items()]), "array<map<string,int>>").cast("array<map<bigint,int>>")


def pair_rank(table: Column, left: Column, right: Column) -> Column:
    """The rank of the piece that two parts make, null if they make none."""
    bucket = F.get(table, F.pmod(left * 31 + right, F.lit(BUCKETS)))
    return F.try_element_at(bucket, left.cast("long") * F.lit(1 << 32) + right)


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def byte_ids(word: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of the single bytes of a word."""
    table = F.from_json(F.lit(json.dumps([ranks[bytes([i])] for i in range(256)])), "array<int>")
    digit = lambda c: F.ascii(c) - F.when(F.ascii(c) > 64, 55).otherwise(48)
    number = lambda two: digit(two) * 16 + digit(F.substr(two, F.lit(2), F.lit(1)))
    return let(table, lambda t: F.transform(F.regexp_extract_all(F.hex(word), F.lit("(..)"), F.lit(1)), lambda two: F.get(t, number(two))))


def merge_fold(table: Column, parts: Column) -> Column:
    """The ids of one word after all merges, from the ids of its bytes: the lowest rank first, of equal ones the leftmost."""

    def start(p: Column) -> Column:
        ranks = F.transform(p, lambda x, i: F.when(i + 1 < F.size(p), pair_rank(table, x, F.get(p, i + 1))))
        return F.struct(p.alias("parts"), ranks.alias("ranks"))

    def merged(state: Column, low: Column, at: Column) -> Column:
        # parts at and at + 1, counted from 1, become low
        parts, ranks, n = state["parts"], state["ranks"], F.size(state["parts"])
        before = F.when(at > 1, pair_rank(table, F.get(parts, at - 2), low))
        after = F.when(at + 1 < n, pair_rank(table, low, F.get(parts, at + 1)))
        left = F.when(at > 2, F.slice(ranks, F.lit(1), at - 2)).otherwise(F.slice(ranks, 1, 0))
        middle = F.when(at > 1, F.array(before, after)).otherwise(F.array(after))
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), at - 1), F.array(low), F.slice(parts, at + 2, n)).alias("parts"),
            F.concat(left, middle, F.slice(ranks, at + 2, n)).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        return let(F.array_min(state["ranks"]), lambda low: F.when(low.isNull(), state).otherwise(let(F.array_position(state["ranks"], low).cast("int"), lambda at: merged(state, low, at))))

    return let(parts, lambda p: F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1))), start(p), step, lambda s: s["parts"]))


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def encode_words(words: DataFrame, name: str, folder: str) -> DataFrame:
    """(word, ids) for distinct words."""
    ranks = read_ranks(name, folder)
    ids = let(pair_map(merge_pairs(name, folder)), lambda table: merge_fold(table, byte_ids(F.col("word"), ranks)))
    short = words.where(F.octet_length("word") <= LONG_BYTES).select("word", ids.alias("ids"))
    shared = words.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary

    def long_ones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = shared.value
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"], "ids": [[r[p] for p in merge(w.encode(), r)] for w in pdf["word"]]})

    return short.unionByName(words.where(F.octet_length("word") > LONG_BYTES).select("word").mapInPandas(long_ones, "word string, ids array<int>"))


def encode(docs: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """(doc_id, ids) of docs (doc_id, text), without special tokens; their strings in a text are ordinary text.

    Null and empty texts have an empty list. doc_id must be unique. Other columns are ignored; an empty table gives no rows.
    """
    cuts = Cuts(docs.sparkSession, "tokens")
    split = docs.select("doc_id", split_words(F.coalesce("text", F.lit(""))).alias("words"))
    split = split.withColumn("ids", let(piece_map(read_ranks(name, folder)), lambda t: F.transform("words", lambda w: piece_id(t, w))))
    open_ = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda x: F.get(F.col("ids"), x["pos"]).isNull())
    split = cuts.cut(split.select("doc_id", "ids", open_.alias("open")), "split")
    places = split.select("doc_id", F.explode("open").alias("x")).select("doc_id", "x.pos", "x.word")
    # long words travel as a digest
    key = F.when(F.length("word") > 32, F.sha2("word", 256)).otherwise(F.col("word"))
    counted = cuts.cut(places.groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("key", key), "words")
    hot = hot_keys(counted, ["key"], "n")
    # folding is the work: spread the distinct words evenly
    encoded = cuts.cut(encode_words(counted.select("word").repartition(docs.sparkSession.sparkContext.defaultParallelism * 4), name, folder), "encoded")
    found = join_unique(places.select("doc_id", "pos", key.alias("key")), encoded.select(key.alias("key"), F.col("ids").alias("merged")), ["key"], "inner", hot)
    folded = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "merged"))).alias("folded"))
    none = F.array().cast("array<struct<pos:int,merged:array<int>>>")
    whole = split.select("doc_id", "ids").join(folded, "doc_id", "left").select("doc_id", "ids", F.coalesce("folded", none).alias("folded"))
    # from the place after one folded word up to the next, and what follows the last
    end = lambda i: F.coalesce(F.get(F.col("folded"), i - 1)["pos"] + 1, F.lit(0))
    parts = F.transform("folded", lambda x, i: F.concat(F.slice("ids", end(i) + 1, x["pos"] - end(i)), x["merged"]))
    rest = F.slice("ids", end(F.size("folded")) + 1, F.size("ids"))
    return whole.select("doc_id", F.concat(F.flatten(parts), rest).alias("ids"))


def decode(encoded: DataFrame, name: str = "byte_bpe_50k", folder: str = FOLDER) -> DataFrame:
    """Add ``decoded``: the binary pieces of ``ids``, concatenated, as text. Null ids give null; ids of no piece are an error."""
    ranks = read_ranks(name, folder)
    pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
    for p, r in ranks.items():
        pieces[r] = p.hex().upper()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    one = lambda t: lambda i: F.coalesce(F.get(t, i), F.raise_error(F.lit("an id of no piece")))
    return encoded.withColumn("decoded", F.unhex(F.array_join(let(table, lambda t: F.transform("ids", one(t))), "")).cast("string"))
