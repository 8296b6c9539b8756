"""Near-duplicate texts by multi-index hashing: Hamming balls within fingerprint segments, then complete distances.

Texts with equal shingle sets form a class; only one fingerprint per class takes part. A fingerprint has segments of a few
symbols (a byte of a min-hash of the shingles each) and CHECK_BITS one-bit min-hashes more; how many there are, and the
largest distances, follow from the similarity (``Plan``). Each segment is filed twice, by its upper and by its lower half.
Two segments at most one symbol apart agree in one half, so within a bucket of one half the ball of radius 1 around the
other half is looked up; nothing but two entries per segment is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.llm.components import hash_to_min
from loomstead.llm.sketches import Vocabulary, min_sketch, segments, shingle_hashes, words
from loomstead.sources.shared import Cuts

SYMBOL_BITS, CHECK_BITS = 8, 128
SYMBOL = (1 << SYMBOL_BITS) - 1
#: Chance that a pair at exactly the stated similarity meets in no segment, and that it exceeds a largest distance.
MISS, TAIL = 3e-4, 1e-4
#: Longer segments are preferred, as unlike texts meet in fewer of them, while so many segments are enough.
WIDTHS, MOST_SEGMENTS = (6, 4, 2), 64
BLOCK = 1 << 20
#: Buckets with more entries than SPLIT, and than 1/HOT_SHARE of the classes, are split over tasks in blocks of SPLIT.
SPLIT, HOT_SHARE, TRACKED = 50_000, 64, 1 << 14


def _largest(n: int, share: float) -> int:
    """The least distance that ``n`` positions, each different with chance ``share``, exceed with a chance of TAIL or less."""
    above, k = 1.0, -1
    while above > TAIL and k < n:
        k += 1
        above -= math.comb(n, k) * share**k * (1 - share) ** (n - k)
    return k


@dataclass(frozen=True)
class Plan:
    """What the index needs so that pairs of a Jaccard similarity are found, whatever their texts differ in."""

    segments: int
    width: int  # symbols of a segment
    check: int  # largest distances of a pair that is verified: check bits, symbols
    whole: int

    @property
    def half(self) -> int:
        """Bits of half a segment."""
        return self.width * SYMBOL_BITS // 2

    @property
    def symbols(self) -> int:
        return self.segments * self.width

    @staticmethod
    def of(similarity: float) -> Plan:
        if not 0 < similarity <= 1:
            raise ValueError("the similarity is above 0 and at most 1")
        same = similarity + (1 - similarity) / (1 << SYMBOL_BITS)
        for width in WIDTHS:
            meet = same**width + width * (1 - same) * same ** (width - 1)
            segments = 1 if meet >= 1 else max(1, math.ceil(math.log(MISS) / math.log1p(-meet)))
            if segments <= MOST_SEGMENTS:
                break
        return Plan(segments, width, _largest(CHECK_BITS, (1 - similarity) / 2), _largest(segments * width, 1 - same))


def fingerprints(texts: DataFrame, shingle: int, least_words: int, plan: Plan) -> DataFrame:
    """(id, set_key, segs, c1, c2) of the texts (id, text) with at least ``least_words`` words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        vocabulary = Vocabulary()
        for whole in batches:
            for lo in range(0, len(whole), 2048):
                pdf = whole.iloc[lo : lo + 2048]
                keep, keys, sets = [], [], []
                for i, text in zip(pdf["id"], pdf["text"]):
                    w = words(text)
                    if len(w) < least_words:
                        continue
                    ids = vocabulary.ids(w)
                    keep.append(i)
                    sets.append(shingle_hashes(ids, shingle))
                    keys.append(xxhash.xxh3_128_digest(sets[-1].tobytes()))
                if not keep:
                    continue
                sketch = min_sketch(sets, plan.symbols + CHECK_BITS, SYMBOL_BITS)
                check = np.packbits(sketch[:, plan.symbols :] >> (SYMBOL_BITS - 1), axis=1).view(np.int64)
                yield pd.DataFrame({"id": keep, "set_key": keys, "segs": list(segments(sketch[:, : plan.symbols], plan.width, SYMBOL_BITS)), "c1": check[:, 0], "c2": check[:, 1]})

    return texts.select("id", "text").where("id is not null and text is not null").mapInPandas(run, "id long, set_key binary, segs array<long>, c1 long, c2 long")


def entries(classes: DataFrame, plan: Plan) -> DataFrame:
    """Two entries per segment: (k, id, c1, c2), where k holds half, segment number, the half to match and the other half."""
    s = classes.select("id", "c1", "c2", F.posexplode("segs").alias("pos", "seg"))
    low, high = F.col("seg").bitwiseAND((1 << plan.half) - 1), F.shiftright("seg", plan.half)
    key = lambda half, match, rest: ((F.lit(half * plan.segments) + F.col("pos")).cast("long") * (1 << 2 * plan.half)) + match * (1 << plan.half) + rest
    return s.select(F.explode(F.array(key(0, high, low), key(1, low, high))).alias("k"), "id", "c1", "c2")


def _ranges(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each ``at`` with every position of its range, in blocks of bounded size."""
    count = right - left
    some = np.flatnonzero(count)
    left, count, at = left[some], count[some], at[some]
    ends = np.cumsum(count)
    start, done = 0, 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        n = count[start:stop]
        first = np.repeat(at[start:stop], n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield first, np.repeat(left[start:stop], n) + offset
        done, start = int(ends[stop - 1]), stop


def _bucket_pairs(k: np.ndarray, ids: np.ndarray, c: np.ndarray, plan: Plan) -> Iterator[pd.DataFrame]:
    """Pairs within whole buckets; k is sorted."""
    upper = (k >> 2 * plan.half) < plan.segments
    for symbol in range(plan.width // 2):
        # a ball of radius 1 around the rest: those that are equal without one symbol
        left_out = k & ~np.int64(SYMBOL << symbol * SYMBOL_BITS)
        order = np.argsort(left_out, kind="stable")
        left_out, at = left_out[order], np.arange(len(k))
        for i, j in _ranges(at + 1, np.searchsorted(left_out, left_out, "right"), at):
            i, j = order[i], order[j]
            # equal segments meet in both halves, without any symbol; once is enough
            ok = (ids[i] != ids[j]) & ((k[i] != k[j]) | upper[i] if symbol == 0 else k[i] != k[j])
            i, j = i[ok], j[ok]
            far = np.bitwise_count(c[i, 0] ^ c[j, 0]).astype(np.int16) + np.bitwise_count(c[i, 1] ^ c[j, 1])
            a, b = ids[i[far <= plan.check]], ids[j[far <= plan.check]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def hot_buckets(filed: DataFrame, plan: Plan, classes: int) -> dict[int, int]:
    """Buckets to split, with their entries. A class has one entry per half segment, so there are at most HOT_SHARE for each.

    A sketch of heavy hitters names the buckets that may be hot, all that are and perhaps others; those alone are counted.
    """
    least = max(SPLIT, classes // HOT_SHARE)
    if classes <= least:
        return {}
    bucket = F.shiftright("k", plan.half)
    most = min(TRACKED // 2, 2 * plan.segments * HOT_SHARE)
    maybe = filed.agg(F.expr(f"approx_top_k(shiftright(k, {plan.half}), {most}, {TRACKED})").alias("t")).first()["t"] or []
    maybe = [x["item"] for x in maybe if x["count"] > least]
    if not maybe:
        return {}
    counts = filed.where(bucket.isin(maybe)).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return {r["bucket"]: r["n"] for r in counts.where(F.col("n") > least).collect()}


def candidates(filed: DataFrame, plan: Plan, hot: dict[int, int] | None = None) -> DataFrame:
    """Distinct pairs (a, b), a < b, whose segments come within one symbol somewhere and whose check bits are close.

    A bucket is read by one task, whole. A ``hot`` one is cut into blocks of about SPLIT entries, and each pair of its
    blocks is a task's work, so its entries travel once per block but no task holds more than two blocks.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[tuple] = []
        size = 0

        def columns(pdf: pd.DataFrame) -> tuple:
            return pdf["k"].to_numpy(), pdf["id"].to_numpy(), pdf[["c1", "c2"]].to_numpy().view(np.uint64)  # counts bits of signed numbers by absolute value

        for pdf in batches:
            k, ids, c = columns(pdf)
            if size + len(k) >= 200_000 and len(k):
                # up to where the last bucket of this batch begins; of what is kept, all is of whole buckets then
                cut = int(np.searchsorted(k >> plan.half, k[-1] >> plan.half, "left"))
                if cut or (kept and kept[-1][0][-1] >> plan.half != k[0] >> plan.half):
                    kept.append((k[:cut], ids[:cut], c[:cut]))
                    yield from _bucket_pairs(*(np.concatenate(x) for x in zip(*kept)), plan)
                    kept, size = [], 0
                    k, ids, c = k[cut:], ids[cut:], c[cut:]
            if len(k):
                kept.append((k, ids, c))
                size += len(k)
        if kept:
            yield from _bucket_pairs(*(np.concatenate(x) for x in zip(*kept)), plan)

    def run_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
            side = dict(zip(g["id"], g["block"]))
            cross = g["x"].iloc[0] != g["y"].iloc[0]
            for out in _bucket_pairs(g["k"].to_numpy(), g["id"].to_numpy(), g[["c1", "c2"]].to_numpy().view(np.uint64), plan):
                yield out[out["a"].map(side) != out["b"].map(side)] if cross else out

        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            keys = ["bucket", "x", "y"]
            last = (rest[keys] == rest[keys].iloc[-1]).all(axis=1) if len(rest) else None
            if last is not None and not last.all():
                for _, g in rest[~last].groupby(keys, sort=False):
                    yield from pairs(g)
                rest = rest[last]
        if rest is not None and len(rest):
            yield from pairs(rest)

    bucket = F.shiftright("k", plan.half)
    hot = hot or {}
    is_hot = bucket.isin(list(hot)) if hot else F.lit(False)
    spread = filed.where(~is_hot).repartition(bucket).sortWithinPartitions("k")
    out = spread.mapInPandas(run, "a long, b long")
    if hot:
        blocks = F.create_map(*[F.lit(x).cast("long") for b, n in hot.items() for x in (b, -(-n // SPLIT))])
        own = filed.where(is_hot).withColumn("bucket", bucket).withColumn("n", blocks[F.col("bucket")]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")))
        others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y")))
        met = own.select("k", "id", "c1", "c2", "bucket", "block", F.explode(others).alias("p")).select("k", "id", "c1", "c2", "bucket", "block", "p.x", "p.y")
        met = met.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "k")
        out = out.unionByName(met.mapInPandas(run_blocks, "a long, b long"))
    return out.distinct()


def exact_candidates(sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b), a < b, of sets (id, runs) that can reach the similarity: they share one of their rarest shingles.

    A set of n shingles, the rarest first, shares one of its first n - ceil(similarity n) + 1 with any set as similar.
    """
    uses = sets.select("id", F.size("runs").alias("n"), F.explode("runs").alias("r"))
    rare = uses.join(uses.groupBy("r").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "r")  # runs of one set alone come before them
    ranked = rare.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("f", "r"))).alias("x"))
    first = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9).cast("int") + 1 - (F.col("n") - F.size("x"))
    prefix = ranked.where(first > 0).select("id", "n", F.explode(F.slice("x", F.lit(1), first)).alias("x")).select("id", "n", "x.r")
    other = prefix.select(F.col("id").alias("b"), F.col("n").alias("m"), "r")
    near = (F.col("n") >= F.lit(similarity) * F.col("m") - 1e-9) & (F.col("m") >= F.lit(similarity) * F.col("n") - 1e-9)
    return prefix.withColumnRenamed("id", "a").join(other, "r").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _distance(x: str, y: str):
    """Symbols that differ."""
    parts = F.zip_with(f"{x}.segs", f"{y}.segs", lambda p, q: p.bitwiseXOR(q))
    fold = lambda n: lambda v: v.bitwiseOR(F.shiftrightunsigned(v, n))
    for n in (4, 2, 1):  # the lowest bit of each symbol becomes whether any of it differs
        parts = F.transform(parts, fold(n))
    lowest = F.lit(sum(1 << k * SYMBOL_BITS for k in range(max(WIDTHS))))
    return F.aggregate(parts, F.lit(0), lambda s, v: s + F.bit_count(v.bitwiseAND(lowest)))


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary()
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "runs": [shingle_hashes(vocabulary.ids(words(t)), shingle).view(np.int64) for t in pdf["text"]]})

    return texts.mapInPandas(run, "id long, runs array<long>")


class NearDuplicates:
    """Classes of equal shingle sets (``members``: id, rep) and links between classes (``links``: a, b, similarity).

    ``docs`` has id and text. Null texts and texts under ``least_words`` words are in no class; ids delivered twice count
    once; an empty table gives empty results. Links are all candidate pairs of the index whose complete fingerprint
    distance is small and whose shingle sets have at least ``similarity`` in common; a pair at exactly that similarity is
    missed with a chance of at most MISS + 2 TAIL, a closer one with less. With ``exact`` candidates come from shared rare
    shingles instead, at the cost of a shuffle of all shingles, and no link is missed. Nothing is capped or sampled.
    """

    def __init__(self, docs: DataFrame, similarity: float = 0.8, shingle: int = 5, least_words: int = 1, exact: bool = False):
        self.cuts = cuts = Cuts(docs.sparkSession, "near-duplicates")
        plan = Plan.of(similarity)
        sketched = cuts.cut(fingerprints(docs, shingle, least_words, plan), "fingerprints")
        heads = sketched.groupBy("set_key").agg(F.min("id").alias("rep"))
        self.members = cuts.cut(sketched.select("id", "set_key").distinct().join(heads, "set_key").select("id", "rep"), "members")
        reps = sketched.join(heads.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"]).drop("set_key")
        sets_of = lambda ids: shingle_sets(docs.select("id", "text").join(ids, "id", "left_semi").dropDuplicates(["id"]), shingle)
        if exact:
            sets = cuts.cut(sets_of(reps.select("id")), "sets")
            near = cuts.cut(exact_candidates(sets, similarity), "near")
        else:
            reps = cuts.cut(reps, "reps")
            cuts.drop(sketched)
            filed = entries(reps, plan)
            pairs = cuts.cut(candidates(filed, plan, hot_buckets(filed, plan, reps.count())), "candidates")
            x, y = reps.select(F.col("id").alias("a"), F.struct("segs").alias("x")), reps.select(F.col("id").alias("b"), F.struct("segs").alias("y"))
            near = pairs.join(x, "a").join(y, "b").where(_distance("x", "y") <= plan.whole)
            near = cuts.cut(near.select("a", "b"), "near")
            cuts.drop(reps)
            cuts.drop(pairs)
            sets = cuts.cut(sets_of(near.select(F.explode(F.array("a", "b")).alias("id")).distinct()), "sets")
        both = near.join(sets.select(F.col("id").alias("a"), F.col("runs").alias("ra")), "a").join(sets.select(F.col("id").alias("b"), F.col("runs").alias("rb")), "b")
        shared = F.size(F.array_intersect("ra", "rb"))
        both = both.select("a", "b", (shared / (F.size("ra") + F.size("rb") - shared)).alias("similarity"))
        self.links = cuts.cut(both.where(F.col("similarity") >= similarity), "links")
        cuts.drop(sets)
        cuts.drop(near)

    def groups(self) -> DataFrame:
        """One row per document: its class, the number of other classes it is linked to, and its connected group."""
        edges = self.links.select("a", "b").unionByName(self.members.select(F.col("rep").alias("a"), F.col("rep").alias("b")))
        groups = hash_to_min(edges, self.cuts).select(F.col("node").alias("rep"), F.col("component").alias("group_id"))
        counts = self.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
        out = self.members.join(groups.join(counts, "rep", "left"), "rep")
        return out.select("id", F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id")
