"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys.
HOT_SHARE = 64


def hot_keys(counts: DataFrame, keys: Sequence[str], count: str, share: int = HOT_SHARE) -> list[tuple]:
    """The keys that hold more than 1/share of all rows, fewer than ``share`` of them.

    ``counts`` has one row per key. Null keys are never hot: they match nothing.
    """
    total = counts.agg(F.sum(count)).first()[0] or 0
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = counts.where(known & (F.col(count) * F.lit(share) > F.lit(total)) & (F.col(count) > 1000))
    return [tuple(r) for r in rows.select(*keys).collect()]  # fewer than ``share``


def _among(keys: Sequence[str], values: list[tuple]):
    if len(keys) == 1 and not isinstance(values[0][0], tuple):
        return F.coalesce(F.col(keys[0]).isin([v[0] for v in values]), F.lit(False))
    hit = F.lit(False)
    for v in values:
        one = F.lit(True)
        for k, x in zip(keys, v):
            if isinstance(x, tuple):  # a struct
                for f in x.__fields__:
                    one = one & F.col(f"{k}.{f}").eqNullSafe(F.lit(x[f]))
            else:
                one = one & F.col(k).eqNullSafe(F.lit(x))
        hit = hit | one
    return hit


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", hot: list[tuple] | None = None) -> DataFrame:
    """Equi-join where ``right`` has at most one row per key and ``left`` may be skewed.

    Rows of hot keys meet a broadcast of the right rows of just those keys (fewer than HOT_SHARE rows, whatever the
    size of the data); all others meet in a shuffle join, whose largest key then has at most 1/HOT_SHARE of the rows.
    Null keys match nothing; with how="left" such rows are kept. Empty sides give empty or unmatched results.
    """
    keys = list(keys)
    if hot is None:
        hot = hot_keys(left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, "_n")
    if not hot:
        return left.join(right, keys, how)
    is_hot = _among(keys, hot)
    few = F.broadcast(right.where(is_hot))
    return left.where(~is_hot).join(right.where(~is_hot), keys, how).unionByName(left.where(is_hot).join(few, keys, how))
