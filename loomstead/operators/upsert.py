"""Keyed merges of batches into tables, and ids for new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.sources.shared import Cuts


def keep_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last by ``order``. Aggregated before the shuffle, so a key with many rows is no hot spot.

    Nulls in ``order`` come first; null keys are a key of their own; ties are settled by the whole row.
    """
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], *[F.col(c) for c in rest])
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def _spread(columns: Sequence[str], keys: Sequence[str]) -> Column:
    """0, or a hash of the whole row where a key is null: such rows match nothing and needn't meet in one task."""
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    return F.when(lost, F.xxhash64(*columns)).otherwise(F.lit(0).cast("long"))


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], updates: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """``base`` after ``batch``: unknown keys are added, of known ones only ``updates`` change, to nulls too.

    The batch's last row of a key by ``order`` counts, whatever its times (the last arrival wins). Columns that the batch
    lacks stay as they are, or null in added rows; extra columns of the batch are ignored; base rows without a match stay.
    Null keys match nothing, so such batch rows are added.
    """
    if order is not None:
        batch = keep_last(batch, keys, order)
    have = [c for c in base.columns if c in batch.columns]
    b = base.withColumns({"_old": F.lit(True), "_spread": _spread(base.columns, keys)}).alias("b")
    n = batch.select(*have).withColumns({"_hit": F.lit(True), "_spread": _spread(have, keys)}).alias("n")
    on = F.col("b._spread") == F.col("n._spread")
    for k in keys:
        on = on & (F.col(f"b.{k}") == F.col(f"n.{k}"))
    both = b.join(n, on, "full_outer")
    out = []
    for c in base.columns:
        if c not in have:
            out.append(F.col(f"b.{c}").alias(c))
        elif c in updates:
            out.append(F.when(F.col("n._hit"), F.col(f"n.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
        else:
            out.append(F.when(F.col("b._old"), F.col(f"b.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return both.select(*out)


def number_rows(rows: DataFrame, order: Sequence[str], first: int, cuts: Cuts, column: str = "id") -> DataFrame:
    """Set ``column`` to first, first + 1, ... in ``order``, without gathering the rows in one task.

    Rows are range-partitioned and written, counted per partition, and numbered within partitions from their offsets.
    """
    parts = rows.drop(column).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = cuts.cut(parts.withColumn("_m", F.monotonically_increasing_id()), "numbered")
    # the partition is in the upper bits of the number, the place in it in the lower 33
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    counts = {r["p"]: r["n"] for r in parts.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offset, start = {}, first
    for p in sorted(counts):
        offset[p], start = start, start + counts[p]
    if not offset:
        return parts.drop("_m").withColumn(column, F.lit(None).cast("long"))
    table = F.create_map(*[F.lit(x).cast("long") for kv in offset.items() for x in kv])
    return parts.withColumn(column, table[part] + place).drop("_m")


def with_ids(base: DataFrame, merged: DataFrame, order: Sequence[str], cuts: Cuts) -> DataFrame:
    """Give the rows of ``merged`` that have no id the next ones after the highest of ``base``, in ``order``."""
    highest = base.agg(F.max("id")).first()[0] or 0
    new = number_rows(merged.where("id is null"), order, highest + 1, cuts)
    return merged.where("id is not null").unionByName(new.select(*merged.columns))


def broken_unique(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def update_where(base: DataFrame, hit: Column, **values: Column) -> DataFrame:
    """Set columns of the rows where ``hit`` is true; a null ``hit`` is false."""
    return base.withColumns({c: F.when(F.coalesce(hit, F.lit(False)), v).otherwise(F.col(c)) for c, v in values.items()})
