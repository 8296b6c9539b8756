"""Collection of landed items into the store: one commit per batch, with its quarantine and its cursor.

Landed items are rows (repository_id, stream, item). ``collect_batch`` is the whole step for one repository and stream;
``collect_landed`` runs it over a folder as a stream that stops when nothing new is left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.operators import ingest as I
from loomstead.operators.upsert import keep_last, update_where
from loomstead.schemas import KEYS, TABLES
from loomstead.sources.shared import Cuts
from loomstead.sources.store import Store

LANDED = "repository_id long, stream string, item string"
UNREADABLE = "unreadable"


class NoPosition(RuntimeError):
    pass


@dataclass
class Stats:
    status: str = "running"
    pages_read: int = 0
    items_read: int = 0
    items_written: int = 0
    retries: int = 0
    error_message: str | None = None


def at(time: datetime):
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def cursor_of(store: Store, repository_id: int, stream: str) -> datetime | None:
    row = store.read("repository_cursors").where((F.col("repository_id") == repository_id) & (F.col("stream") == stream)).first()
    return row["last_updated_at"] if row else None


def cursor_row(store: Store, repository_id: int, stream: str, value: datetime, now: datetime) -> DataFrame:
    return store.spark.createDataFrame([(repository_id, stream, value, now)], "repository_id long, stream string, last_updated_at timestamp_ntz, updated_at timestamp_ntz")


#: Looks up the numbers of parents that aren't stored: rows (number, item, reason), item null where there is none.
Lookup = Callable[[int, list[int]], DataFrame]
#: Parses items of a stream: (items, stream, time of collection) to rows.
Parser = Callable[[DataFrame, str, Column], DataFrame]


def supplement(store: Store, repository_id: int, unknown: DataFrame, lookup: Lookup | None, pr_only: bool, now: datetime, cuts: Cuts) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Batches of parents that the lookup finds, and the reasons (parent_number, reason) of those it doesn't.

    Each distinct number is asked for once, in order. For review comments an issue is no parent.
    """
    if lookup is None:
        return {}, None
    numbers = [r[0] for r in unknown.select("number").distinct().orderBy("number").toLocalIterator()]
    if not numbers:
        return {}, None
    got = cuts.cut(lookup(repository_id, numbers).select("number", "item", "reason"), "supplement")
    asked = lambda name: F.col("asked").cast("int").alias(name)
    parsed = cuts.cut(I.parse(got.where("item is not null").withColumnRenamed("number", "asked").withColumn("repository_id", F.lit(repository_id).cast("long")), I.STREAMS[0], at(now)), "looked-up")
    found = parsed.where("problem is null")
    batches = {"pull_requests": found.where("is_pr")}
    if not pr_only:
        batches["issues"] = found.where("not is_pr")
    reason = F.when(F.col("item").isNull(), F.col("reason"))
    if pr_only:
        reason = reason.when(~I.has_key(F.col("item"), "pull_request"), "the parent is an issue, not a pull request")
    lost = got.select(F.col("number").cast("int").alias("parent_number"), reason.alias("why"))
    unread = parsed.where("problem is not null").select(asked("parent_number"), F.concat(F.lit("the parent that was found can't be read: "), "problem").alias("why"))
    return batches, lost.unionByName(unread).where("why is not null").groupBy("parent_number").agg(F.min("why").alias("why"))


def collect_batch(store: Store, repository_id: int, stream: str, items: DataFrame, now: datetime, lookup: Lookup | None = None, stats: Stats | None = None, parse: Parser = I.parse) -> Stats:
    """Parse, quarantine, route and merge the items of one batch, and advance the cursor, in one commit.

    ``parse`` may be any function that gives the columns and the ``problem`` that ``ingest.parse`` gives.
    """
    stats = stats or Stats()
    cuts = Cuts(store.spark, "collect")
    here = items.withColumn("repository_id", F.lit(repository_id).cast("long")).withColumn("_n", F.monotonically_increasing_id())
    rows = cuts.cut(parse(here, stream, at(now)), "parsed")
    n = rows.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("problem").isNotNull()).alias("bad")).first()
    stats.pages_read += 1
    stats.items_read += n["read"]
    old = cursor_of(store, repository_id, stream)
    top = I.high_water(rows).first()["latest"]
    latest = max(filter(None, (old, top)), default=None)
    good = rows.where("problem is null")
    bad = [I.quarantine(rows.where("problem is not null").drop("parent_number"), stream, I.INVALID, F.concat(F.lit("the record can't be read: "), "problem"), at(now))]
    batches: dict[str, DataFrame] = {}
    if stream == I.STREAMS[0]:
        batches = {"issues": good.where("not is_pr"), "pull_requests": good.where("is_pr")}
        stats.items_written += n["read"] - n["bad"]
    else:
        issues, pulls = store.read("issues"), store.read("pull_requests")
        numbers = good.select("repository_id", F.col("parent_number").alias("number"))
        review = stream == I.STREAMS[2]
        known = cuts.cut(I.classify_parents(numbers, issues, pulls), "known")
        new, reasons = supplement(store, repository_id, I.unknown_parents(known, review), lookup, review, now, cuts)
        if new:
            store.upsert(["_one"], **{t: b.withColumn("_one", F.lit(1)) for t, b in new.items()})
            issues, pulls = store.read("issues"), store.read("pull_requests")
            known = cuts.cut(I.classify_parents(numbers, issues, pulls), "known")
        to_issues, to_pulls, lost = I.route(good, known, stream)
        to_issues = I.resolve_parents(to_issues, issues, "issue_id")
        to_pulls = I.resolve_parents(to_pulls, pulls, "pull_request_id")
        batches = {"issue_comments": to_issues, "pr_comments": to_pulls}
        why = F.lit("the parent is still missing")
        if reasons is not None:
            lost = lost.join(reasons, "parent_number", "left")
            why = F.coalesce("why", why)
        bad.append(I.quarantine(lost, stream, I.MISSING, why, at(now)))
        stats.items_written += to_issues.count() + to_pulls.count()
    # items of one batch under one quarantine key: the later category is the missing parent's
    dead = cuts.cut(keep_last(bad[0].unionByName(bad[1]) if len(bad) > 1 else bad[0], KEYS["unresolved_collection_items"], ["category"]), "dead")
    if latest is None:
        if n["bad"]:
            store.upsert(unresolved_collection_items=dead)
            raise NoPosition("no item has a usable updated_at, so the cursor can't advance safely")
        return stats
    changed = {t: store.merged(t, b, ["_n"]) for t, b in batches.items()}
    changed["unresolved_collection_items"] = store.merged("unresolved_collection_items", dead)
    changed["repository_cursors"] = store.merged("repository_cursors", cursor_row(store, repository_id, stream, latest, now))
    store.commit(changed)
    return stats


def reconcile(store: Store, repository_id: int, stream: str, now: datetime, lookup: Lookup | None = None, limit: int = 1000) -> int:
    """Try the oldest items with a missing parent again; how many found theirs. Invalid records are never tried again."""
    cuts = Cuts(store.spark, "reconcile")
    waiting = cuts.cut(I.pending(store.read("unresolved_collection_items"), repository_id, stream, limit), "waiting")
    if waiting.isEmpty():
        return 0
    review = stream == I.STREAMS[2]
    numbers = waiting.select("repository_id", F.col("parent_number").alias("number"))
    known = cuts.cut(I.classify_parents(numbers, store.read("issues"), store.read("pull_requests")), "known")
    new, reasons = supplement(store, repository_id, I.unknown_parents(known, review), lookup, review, now, cuts)
    if new:
        store.upsert(["_one"], **{t: b.withColumn("_one", F.lit(1)) for t, b in new.items()})
        known = cuts.cut(I.classify_parents(numbers, store.read("issues"), store.read("pull_requests")), "known")
    rows = I.parse(waiting.select(F.col("id").alias("item_id"), "repository_id", F.col("payload").alias("item")), stream, at(now))
    to_issues, to_pulls, lost = I.route(rows.where("problem is null"), known, stream, reconcile=True)
    ci, cp = (cuts.cut(x, n) for x, n in ((I.resolve_parents(to_issues, store.read("issues"), "issue_id"), "ci"), (I.resolve_parents(to_pulls, store.read("pull_requests"), "pull_request_id"), "cp")))
    done = ci.select("item_id").unionByName(cp.select("item_id")).distinct().withColumn("found", F.lit(True))
    default = "the parent is still missing after another look"
    why = default
    if reasons is not None:
        r = reasons.withColumnRenamed("why", "reason")
        why = r.agg(I.failure_reasons(r, default).alias("x")).first()["x"]
    tried = waiting.select(F.col("id").alias("item_id")).join(done, "item_id", "left")
    base = store.read("unresolved_collection_items").join(tried.withColumnRenamed("item_id", "id").withColumn("tried", F.lit(True)), "id", "left")
    out = update_where(base, F.col("found"), resolved_at=at(now), last_attempt_at=at(now))
    out = update_where(out, F.col("tried") & F.col("found").isNull(), attempt_count=F.col("attempt_count") + 1, reason=F.lit(why), last_attempt_at=at(now))
    names = [f.split()[0] for f in TABLES["unresolved_collection_items"].split(", ")]
    store.commit({"issue_comments": store.merged("issue_comments", ci, ["item_id"]), "pr_comments": store.merged("pr_comments", cp, ["item_id"]), "unresolved_collection_items": out.select(*names)})
    return done.count()


def collect_landed(store: Store, folder: str, checkpoint: str, now: Callable[[], datetime], files_per_batch: int = 250) -> list[Stats]:
    """Collect a folder of landed JSON lines (LANDED) with Structured Streaming until nothing new is left.

    A batch holds at most ``files_per_batch`` files. Within it the streams go in order, so parents come before comments.
    Batches may be delivered again after a failure: merges make that harmless. Lines that aren't such JSON, or name no known
    stream, go to quarantine under the stream ``unreadable``.
    """
    done: list[Stats] = []

    def one(batch: DataFrame, _: int) -> None:
        cuts = Cuts(store.spark, "landed")
        rows = cuts.cut(batch.select("value", F.from_json("value", LANDED).alias("r")).select("value", "r.*"), "batch")
        known = F.coalesce(F.col("repository_id").isNotNull() & F.col("item").isNotNull() & F.col("stream").isin(*I.STREAMS), F.lit(False))
        good = rows.where(known)
        # a line that tells no repository, stream or item can't be collected, nor must it stop the rest
        odd = rows.where(~known).select(F.coalesce("repository_id", F.lit(0)).alias("repository_id"), F.col("value").alias("item"))
        dead = I.quarantine(odd, UNREADABLE, I.INVALID, F.lit("the line names no repository, stream or item"), at(now()))
        dead = cuts.cut(dead.dropDuplicates([*KEYS["unresolved_collection_items"]]), "unreadable")
        store.upsert(unresolved_collection_items=dead)
        groups = {(r["repository_id"], r["stream"]) for r in good.select("repository_id", "stream").distinct().collect()}
        for repository_id, stream in sorted(groups, key=lambda g: (g[0], I.STREAMS.index(g[1]))):
            part = good.where((F.col("repository_id") == repository_id) & (F.col("stream") == stream)).select("item")
            done.append(collect_batch(store, repository_id, stream, part, now()))

    source = store.spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return done


def as_row(stats: Stats) -> dict:
    return asdict(stats)
