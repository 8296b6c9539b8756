"""Runs, repositories and stages: what the driver does around the queries."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstead.operators import annotations as A
from loomstead.operators.corpus import build_corpus, corpus_candidates
from loomstead.operators.ingest import STREAMS
from loomstead.operators.upsert import update_where
from loomstead.schemas import TABLES
from loomstead.sources.rest import ChatCompleter, Client, RequestError
from loomstead.sources.shared import Cuts
from loomstead.sources.store import Store, next_id
from loomstead.streaming.collect import NoPosition, Stats, as_row, at, collect_batch, cursor_of, cursor_row, reconcile

RUNNING, SUCCEEDED, PARTIAL, FAILED, SKIPPED = "running", "succeeded", "partial", "failed", "skipped_dependency"


def utcnow() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def repository_name(value: str) -> str:
    """owner/name, trimmed; exactly one slash with something on both sides. Blanks inside are allowed."""
    owner, slash, name = (value := value.strip()).partition("/")
    if not owner or not name or not slash or "/" in name:
        raise ValueError(f"a repository is named owner/name: {value!r}")
    return value


@dataclass(frozen=True)
class Settings:
    warehouse: str = "warehouse"
    token: str = ""
    api_url: str = "https://api.github.com"
    api_version: str = "2022-11-28"
    repositories: tuple[str, ...] = ()
    overlap_seconds: int = 300
    timeout_seconds: int = 30
    retries: int = 5
    model_key: str = ""
    model_url: str = ""
    model_name: str = ""
    label_partitions: int = 20
    label_slice: int = 5000
    log_level: str = "INFO"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        """From LOOMSTEAD_ and the field's name in capitals. Numbers must be whole and positive, names well-formed."""
        given = {}
        for name, default in {f.name: f.default for f in cls.__dataclass_fields__.values()}.items():
            raw = env.get(f"LOOMSTEAD_{name.upper()}")
            if raw is None:
                continue
            if isinstance(default, int):
                if not raw.strip().isdigit() or int(raw) <= 0:
                    raise ValueError(f"LOOMSTEAD_{name.upper()} must be a positive whole number: {raw!r}")
                given[name] = int(raw)
            elif isinstance(default, tuple):
                given[name] = tuple(dict.fromkeys(repository_name(x) for x in raw.split(",") if x.strip()))
            else:
                given[name] = raw.rstrip("/") if name.endswith("_url") else raw.upper() if name == "log_level" else raw
        return cls(**given)

    def need(self, **secrets: str) -> None:
        for name, why in secrets.items():
            if not getattr(self, name):
                raise ValueError(f"LOOMSTEAD_{name.upper()} must be set to {why}")


def listing(repositories: DataFrame, enabled_only: bool = False) -> DataFrame:
    """Repositories by name, with times as ISO text."""
    rows = repositories.where("enabled") if enabled_only else repositories
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c)
    return rows.orderBy("full_name").select("id", "full_name", "enabled", iso("created_at"), iso("updated_at"))


def recent(runs: DataFrame, limit: int) -> DataFrame:
    """The runs that began last, newest first; at least one."""
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(max(1, limit))


@dataclass
class Repositories:
    store: Store
    now: Callable[[], datetime] = utcnow

    def rows(self) -> DataFrame:
        return self.store.read("repositories")

    def list(self, enabled_only: bool = False) -> list[dict]:
        return [r.asDict() for r in listing(self.rows(), enabled_only).collect()]

    def names(self) -> list[str]:
        return [r["full_name"] for r in self.list(enabled_only=True)]

    def ensure(self, name: str) -> int:
        """The id of a repository, added or enabled again where needed."""
        hit = self.rows().where(F.col("full_name") == name).first()
        if hit is None:
            new = next_id(self.rows())
            self._add([name], new)
            return new
        if not hit["enabled"]:
            self.set_enabled(name, True)
        return hit["id"]

    def _add(self, names: list[str], first: int) -> None:
        new = self.store.spark.createDataFrame([(first + i, n, True, self.now(), self.now()) for i, n in enumerate(names)], TABLES["repositories"])
        self.store.commit({"repositories": self.rows().unionByName(new)})

    def set_enabled(self, name: str, enabled: bool) -> bool:
        """Whether that changed anything; an unknown name is an error."""
        hit = self.rows().where(F.col("full_name") == name).first()
        if hit is None:
            raise ValueError(f"no such repository: {name}")
        self.store.commit({"repositories": update_where(self.rows(), F.col("full_name") == name, enabled=F.lit(enabled), updated_at=at(self.now()))})
        return hit["enabled"] != enabled

    def bootstrap(self, names: Iterable[str]) -> int:
        """Add the first names, in order and each once, if there is no repository yet."""
        new = list(dict.fromkeys(names))
        if not new or not self.rows().isEmpty():
            return 0
        self._add(new, 1)
        return len(new)


@dataclass
class Runs:
    store: Store
    now: Callable[[], datetime] = utcnow

    def start(self, kind: str) -> str:
        """Log a new run. Runs that still count as running were broken off, for the lock is ours: they have failed."""
        now = self.now()
        old = self.store.read("pipeline_runs")
        old = update_where(old, F.col("status") == RUNNING, status=F.lit(FAILED), completed_at=at(now), heartbeat_at=at(now), error_message=F.lit("the run was broken off; a later one took over"))
        run = str(uuid.uuid4())
        new = self.store.spark.createDataFrame([(run, kind, RUNNING, now, now, None, "{}", None)], TABLES["pipeline_runs"])
        self.store.commit({"pipeline_runs": old.unionByName(new)})
        return run

    def _set(self, run: str, **values) -> None:
        self.store.commit({"pipeline_runs": update_where(self.store.read("pipeline_runs"), F.col("id") == run, **values)})

    def heartbeat(self, run: str) -> None:
        self._set(run, heartbeat_at=at(self.now()))

    def finish(self, run: str, status: str, stats: dict, error: str | None = None) -> None:
        now = at(self.now())
        self._set(run, status=F.lit(status), stats=F.lit(json.dumps(stats, ensure_ascii=False)), error_message=F.lit(error).cast("string"), heartbeat_at=now, completed_at=now)

    def recent(self, limit: int = 10) -> list[dict]:
        """The runs that began last, newest first; at least one."""
        rows = recent(self.store.read("pipeline_runs"), limit).collect()
        iso = lambda t: t.isoformat() if t else None
        return [{"id": r["id"], "run_type": r["run_type"], "status": r["status"], "started_at": iso(r["started_at"]), "completed_at": iso(r["completed_at"]), "stats": json.loads(r["stats"] or "{}"), "error_message": r["error_message"]} for r in rows]

    def tracked(self, kind: str, work: Callable[[str], dict]) -> tuple[str, str, dict]:
        """Run ``work`` under the lock and log how it ended: partial if streams or labels failed."""
        with self.store.lock():
            run = self.start(kind)
            try:
                stats = work(run)
            except Exception as e:
                self.finish(run, FAILED, {}, str(e))
                raise
            parts = [stats, stats.get("collection", {}), stats.get("labels", {})]
            status = PARTIAL if any(p.get("failed_streams") or p.get("failed") for p in parts) else SUCCEEDED
            self.finish(run, status, stats)
            return run, status, stats


def fatal(error: Exception) -> bool:
    """Refused access ends a run; an outage that outlasted its retries has no status and doesn't."""
    return isinstance(error, RequestError) and error.status in (401, 403)


@dataclass
class Collector:
    """Collects the three streams of a repository from the API, page by page, from the durable cursor."""

    client: Client
    store: Store
    overlap_seconds: int = 300
    segment_pages: int = 250
    now: Callable[[], datetime] = utcnow
    paths: dict[str, str] = field(default_factory=lambda: {STREAMS[0]: "/repos/{}/issues", STREAMS[1]: "/repos/{}/issues/comments", STREAMS[2]: "/repos/{}/pulls/comments"})

    def since(self, repository_id: int, stream: str) -> dict:
        cursor = cursor_of(self.store, repository_id, stream)
        return {"since": (cursor - timedelta(seconds=self.overlap_seconds)).isoformat() + "Z"} if cursor else {}

    def pages(self, repository_id: int, stream: str, path: str):
        """Pages in segments that start again from the cursor before the API's page limit; without progress it is an error."""
        before = cursor_of(self.store, repository_id, stream)
        while True:
            params = {"per_page": 100, "sort": "updated", "direction": "asc"} | self.since(repository_id, stream) | ({"state": "all"} if stream == STREAMS[0] else {})
            n = 0
            for page in self.client.pages(path, params, self.segment_pages):
                n += 1
                yield page
            if n < self.segment_pages:
                return
            here = cursor_of(self.store, repository_id, stream)
            if here is None or (before is not None and here <= before):
                raise RuntimeError(f"{stream}: a whole segment didn't advance the cursor; too much within the overlap")
            before = here

    def lookup(self, name: str):
        def find(_: int, numbers: list[int]) -> DataFrame:
            out = []
            for n in numbers:
                try:
                    out.append((n, json.dumps(self.client.get(f"/repos/{name}/issues/{n}"), ensure_ascii=False), None))
                except RequestError as e:
                    if e.status not in (404, 410):
                        raise
                    out.append((n, None, str(e)))
            return self.store.spark.createDataFrame(out, "number int, item string, reason string")

        return find

    def stream(self, repository_id: int, name: str, stream: str, stats: Stats) -> None:
        began = self.now()
        lookup = self.lookup(name)
        if stream != STREAMS[0]:
            reconcile(self.store, repository_id, stream, self.now(), lookup)
        for items, tries in self.pages(repository_id, stream, self.paths[stream].format(name)):
            stats.retries += tries
            rows = self.store.spark.createDataFrame([(json.dumps(i, ensure_ascii=False),) for i in items], "item string")
            collect_batch(self.store, repository_id, stream, rows, self.now(), lookup, stats)
        if cursor_of(self.store, repository_id, stream) is None:
            self.store.upsert(repository_cursors=cursor_row(self.store, repository_id, stream, began, self.now()))

    def repository(self, name: str, run: str, heartbeat: Callable[[], None] = lambda: None) -> dict[str, dict]:
        """Stats by stream. If the parents' stream fails, both comment streams are skipped; a refusal ends the run, once logged."""
        repository_id = Repositories(self.store, self.now).ensure(name)
        results, parents = {}, True
        for stream in STREAMS:
            began, stats, end = self.now(), Stats(), None
            if stream != STREAMS[0] and not parents:
                stats.status, stats.error_message = SKIPPED, "the stream of issues and pull requests failed"
            else:
                try:
                    self.stream(repository_id, name, stream, stats)
                    stats.status = SUCCEEDED
                except Exception as e:
                    stats.status, stats.error_message = FAILED, str(e)
                    parents = parents and stream != STREAMS[0]
                    end = e if fatal(e) else None
            heartbeat()
            results[stream] = as_row(stats)
            row = (run, repository_id, stream, *results[stream].values(), began, self.now())
            schema = TABLES["collection_stream_runs"].removeprefix("id long, ")
            self.store.upsert(collection_stream_runs=self.store.spark.createDataFrame([row], schema))
            if end is not None:
                raise end
        return results


@dataclass
class Pipeline:
    settings: Settings
    store: Store
    now: Callable[[], datetime] = utcnow
    client: Client | None = None
    completer: A.Completer | None = None

    def collect(self, run: str) -> dict:
        self.settings.need(token="collect")
        names = Repositories(self.store, self.now).names()
        if not names:
            raise ValueError("no repository is enabled; add one first")
        s = self.settings
        with contextlib.ExitStack() as stack:
            client = self.client or stack.enter_context(Client(s.token, s.api_url, s.timeout_seconds, s.retries, {"X-GitHub-Api-Version": s.api_version}))
            collector = Collector(client, self.store, s.overlap_seconds, now=self.now)
            beat = lambda: Runs(self.store, self.now).heartbeat(run)
            done = {name: collector.repository(name, run, beat) for name in names}
        failed = sum(x["status"] == FAILED for streams in done.values() for x in streams.values())
        return {"repositories": done, "failed_streams": failed}

    def build(self) -> dict:
        read = self.store.read
        candidates = corpus_candidates(*(read(t) for t in ("issues", "pull_requests", "issue_comments", "pr_comments")))
        corpus, stats = build_corpus(read("corpus"), candidates, at(self.now()))
        self.store.commit({"corpus": corpus})
        return stats

    def label(self) -> dict:
        """Label the queue in slices by id. Each slice's answers are stored before the next is asked, so a run that ends early
        keeps them and the next one asks for the rest. A model that was made here is closed in all cases."""
        s, completer = self.settings, self.completer
        with contextlib.ExitStack() as stack:
            if completer is None:
                s.need(model_key="label", model_url="label", model_name="label")
                completer = stack.enter_context(ChatCompleter(s.model_key, s.model_url, s.model_name, prompt(), max(60, s.timeout_seconds), s.retries))
            cuts = Cuts(self.store.spark, "labels")
            work = cuts.cut(A.queue(self.store.read("corpus"), self.store.read("llm_annotations"), completer.model), "queue")
            total, last = {"read": 0, "succeeded": 0, "failed": 0}, 0
            while True:
                part = work.where(F.col("id") > last).orderBy("id").limit(s.label_slice)
                rows = cuts.cut(A.label(part, completer, at(self.now()), s.label_partitions), "answers")  # asked once
                done = A.label_stats(rows).crossJoin(rows.agg(F.max("corpus_id").alias("last"))).first().asDict()
                if not done["read"]:
                    return total
                self.store.upsert(llm_annotations=rows)
                total, last = {k: n + done[k] for k, n in total.items()}, done["last"]
                cuts.drop(rows)

    def run(self, run: str, skip_label: bool = False) -> dict:
        """Collect, build, label; failed streams end it after collecting."""
        stats: dict = {"collection": self.collect(run)}
        if not stats["collection"]["failed_streams"]:
            stats["corpus"] = self.build()
            if not skip_label:
                stats["labels"] = self.label()
        return stats


def prompt() -> str:
    """The instructions for the model, from the taxonomy."""
    groups = "; ".join(f"{g}: {', '.join(a)}" for g, a in A.ASPECTS.items())
    return (
        "Mark the sentiment of each aspect that the TARGET text speaks about. Answer with one JSON object, "
        '{"annotations": [{"aspect": ..., "class": ...}]}, and nothing else. '
        f"Aspects by group: {groups}. Classes: {', '.join(A.CLASSES)}; neutral is for an aspect that is discussed without a "
        "leaning. Leave out aspects that aren't discussed, name none twice; the list may be empty. CONTEXT only helps to "
        "understand TARGET; its own sentiment doesn't count."
    )


__all__ = ["Collector", "NoPosition", "Pipeline", "Repositories", "Runs", "Settings", "fatal", "repository_name"]
