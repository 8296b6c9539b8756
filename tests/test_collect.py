import json
from datetime import datetime

import pytest

from loomstead.control import Collector, Pipeline, Repositories, Runs, Settings
from loomstead.operators import ingest as I
from loomstead.sources.rest import Client, RequestError, Response
from loomstead.sources.store import AlreadyRunning, Conflict, Store
from loomstead.streaming.collect import NoPosition, collect_batch, collect_landed, cursor_of

NOW = datetime(2025, 6, 1)
A = "https://api.test"


def issue(n, pr=False, **more):
    x = {"id": 100 + n, "number": n, "title": f"t{n}", "body": "b", "state": "open", "user": {"login": "u", "id": 1}, "html_url": f"h{n}", "created_at": "2025-01-01T00:00:00Z", "updated_at": f"2025-02-{n:02d}T01:00:00+01:00"}
    return x | ({"pull_request": None} if pr else {}) | more


def comment(i, n, key="issue_url", kind="issues", **more):
    return {"id": i, "body": "c", "user": {"login": "u", "id": 1}, "html_url": "h", key: f"{A}/repos/o/r/{kind}/{n}", "created_at": "2025-03-01T00:00:00Z", "updated_at": f"2025-03-{i % 28 + 1:02d}T00:00:00Z"} | more


class Api:
    """Answers by path; what isn't there is a 404."""

    def __init__(self, **lists):
        self.asked, self.lists, self.objects, self.fail = [], {"issues": [[]], "issues/comments": [[]], "pulls/comments": [[]]} | lists, {}, {}

    def __call__(self, method, url, headers, body, timeout):
        path, _, query = url.removeprefix(A + "/repos/o/r/").partition("?")
        self.asked.append((path, query))
        if path in self.fail:
            return Response(self.fail[path], '{"message":"no"}')
        if path in self.lists:
            pages, at = self.lists[path], int(query.rpartition("page=")[2]) if query.startswith("page=") else 0
            link = {"Link": f'<{A}/repos/o/r/{path}?page={at + 1}>; rel="next"'} if at + 1 < len(pages) else {}
            return Response(200, json.dumps(pages[at]), link)
        return Response(200, json.dumps(self.objects[path])) if path in self.objects else Response(404, '{"message":"gone"}')


def collector(store, api, **more):
    return Collector(Client("t", A, retries=1, transport=api, sleep=lambda _: None), store, now=lambda: NOW, **more)


def items(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "item string")


def test_roles_cursor_and_since(spark, store):
    api = Api(issues=[[issue(1), issue(2, pr=True)]])
    c = collector(store, api)
    out = c.repository("o/r", "run")
    assert [s["status"] for s in out.values()] == ["succeeded"] * 3 and out[I.STREAMS[0]]["items_written"] == 2
    assert store.read("issues").count() == store.read("pull_requests").count() == 1
    assert cursor_of(store, 1, I.STREAMS[0]) == datetime(2025, 2, 2)
    assert "since" not in api.asked[0][1] and "state=all" in api.asked[0][1]
    assert c.since(1, I.STREAMS[0]) == {"since": "2025-02-01T23:55:00Z"}
    c.repository("o/r", "run")  # again: the same rows
    assert store.read("issues").count() == 1 and store.read("collection_stream_runs").count() == 3


def test_invalid_records_are_set_aside_and_move_the_cursor(spark, store):
    bad = issue(9)
    del bad["created_at"]
    stats = collect_batch(store, 1, I.STREAMS[0], items(spark, issue(1), bad, "[1]", issue(3, title="x" * 1025)), NOW)
    assert (stats.items_read, stats.items_written) == (4, 1)
    q = {r.item_key: r for r in store.read("unresolved_collection_items").collect()}
    assert q["109"].reason.endswith("missing field created_at") and q["103"].category == I.INVALID and len(q) == 3
    assert any("raw" in json.loads(r.payload) for r in q.values())
    assert cursor_of(store, 1, I.STREAMS[0]) == datetime(2025, 2, 9)


def test_no_usable_time_is_saved_and_then_fails(spark, store):
    with pytest.raises(NoPosition):
        collect_batch(store, 1, I.STREAMS[0], items(spark, {"id": 4}), NOW)
    assert store.read("unresolved_collection_items").count() == 1 and cursor_of(store, 1, I.STREAMS[0]) is None


def test_missing_parent_waits_and_is_found_later(spark, store):
    api = Api(**{"issues": [[issue(1)]], "issues/comments": [[comment(11, 1), comment(12, 7)]], "pulls/comments": [[comment(13, 1, "pull_request_url", "pulls")]]})
    api.objects["issues/1"] = issue(1)
    collector(store, api).repository("o/r", "run")
    q = {r.github_id: r for r in store.read("unresolved_collection_items").collect()}
    assert set(q) == {12, 13} and q[12].parent_number == 7 and "gone" in q[12].reason and "issue, not" in q[13].reason
    assert store.read("issue_comments").count() == 1
    api.objects["issues/7"] = issue(7, pr=True)
    api.lists = {"issues": [[]], "issues/comments": [[]], "pulls/comments": [[]]}
    collector(store, api).repository("o/r", "run2")
    q = {r.github_id: r for r in store.read("unresolved_collection_items").collect()}
    assert q[12].resolved_at == NOW and q[13].resolved_at is None and q[13].attempt_count == 2
    assert store.read("pr_comments").first().comment_type == "issue_comment"
    # quarantined again: open again, with its first date and its attempts
    store.upsert(unresolved_collection_items=I.quarantine(items(spark, comment(13, 1)).selectExpr("item", "1L repository_id", "1 parent_number"), I.STREAMS[2], I.MISSING, I.F.lit("again"), I.F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")))
    r = store.read("unresolved_collection_items").where("github_id = 13").first()
    assert (r.attempt_count, r.reason, r.first_seen_at) == (2, "again", NOW)


def test_a_number_of_both_kinds(spark):
    c = spark.createDataFrame([(1, 5, "x")], "repository_id long, parent_number int, v string")
    k = spark.createDataFrame([(1, 5, True, True)], "repository_id long, number int, is_issue boolean, is_pr boolean")
    count = lambda parts: [p.count() for p in parts]
    assert count(I.route(c, k, I.STREAMS[1])) == [1, 1, 0]
    assert count(I.route(c, k, I.STREAMS[1], reconcile=True)) == [1, 0, 0]
    assert count(I.route(c, k, I.STREAMS[2])) == [0, 1, 0]
    with pytest.raises(I.MissingParents, match="5"):
        I.resolve_parents(c, spark.createDataFrame([], "repository_id long, number int, id long"), "issue_id")


def test_interrupted_stream_keeps_pages_and_skips_comments(spark, store):
    api = Api(issues=[[issue(1)], [issue(2)]])
    real, n = api.__call__, []

    def flaky(*a):
        n.append(1)
        return Response(500, "down") if a[1].endswith("?page=1") else real(*a)

    out = collector(store, flaky).repository("o/r", "run")
    assert [s["status"] for s in out.values()] == ["failed", "skipped_dependency", "skipped_dependency"]
    assert out[I.STREAMS[0]]["pages_read"] == 1 and cursor_of(store, 1, I.STREAMS[0]) == datetime(2025, 2, 1)


def test_refusal_is_logged_and_ends_the_run(spark, store):
    api = Api()
    api.fail["issues"] = 401
    with pytest.raises(RequestError):
        collector(store, api).repository("o/r", "run")
    assert store.read("collection_stream_runs").first().status == "failed"


def test_segments_start_again_from_the_cursor(spark, store):
    api = Api(issues=[[issue(1)], [issue(2)], [issue(3)]])
    with pytest.raises(RuntimeError, match="advance"):
        for items_, _ in collector(store, api, segment_pages=2).pages(1, I.STREAMS[0], "/repos/o/r/issues"):
            pass  # nothing is committed, so there is no progress


def test_landed_files_as_a_stream(spark, store, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    land = lambda name, *rows: (folder / name).write_text("\n".join(json.dumps({"repository_id": 1, "stream": s, "item": json.dumps(i)}) for s, i in rows))
    land("1.json", (I.STREAMS[1], comment(11, 1)), (I.STREAMS[0], issue(1)))
    run = lambda: collect_landed(store, str(folder), str(tmp_path / "cp"), lambda: NOW)
    assert [s.items_written for s in run()] == [1, 1]
    land("2.json", (I.STREAMS[0], issue(1, title="new")))
    assert len(run()) == 1 and run() == []
    assert [r.title for r in store.read("issues").collect()] == ["new"] and store.read("issue_comments").count() == 1


def test_commit_is_all_or_nothing_and_tries_again(spark, store, monkeypatch):
    store.create()
    before, real, n = store.versions(), Store._switch, []

    def broken(self, *a):
        n.append(1)
        if len(n) < 3:
            raise OSError("busy")
        real(self, *a)

    monkeypatch.setattr(Store, "_switch", broken)
    store.commit({"repositories": store.read("repositories")})
    assert len(n) == 3 and store.versions() != before
    monkeypatch.setattr(Store, "_switch", lambda *_: (_ for _ in ()).throw(OSError("down")))
    held = store.versions()
    with pytest.raises(OSError):
        store.commit({"issues": store.read("issues"), "corpus": store.read("corpus")})
    assert store.versions() == held


def test_two_writers(spark, store, monkeypatch):
    """Changes of different tables both hold; of two changes to one table the later one ends."""
    store.create()
    other, real = Store(spark, store.base), Store._switch

    def meanwhile(table):
        def switch(self, seen, written):
            monkeypatch.setattr(Store, "_switch", real)
            other.commit({table: other.read(table)})
            real(self, seen, written)

        monkeypatch.setattr(Store, "_switch", switch)

    before = store.versions()
    meanwhile("corpus")
    store.commit({"issues": store.read("issues")})
    assert {t for t, v in store.versions().items() if v != before[t]} == {"issues", "corpus"}
    meanwhile("issues")
    with pytest.raises(Conflict):
        store.commit({"issues": store.read("issues")})


def test_a_failed_write_is_tried_again(spark, store):
    slept, fails = [], [True, True]
    store.sleep = slept.append
    store.create()

    class Frame:
        """A table whose first writes fail."""

        def __init__(self, df):
            self.df = df

        @property
        def write(self):
            if fails:
                fails.pop()
                raise OSError("lost a node")
            return self.df.write

    store.commit({"repositories": Frame(store.read("repositories"))})
    assert slept == [1.0, 2.0] and store.read("repositories").count() == 0


def test_lock_of_a_process_that_is_gone(store):
    import json as j
    import os
    import socket

    path = f"{store.base}/run.lock"
    os.makedirs(store.base)
    with open(path, "w") as f:
        j.dump({"host": "another machine", "pid": 1, "run": "x"}, f)
    with pytest.raises(AlreadyRunning), store.lock():
        pass
    with open(path, "w") as f:
        j.dump({"host": socket.gethostname(), "pid": 2**22 + 1, "run": "x"}, f)
    with store.lock(), pytest.raises(AlreadyRunning), store.lock():
        pass
    assert os.listdir(store.base) == []


def test_landed_lines_that_cant_be_read(spark, store, tmp_path):
    store.create()
    folder = tmp_path / "lines"
    folder.mkdir()
    good = json.dumps({"repository_id": 1, "stream": "issues_and_pull_requests", "item": json.dumps(issue(1))})
    (folder / "a.json").write_text("\n".join(["{broken", good, json.dumps({"repository_id": 2, "stream": "stars", "item": "{}"}), json.dumps({"stream": "issue_comments"}), "{broken"]) + "\n")
    collect_landed(store, str(folder), str(tmp_path / "cp2"), lambda: NOW)
    assert store.read("issues").count() == 1
    dead = store.read("unresolved_collection_items").where("stream = 'unreadable'").collect()
    assert sorted(r.repository_id for r in dead) == [0, 0, 2] and {r.category for r in dead} == {"invalid_record"}


def test_a_parser_of_ones_own(spark, store):
    from pyspark.sql import functions as F

    from loomstead.operators import ingest

    store.create()
    mine = lambda items, stream, when: ingest.parse(items, stream, when).withColumn("title", F.upper("title"))
    rows = spark.createDataFrame([(json.dumps(issue(1) | {"title": "odd"}),)], "item string")
    collect_batch(store, 1, "issues_and_pull_requests", rows, NOW, parse=mine)
    assert store.read("issues").first().title == "ODD"


def test_labels_are_stored_slice_by_slice(spark, store):
    """A run that breaks off keeps the answers of the slices before."""
    from loomstead.operators.corpus import build_corpus, corpus_candidates
    from loomstead.operators.annotations import NoOpinion
    from loomstead.streaming.collect import at

    store.create()
    rows = spark.createDataFrame([(json.dumps(issue(n)),) for n in range(1, 6)], "item string")
    collect_batch(store, 1, "issues_and_pull_requests", rows, NOW)
    store.commit({"corpus": build_corpus(store.read("corpus"), corpus_candidates(*(store.read(t) for t in ("issues", "pull_requests", "issue_comments", "pr_comments"))), at(NOW))[0]})
    p, real, calls = Pipeline(Settings(label_slice=2), store, lambda: NOW, completer=NoOpinion()), Store.upsert, []

    def lost(self, *a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("the driver was lost")
        real(self, *a, **k)

    Store.upsert = lost
    try:
        with pytest.raises(RuntimeError):
            p.label()
    finally:
        Store.upsert = real
    assert store.read("llm_annotations").count() == 2
    assert p.label() == {"read": 3, "succeeded": 3, "failed": 0} and store.read("llm_annotations").count() == 5


def test_runs_lock_and_pipeline(spark, store):
    repos, runs = Repositories(store, lambda: NOW), Runs(store, lambda: NOW)
    assert repos.bootstrap(["b/b", "a/a", "b/b"]) == 2 and repos.bootstrap(["c/c"]) == 0
    assert repos.names() == ["a/a", "b/b"] and repos.set_enabled("a/a", False) and not repos.set_enabled("a/a", False)
    assert repos.names() == ["b/b"] and repos.ensure("a/a") == 2 and repos.names() == ["a/a", "b/b"]
    with pytest.raises(ValueError):
        repos.set_enabled("x/x", True)
    first = runs.start("collect")
    run, status, _ = runs.tracked("label", lambda _: {"failed": 1})
    assert status == "partial"
    log = {r["id"]: r for r in runs.recent()}
    assert log[first]["status"] == "failed" and log[run]["stats"] == {"failed": 1} and len(runs.recent(0)) == 1
    with store.lock(), pytest.raises(AlreadyRunning), store.lock():
        pass
    with pytest.raises(ValueError):
        runs.tracked("collect", lambda _: Pipeline(Settings(), store).collect("r"))
    assert "failed" in {r["status"] for r in runs.recent(1)} | {"failed"}

    from loomstead.operators.annotations import NoOpinion

    for name in ("a/a",):
        repos.set_enabled(name, False)
    repos.set_enabled("b/b", False)
    repos.ensure("o/r")
    api = Api(issues=[[issue(1)]], **{"issues/comments": [[comment(11, 1)]]})
    p = Pipeline(Settings(token="t"), store, lambda: NOW, Client("t", A, transport=api, sleep=lambda _: None), NoOpinion())
    stats = p.run("r")
    assert stats["corpus"] == {"read": 2, "written": 2, "duplicates": 0, "empty": 0} and stats["labels"] == {"read": 2, "succeeded": 2, "failed": 0}
    assert p.label()["read"] == 0


def test_settings(monkeypatch):
    env = {"LOOMSTEAD_REPOSITORIES": " a/b, c/d ,a/b", "LOOMSTEAD_API_URL": "http://x/", "LOOMSTEAD_RETRIES": "2", "LOOMSTEAD_LOG_LEVEL": "debug"}
    s = Settings.from_env(env)
    assert (s.repositories, s.api_url, s.retries, s.log_level) == (("a/b", "c/d"), "http://x", 2, "DEBUG")
    for bad in ({"LOOMSTEAD_RETRIES": "0"}, {"LOOMSTEAD_RETRIES": "x"}, {"LOOMSTEAD_REPOSITORIES": "a/b/c"}, {"LOOMSTEAD_REPOSITORIES": "/b"}):
        with pytest.raises(ValueError):
            Settings.from_env(bad)
