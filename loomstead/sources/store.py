"""Tables as immutable snapshots behind one manifest: several tables change together or not at all.

A commit writes new snapshot folders and then adds the next manifest in one step. Readers see the old or the new state,
never a mix; a failure before that leaves nothing but folders nobody refers to. Manifests and the lock are small files on
a path the driver can write; snapshots may be on any file system Spark reads.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import socket
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstead.operators.upsert import broken_unique, upsert, with_ids
from loomstead.schemas import ALSO_UNIQUE, KEYS, TABLES, UPDATES
from loomstead.sources.shared import Cuts


class AlreadyRunning(RuntimeError):
    pass


class BrokenKey(RuntimeError):
    pass


class Conflict(RuntimeError):
    pass


#: How the JVM says that a write failed, which may pass, as an OSError may.
PASSING = (OSError, Py4JJavaError)


class Store:
    """Tables of one folder. ``manifest-N.json`` files name the snapshots; the highest number counts.

    A commit creates the next number, which fails if another writer was first: then its changes are put on top of that one's,
    or, where both changed a table, it ends with ``Conflict``. Older manifests stay, so readers keep what they began with.
    """

    def __init__(self, spark: SparkSession, base: str, retries: int = 3, sleep: Callable[[float], None] = time.sleep):
        self.spark, self.base, self.retries, self.sleep = spark, base.rstrip("/"), retries, sleep

    def _newest(self) -> tuple[int, dict[str, str]]:
        numbers = [int(m[1]) for f in (os.listdir(self.base) if os.path.isdir(self.base) else ()) if (m := re.fullmatch(r"manifest-(\d+)\.json", f))]
        if not numbers:
            return 0, {}
        with open(f"{self.base}/manifest-{max(numbers):012d}.json") as f:
            return max(numbers), json.load(f)

    def versions(self) -> dict[str, str]:
        return self._newest()[1]

    def _again(self, work: Callable):
        """``work()``, tried again after failures that may pass."""
        for attempt in range(self.retries + 1):
            try:
                return work()
            except PASSING:
                if attempt == self.retries:
                    raise
                self.sleep(min(8.0, 2.0**attempt))

    def create(self) -> None:
        """Create the tables that don't exist; those that do keep their rows."""
        have = self.versions()
        self.commit({t: self.spark.createDataFrame([], s) for t, s in TABLES.items() if t not in have})

    def read(self, table: str) -> DataFrame:
        version = self.versions().get(table)
        if version is None:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.base}/{version}")

    def commit(self, tables: dict[str, DataFrame | None]) -> None:
        """Write new snapshots of ``tables`` and switch to all of them at once, tried again after failures that may pass.

        None stands for a table that stays as it is. A snapshot whose write failed is left behind and written anew.
        """
        tables = {name: df for name, df in tables.items() if df is not None}
        if not tables:
            return
        seen = self.versions()

        def write(name: str) -> str:
            folder = f"{name}/{uuid.uuid4().hex}"
            tables[name].write.parquet(f"{self.base}/{folder}")
            return folder

        written = {name: self._again(lambda name=name: write(name)) for name in tables}
        self._again(lambda: self._switch(seen, written))

    def _switch(self, seen: dict[str, str], written: dict[str, str]) -> None:
        os.makedirs(self.base, exist_ok=True)
        new = f"{self.base}/{uuid.uuid4().hex}.tmp"
        while True:
            number, now = self._newest()
            if both := [t for t in written if now.get(t) != seen.get(t)]:
                raise Conflict(f"another writer changed {both}")
            with open(new, "w") as f:
                json.dump(now | written, f, indent=1, sort_keys=True)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(new, f"{self.base}/manifest-{number + 1:012d}.json")  # whole, and only if it isn't there
                return
            except FileExistsError:
                continue
            finally:
                os.unlink(new)

    def merged(self, table: str, batch: DataFrame, order: list | None = None) -> DataFrame | None:
        """The table after the batch: keyed merge, ids for new rows, second unique key checked. None after an empty batch."""
        if batch.isEmpty():
            return None
        base = self.read(table)
        cuts = Cuts(self.spark, f"merge-{table}")
        out = upsert(base, batch, KEYS[table], UPDATES.get(table, ()), order)
        if dict(base.dtypes)["id"] == "bigint":
            out = with_ids(base, out, [*KEYS[table]], cuts)
        out = cuts.cut(out, "merged")
        if also := ALSO_UNIQUE.get(table):
            if bad := broken_unique(out, also).limit(3).collect():
                raise BrokenKey(f"{table}: several rows for {also} {[tuple(r)[:-1] for r in bad]}")
        return out

    def upsert(self, order: list | None = None, **batches: DataFrame) -> None:
        """Merge batches into several tables in one commit."""
        self.commit({t: self.merged(t, b, order) for t, b in batches.items()})

    @contextlib.contextmanager
    def lock(self) -> Iterator[None]:
        """Only one run at a time; a second one fails at once. The lock of a process that is gone from this machine is taken over."""
        os.makedirs(self.base, exist_ok=True)
        path, owner = f"{self.base}/run.lock", {"host": socket.gethostname(), "pid": os.getpid(), "run": uuid.uuid4().hex}
        own = f"{path}.{owner['run']}"
        with open(own, "w") as f:
            json.dump(owner, f)
        try:
            self._take(path, own)
            yield
        finally:
            if self._owner(path) == owner:
                os.unlink(path)
            os.unlink(own)

    def _take(self, path: str, own: str) -> None:
        try:
            os.link(own, path)
        except FileExistsError:
            held = self._owner(path)
            if held is not None and not self._gone(held):
                raise AlreadyRunning("another run holds the lock") from None
            aside = f"{own}.old"
            with contextlib.suppress(FileNotFoundError):
                os.rename(path, aside)  # of several takers one gets it
                taken = self._owner(aside)
                if taken != held:  # a new owner's lock, not the one that was judged: it goes back
                    with contextlib.suppress(FileExistsError):
                        os.link(aside, path)
                os.unlink(aside)
            try:
                os.link(own, path)
            except FileExistsError:
                raise AlreadyRunning("another run took the lock over") from None

    @staticmethod
    def _owner(path: str) -> dict | None:
        try:
            with open(path) as f:
                return json.load(f)
        except (OSError, ValueError):
            return None

    @staticmethod
    def _gone(owner: dict) -> bool:
        """Whether the owner was a process of this machine that has ended; of others that can't be told."""
        if owner.get("host") != socket.gethostname():
            return False
        try:
            os.kill(int(owner["pid"]), 0)
            return False
        except (ProcessLookupError, KeyError, ValueError):
            return True
        except OSError:
            return False


def next_id(df: DataFrame) -> int:
    return (df.agg(F.max("id")).first()[0] or 0) + 1
