"""The state of the jobs as one versioned document, so that a job commits all or nothing.

  commits/<version>.json       which folders make up the state; a version is written once, by
                               the job that is first, and never changed
  target/<commit>/bucket=<n>/  rows of the keyed table (K2), by a hash of the key
  ledger/<commit>/             run-ledger events (K3)
  checkpoints/<commit>/        the watermark of every source (K4)

A commit takes the newest document, names new folders in it and writes the next version if
nobody else has. Who comes second reads the winner's document: if that left alone all that
the change was computed from (the buckets it merged into, the ledger it claimed from), the
change is put on top of it, else it is computed again. So overlapping jobs lose nothing, wait
for nobody, and a job that dies leaves folders that no document names; `vacuum` removes them.

A merge rewrites the buckets of the keys it changes, and no others; what stays of a bucket is
found by an anti join with the incoming keys, which are broadcast if their measured number
allows, so that the stored rows aren't shuffled.

The store must refuse to replace an existing file on rename (HDFS, ABFS) or have hard links
(local folders). An object store without such a rename needs a commit service in front.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingestry import schema as S
from ingestry.operators import ledger as L
from ingestry.operators import upsert as U

BUCKETS = 64  # of a new table; the documents keep the number
LEDGER_FOLDERS = 32  # the next one holds the newest row of every run, and replaces them
CLUSTERED = ("school_id", "enrollment_status")
BROADCAST_KEYS = 250_000  # keys of at most 64 characters: some 25 MB

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("phase", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_object_id", T.StringType()),
        T.StructField("source_version", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("last_chunk", T.LongType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_valid", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("content_digest", T.StringType()),
    ]
)
CHECKPOINT_SCHEMA = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("watermark", T.TimestampType()),
     T.StructField("updated_at", T.TimestampType())]
)


def beside(n: int) -> Callable[[DataFrame], DataFrame]:
    """Marks a side of `n` rows, one a key, for a broadcast if that number allows."""
    return F.broadcast if n <= BROADCAST_KEYS else (lambda df: df)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Written once under the run's own folder, then read: later steps share it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """The few file operations of a commit, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._root = self._path(root)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time in ms) of what lies in a folder; none if there is no folder."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(path)]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """The file appears whole, or not at all if there is one of that name."""
        folder, _, last = name.rpartition("/")
        draft = self._path(f"{folder}/.{last}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if self._fs.getScheme() != "file":
                return bool(self._fs.rename(draft, self._path(name)))
            own, final = (self._jvm.java.io.File(self._fs.makeQualified(p).toUri().getPath()).toPath() for p in (draft, self._path(name)))
            try:
                self._jvm.java.nio.file.Files.createLink(final, own)
            except Exception as failure:  # noqa: BLE001 - Py4J wraps all of Java's
                if "FileAlreadyExistsException" not in str(failure):
                    raise
                return False
            return True
        finally:
            self._fs.delete(draft, False)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@dataclass(frozen=True)
class Head:
    """One version of the state: names of folders."""

    version: int = 0
    buckets: int = BUCKETS
    target: dict[int, str] = field(default_factory=dict)
    target_version: int = 0
    ledger: tuple[str, ...] = ()
    checkpoints: str | None = None

    def text(self, now_ms: int) -> str:
        return json.dumps({**self.__dict__, "at": now_ms})

    @staticmethod
    def of(text: str) -> Head:
        found = json.loads(text)
        found.pop("at")
        return Head(**found | {"target": {int(b): f for b, f in found["target"].items()}, "ledger": tuple(found["ledger"])})


@dataclass
class Change:
    """New folders, and what they were computed from."""

    target: dict[int, str] = field(default_factory=dict)
    ledger: tuple[str, ...] = ()
    drops: tuple[str, ...] = ()  # ledger folders that the new one replaces
    checkpoints: str | None = None
    read_buckets: frozenset[int] = frozenset()
    read_ledger: bool = False

    def on(self, head: Head) -> Head:
        return Head(
            head.version + 1,
            head.buckets,
            head.target | self.target,
            head.target_version + bool(self.target),
            tuple(f for f in head.ledger if f not in self.drops) + self.ledger,
            self.checkpoints or head.checkpoints,
        )

    def holds(self, base: Head, now: Head) -> bool:
        """What it was computed from at `base` is the same at `now`."""
        return (
            all(base.target.get(b) == now.target.get(b) for b in self.read_buckets)
            and (not self.read_ledger or base.ledger == now.ledger)
            and set(self.drops) <= set(now.ledger)
            and (self.checkpoints is None or base.checkpoints == now.checkpoints)
        )


class StateStore:
    def __init__(self, spark: SparkSession, root: str, *, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets
        self._files = Files(spark, self.root)

    # -- versions
    def head(self) -> Head:
        names = [n for n, _ in self._files.names(f"{self.root}/commits") if n.endswith(".json") and not n.startswith(".")]
        return Head.of(self._files.read(f"{self.root}/commits/{max(names)}")) if names else Head(buckets=self._buckets)

    def commit(self, build: Callable[[Head], Change | None]) -> Change | None:
        """`build` computes a change from a version; it is called again if that version's parts
        were replaced before the change was committed. None: there is nothing to commit."""
        base = now = self.head()
        change = build(base)
        while change is not None:
            new = change.on(now)
            if self._files.put_if_absent(f"{self.root}/commits/{new.version:020}.json", new.text(int(time.time() * 1000))):
                break
            now = self.head()
            if not change.holds(base, now):
                base = now
                change = build(base)
        return change

    def _read(self, schema: T.StructType, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _folder(self, kind: str) -> str:
        return f"{kind}/{uuid.uuid4().hex}"

    # -- the keyed table
    def target_version(self) -> int:
        return self.head().target_version

    def target(self, head: Head | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The keyed table, or those of its buckets."""
        head = head or self.head()
        wanted = sorted(head.target) if buckets is None else sorted(set(buckets) & head.target.keys())
        return self._read(S.STUDENT_SCHEMA, [f"{head.target[b]}/bucket={b}" for b in wanted])

    @staticmethod
    def bucket_sql(buckets: int) -> str:
        return f"CAST(pmod(xxhash64(student_id), {buckets}) AS INT)"

    def merge(self, head: Head, students: DataFrame, stage: str, *, as_of_sql: str, seq: tuple[str, str]) -> tuple[DataFrame, Change]:
        """W4 + J1 against one version: the action of every row of `students` (narrow: key, seq,
        source object, time, action), and the rewritten buckets.

        Of the stored rows only those in the buckets of incoming keys are read, for their time;
        only the buckets of accepted keys are read whole. Payloads join at the end, one row a key.
        """
        keys = staged(
            students.select("student_id").distinct().selectExpr("student_id", f"{self.bucket_sql(head.buckets)} AS bucket"),
            f"{stage}/keys",
        )
        size = keys.agg(F.count("*").alias("n"), F.collect_set("bucket").alias("b")).first()
        near = beside(size["n"])
        known = staged(
            self.target(head, size["b"]).select("student_id", "updated_at", "ingested_at").join(
                near(keys.select("student_id")), "student_id"
            ),
            f"{stage}/known",
        )
        narrow = students.select("student_id", *seq, S.SOURCE_OBJECT, "updated_at")
        actions = staged(U.sequential_actions(known, narrow, seq=seq), f"{stage}/actions")
        place = F.struct(*seq)
        accepted = actions.filter(F.col("action") != U.SKIPPED).groupBy("student_id").agg(F.max(place).alias("_at"))
        last = accepted.select("student_id", *[F.col(f"_at.{c}").alias(c) for c in seq])
        won = students.join(near(last), ["student_id", *seq]).join(known.selectExpr("student_id", "ingested_at AS _since"), "student_id", "left")
        written = won.selectExpr(
            *U.PAYLOAD, f"coalesce(_since, {as_of_sql}) AS ingested_at", f"{as_of_sql} AS last_written_at",
            f"{self.bucket_sql(head.buckets)} AS bucket",
        )
        written = staged(written, f"{stage}/written")
        changed = written.agg(F.collect_set("bucket")).first()[0]
        return actions, self._rewrite(head, changed, written, near, frozenset(size["b"]))

    def _rewrite(self, head: Head, changed: list[int], written: DataFrame, near, read: frozenset[int]) -> Change:
        if not changed:
            return Change(read_buckets=read)
        folder = self._folder("target")
        rows = self.kept(head, changed, near(written.select("student_id"))).unionByName(written.repartition("bucket"))
        self._write(rows, folder)
        return Change(target=dict.fromkeys(changed, folder), read_buckets=read)

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Bucket by bucket, and within it by what the reports ask for (O3), newest first: the
        column indexes of the files then let a report read its school's or status's pages only.
        The sort is within a task; it serves the bucket folders too."""
        clustered = rows.sortWithinPartitions("bucket", *CLUSTERED, F.desc("updated_at"))
        clustered.write.partitionBy("bucket").parquet(f"{self.root}/{folder}")

    def kept(self, head: Head, changed: Iterable[int], keys: DataFrame) -> DataFrame:
        """The stored rows of some buckets without those keys."""
        stored = self.target(head, changed).join(keys, "student_id", "left_anti")
        return stored.selectExpr(*S.TARGET_COLUMNS, f"{self.bucket_sql(head.buckets)} AS bucket")

    def compact(self, *, files: int = 1) -> Change | None:
        """Every bucket in `files` files: merges add a file to each bucket that they change."""

        def build(head: Head) -> Change | None:
            if not head.target:
                return None
            folder = self._folder("target")
            rows = self.target(head).selectExpr(*S.TARGET_COLUMNS, f"{self.bucket_sql(head.buckets)} AS bucket")
            spread = F.expr(f"pmod(xxhash64(student_id, 1), {files})")
            self._write(rows.repartition("bucket", spread), folder)
            return Change(target=dict.fromkeys(head.target, folder), read_buckets=frozenset(head.target))

        return self.commit(build)

    # -- ledger and watermarks
    def ledger_events(self, head: Head | None = None) -> DataFrame:
        return self._read(LEDGER_SCHEMA, (head or self.head()).ledger)

    def ledger(self, head: Head | None = None) -> DataFrame:
        return L.latest_state(self.ledger_events(head))

    def events(self, head: Head, events: DataFrame) -> Change:
        """One row per run and event; `phase` and `attempt` order them."""
        folder, rows = self._folder("ledger"), events.select(*LEDGER_SCHEMA.fieldNames())
        drops = head.ledger if len(head.ledger) >= LEDGER_FOLDERS else ()
        if drops:
            every = F.struct(*LEDGER_SCHEMA.fieldNames())
            newest = self.ledger_events(head).unionByName(rows).groupBy("run_id").agg(
                F.max_by(every, F.struct("attempt", "phase", "last_chunk")).alias("_s")
            )
            rows = newest.select("_s.*")
        rows.write.parquet(f"{self.root}/{folder}")
        return Change(ledger=(folder,), drops=drops)

    def append_ledger(self, events: DataFrame) -> None:
        self.commit(lambda head: self.events(head, events))

    def checkpoints(self, head: Head | None = None) -> DataFrame:
        found = (head or self.head()).checkpoints
        return self._read(CHECKPOINT_SCHEMA, [found] if found else [])

    def watermarks(self, head: Head, candidates: DataFrame, *, as_of_sql: str) -> str | None:
        """A folder with every source's watermark, if a candidate moves one; never backwards."""
        moved = L.advance_watermarks(self.checkpoints(head), candidates)
        if not moved.filter("advanced").limit(1).count():
            return None
        old = self.checkpoints(head).selectExpr("source", "updated_at AS _since")
        rows = moved.join(old, "source", "left").selectExpr(
            "source", "watermark", f"CASE WHEN advanced THEN {as_of_sql} ELSE _since END AS updated_at"
        )
        folder = self._folder("checkpoints")
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    # -- upkeep
    def vacuum(self, *, keep_hours: float = 168.0) -> list[str]:
        """Remove documents older than that but the last one, and the folders of that age which
        none of those left names (replaced, or left by jobs that died); returns what it removed.
        `keep_hours` must exceed the longest run and read."""
        before = (time.time() - 3600 * keep_hours) * 1000
        commits = sorted((n, t) for n, t in self._files.names(f"{self.root}/commits") if not n.endswith(".crc"))
        documents = [(n, t) for n, t in commits if not n.startswith(".")]
        old = [f"commits/{n}" for n, t in documents[:-1] if t < before]
        heads = [Head.of(self._files.read(f"{self.root}/commits/{n}")) for n, _ in documents if f"commits/{n}" not in old]
        old += [f"commits/{n}" for n, t in commits if n.startswith(".") and t < before]
        named = {f for h in heads for f in (*h.target.values(), *h.ledger, h.checkpoints)}
        for kind in ("target", "ledger", "checkpoints", "staging"):
            found = ((f"{kind}/{n}", t) for n, t in self._files.names(f"{self.root}/{kind}"))
            old += [f for f, t in found if t < before and f not in named]
        for name in old:
            self._files.delete(f"{self.root}/{name}")
        return old
