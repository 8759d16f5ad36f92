"""Versioned Parquet tables below one root folder, and the run log.

A version of a table is a list of parts, folders of Parquet files that are never changed once
written. Versions become current by one new record file, so readers never see half a write, a
failed build leaves the old versions in place, and no job overwrites what it reads. Record
files are numbered and created only if absent: of two writers that start from the same state
one is refused.

Tables with a declared partition column have a part per value. An upsert writes parts of the
values it touches and lists the other parts again as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from parcelhouse.operators.digest import multiset_digest
from parcelhouse.operators.upsert import not_replaced
from parcelhouse.sources.shared_files import data_files, listed, put_if_absent, remove
from parcelhouse.tables import TABLES

RECORD = (
    "sequence bigint, run_id bigint, kind string, table string, part string, path string, "
    "rows bigint, files bigint, sum_1 decimal(38,0), sum_2 decimal(38,0), checked boolean"
)
RUN_EVENT = (
    "run_id bigint, started_at timestamp, finished_at timestamp, status string, "
    "failed_step string, error_message string, duration_seconds decimal(10,1), "
    "rows_loaded bigint, warnings int, event int, recorded_at timestamp"
)
# Versions are written once and read often, so they take the denser codec and, of whole numbers,
# moments and texts with many values, the differences.
DENSE = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
# The number of the last record a run can have: that another run took its place.
TAKEN_OVER = 1_000_000


class Outdated(Exception):
    """Another writer has published since this one read the state of the store."""


class RunInProgress(Exception):
    """Another run holds the store."""


@dataclass(frozen=True)
class Part:
    """A folder of files, what it holds, and the value of the partition column (or '').

    `checked` says that its rows were held to the declared rules when it was published.
    """

    value: str
    path: str
    rows: int
    files: int
    sums: tuple[int, int]
    checked: bool = False


@dataclass(frozen=True)
class Draft:
    """A written table version that is not current yet, and what was counted on the way.

    `arrived` holds the rows that came in, and those of touched parts that remain beside them.
    """

    parts: tuple[Part, ...]
    arrived: tuple[Part, ...]
    measures: dict[str, int]

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    @property
    def unchecked(self) -> tuple[Part, ...]:
        """Older parts that this version lists again and that were never checked."""
        return tuple(p for p in self.parts if not p.checked and p not in self.arrived)

    def passed(self) -> Draft:
        """The same draft after its parts were checked."""
        return replace(self, parts=tuple(replace(p, checked=True) for p in self.parts))


def _by_value(parts: Iterable[Part]) -> dict[str, list[Part]]:
    found: dict[str, list[Part]] = {}
    for part in parts:
        found.setdefault(part.value, []).append(part)
    return found


def _content(parts: list[Part]) -> tuple[int, int, int]:
    """Digests of parts add up to the digest of their rows together."""
    return (sum(p.rows for p in parts), sum(p.sums[0] for p in parts),
            sum(p.sums[1] for p in parts))


class Store:
    def __init__(self, spark: SparkSession, root: str, run_id: int = 0):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        self._log = f"{self.root}/_published"
        self.current: dict[str, tuple[Part, ...]] = {}
        self._sequence = max([int(name[:-5]) for name, _, _ in listed(spark, self._log)], default=0)
        latest = self._versions().where("version = 1").drop("version").collect()
        found: dict[str, list[Part]] = {}
        for r in latest:  # a row per table and part of the current versions
            parts = found.setdefault(r["table"], [])
            if r["path"] is not None:
                parts.append(Part(r["part"], r["path"], r["rows"], r["files"],
                                  (int(r["sum_1"]), int(r["sum_2"])), bool(r["checked"])))
        self.current = {name: tuple(parts) for name, parts in found.items()}

    def _records(self) -> DataFrame:
        if not self._sequence:
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).json(self._log)

    def _versions(self) -> DataFrame:
        """The records of table versions, numbered per table from the newest."""
        newest = Window.partitionBy("table").orderBy(F.desc("sequence"))
        return self._records().where("kind = 'table'").withColumn(
            "version", F.dense_rank().over(newest))

    def has(self, name: str) -> bool:
        return name in self.current

    def _folder(self, name: str) -> str:
        return name.replace(".", "/")

    def read_parts(self, name: str, parts: Iterable[Part], with_partition: bool = False) -> DataFrame:
        """The rows of some parts, with the partition column if asked for.

        The declared schema spares the job that would read it from the files.
        """
        schema, column = TABLES[name].schema, TABLES[name].partition
        paths = [f"{self.root}/{p.path}" for p in parts]
        if with_partition:
            schema = schema.add(column, "integer")
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if with_partition:
            reader = reader.option("basePath", f"{self.root}/{self._folder(name)}")
        return reader.parquet(*paths).select(*schema.names)

    def read(self, name: str, drafts: Mapping[str, Draft] | None = None) -> DataFrame:
        """The current version of a table, or its draft if there is one."""
        draft = (drafts or {}).get(name)
        return self.read_parts(name, draft.parts if draft else self.current[name])

    def write(
        self, name: str, df: DataFrame, measures: dict[str, Column] | None = None
    ) -> Draft:
        """Write a draft version. Rows and any further aggregates are taken while writing.

        A table with a partition column is dealt by it first. Rebalancing splits a value with
        much of the table over several files and puts small ones together.
        """
        column = TABLES[name].partition
        path, counted, taken = self._save(name, df, measures, bool(column))
        if column:
            parts = self._parts_below(name, path) if counted["rows"] else ()
        else:
            sums = (int(counted["sum_1"]), int(counted["sum_2"]))
            parts = (Part("", path, counted["rows"], data_files(self.spark, f"{self.root}/{path}"), sums),)
        return Draft(parts, parts, taken)

    def _save(
        self, name: str, df: DataFrame, measures: dict[str, Column] | None, dealt: bool
    ) -> tuple[str, dict, dict[str, int]]:
        """The new folder rows were written to, what was counted on the way, and the measures."""
        column, names = TABLES[name].partition, TABLES[name].names
        path = f"{self._folder(name)}/version=v{uuid4().hex}"
        digest = {} if column else multiset_digest(names)
        wanted = {f"m{i}": a for i, a in enumerate((measures or {}).values())}
        wanted |= digest or {"rows": F.count(F.lit(1))}
        seen = Observation()
        writer = df.observe(seen, *[a.alias(label) for label, a in wanted.items()])
        if dealt:
            writer = writer.hint("rebalance", column).write.partitionBy(column)
        else:
            writer = writer.write
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").options(
            **DENSE).parquet(f"{self.root}/{path}")
        counted = self._observed(seen, wanted, name, path)
        return path, counted, {label: counted[f"m{i}"] for i, label in enumerate(measures or {})}

    def _observed(self, seen: Observation, wanted: Iterable[str], name: str, path: str) -> dict:
        """What was counted. A plan that turns out empty on the way loses its observation."""
        try:
            return seen.get
        except Py4JJavaError:
            if data_files(self.spark, f"{self.root}/{path}") and not self.spark.read.schema(
                    TABLES[name].schema).parquet(f"{self.root}/{path}").isEmpty():
                raise
            return dict.fromkeys(wanted, 0)

    def _parts_below(self, name: str, path: str) -> tuple[Part, ...]:
        """The parts of a draft that was dealt by the partition column: one per value."""
        column, found = TABLES[name].partition, []
        for value, (rows, *sums) in self._contents(name, self._saved(name, path)).items():
            folder = f"{path}/{column}={value}"
            files = data_files(self.spark, f"{self.root}/{folder}")
            found.append(Part(value, folder, rows, files, tuple(sums)))
        return tuple(sorted(found, key=lambda p: p.value))

    def _saved(self, name: str, path: str) -> DataFrame:
        """The rows below a folder, with the partition column."""
        schema = TABLES[name].schema.add(TABLES[name].partition, "integer")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")

    def _contents(
        self, name: str, rows: DataFrame, more: Iterable[Column] = ()
    ) -> dict[str, tuple[int, ...]]:
        """The digest of the rows of each value of the partition column, and further counts."""
        digest = [a.alias(label) for label, a in multiset_digest(TABLES[name].names).items()]
        counted = rows.groupBy(TABLES[name].partition).agg(*digest, *more).collect()
        return {str(value): tuple(map(int, content)) for value, *content in counted}

    def differs(self, name: str, draft: Draft) -> bool:
        """Whether a draft holds other rows than the current version."""
        return not self.has(name) or _content([*draft.parts]) != _content([*self.current[name]])

    def _linked(
        self, name: str, incoming: DataFrame, measures: dict[str, Column] | None
    ) -> Draft | None:
        """What a merge gives if all that comes in is stored already, else None; writes nothing."""
        column, labels = TABLES[name].partition, list(measures or {})
        taken = [a.alias(f"m{i}") for i, a in enumerate((measures or {}).values())]
        found = self._contents(name, incoming.withColumn(column, F.col(column).cast("int")), taken)
        old = _by_value(self.current[name])
        if any(v not in old or _content(old[v]) != content[:3] for v, content in found.items()):
            return None
        counted = {label: sum(c[3 + i] for c in found.values()) for i, label in enumerate(labels)}
        return Draft(self.current[name], tuple(p for v in sorted(found) for p in old[v]), counted)

    def merge(
        self, name: str, incoming: DataFrame, measures: dict[str, Column] | None = None,
        expect_same: bool = False,
    ) -> Draft:
        """Upsert by the declared key into a table with a partition column.

        If the rows are expected to be those that are stored, they are compared before anything is
        written. Else, or if they are not, incoming rows are first written as they come and compared value by value; only the values
        that differ are then dealt by the partition column. The first copy is removed.

        Values whose rows come in as they are stored stay untouched. Of the others, only those
        that hold an incoming key are touched, also where the key moved to another value:
        what remains of them is written anew beside the incoming rows. All other parts are
        listed again. Incoming keys must be unique; audits.py checks that.
        """
        if not self.has(name):
            return self.write(name, incoming, measures)
        if expect_same and (linked := self._linked(name, incoming, measures)):
            return linked
        key, column = list(TABLES[name].key), TABLES[name].partition
        path, counted, taken = self._save(
            name, incoming.withColumn(column, F.col(column).cast("int")), measures, dealt=False)
        came = self._saved(name, path)
        new = self._contents(name, came) if counted["rows"] else {}
        old = _by_value(self.current[name])
        same = {v for v in new if v in old and _content(old[v]) == new[v]}
        brought: tuple[Part, ...] = ()
        if len(same) < len(new):
            linked_again = F.coalesce(F.col(column).isin([int(v) for v in same]), F.lit(False))
            brought = self.write(name, came.where(~linked_again) if same else came).parts
        open_parts = [p for v in old if v not in same for p in old[v]]
        touched: set[str] = set()
        if brought and open_parts:
            keys = self.read_parts(name, brought).select(*key)
            held = self.read_parts(name, open_parts, True).select(column, *key)
            hit = held.join(keys, key, "left_semi").select(column).distinct()
            touched = {str(r[column]) for r in hit.collect()}
        remaining: tuple[Part, ...] = ()
        if touched:
            held = self.read_parts(name, [p for v in touched for p in old[v]], True)
            remaining = self.write(name, not_replaced(held, keys, key)).parts
        remove(self.spark, f"{self.root}/{path}")
        linked = [p for v in old if v not in touched for p in old[v]]
        arrived = (*remaining, *brought, *[p for v in sorted(same) for p in old[v]])
        return Draft((*linked, *remaining, *brought), arrived, taken)

    def write_all(
        self,
        frames: Mapping[str, Callable[[], DataFrame]],
        measures: Callable[[str], dict[str, Column]] | None = None,
        merge: bool = False,
        at_once: int = 8,
        expect_same: bool = False,
    ) -> dict[str, Draft]:
        """Plan and write drafts side by side: small tables do not fill a cluster alone."""

        def write(name: str) -> Draft:
            wanted = measures(name) if measures else None
            if merge and TABLES[name].partition:
                return self.merge(name, frames[name](), wanted, expect_same)
            return self.write(name, frames[name](), wanted)

        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(frames, pool.map(write, frames)))

    def publish(self, drafts: Mapping[str, Draft], kind: str = "table") -> None:
        """Make drafts current, all of them or none: the record is a single file.

        Its number is the next after the last this store has seen. If a file of that number
        exists, another writer came first, and this one stops.
        """
        records = []
        for name, draft in drafts.items():
            for p in draft.parts or [None]:
                record = {"kind": kind, "table": name}
                if p:
                    record |= {"part": p.value, "path": p.path, "rows": p.rows, "files": p.files,
                               "sum_1": p.sums[0], "sum_2": p.sums[1], "checked": p.checked}
                records.append(record)
        self._record(records)
        self.current.update({name: draft.parts for name, draft in drafts.items()})

    def _record(self, records: list[dict]) -> None:
        number = self._sequence + 1
        stamped = [{"sequence": number, "run_id": self.run_id, **r} for r in records]
        if not put_if_absent(self.spark, f"{self._log}/{number:012d}.json", stamped):
            raise Outdated(f"record {number} of {self.root} was published by another writer")
        self._sequence = number

    def fence(self) -> None:
        """Publish nothing, so that a writer from before this one is refused from now on."""
        self._record([{"kind": "run"}])

    def history(self) -> DataFrame:
        """Per table: versions published, versions kept, and rows and parts of the current one."""
        gone = self._records().where("kind = 'expired'").groupBy("table").agg(
            F.max("rows").alias("gone_below"))
        return (
            self._versions().join(gone, "table", "left").groupBy("table")
            .agg(
                F.count_distinct("sequence").alias("versions"),
                F.count_distinct(F.when(
                    F.col("sequence") >= F.coalesce("gone_below", F.lit(0)), F.col("sequence"))
                ).alias("versions_kept"),
                F.coalesce(F.sum(F.when(F.col("version") == 1, F.col("rows"))), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("version") == 1, F.col("files"))), F.lit(0)).alias("files"),
            )
        )

    def _live(self, keep: int) -> tuple[dict[str, set[str]], dict[str, int]]:
        """Paths that the newest `keep` versions list, and the oldest of these versions."""
        live: dict[str, set[str]] = {}
        oldest: dict[str, int] = {}
        kept = self._versions().where(F.col("version") <= keep)
        for r in kept.select("table", "path", "sequence").distinct().collect():
            live.setdefault(r["table"], set()).add(r["path"])
            oldest[r["table"]] = min(oldest.get(r["table"], r["sequence"]), r["sequence"])
        return live, oldest

    def unreachable(self, keep: int) -> list[str]:
        """Folders of parts and drafts that none of the newest `keep` versions lists."""
        live, _ = self._live(keep)
        found = []
        for name in TABLES:
            if name.startswith("meta."):
                continue
            paths = live.get(name, set())
            for version, _, _ in listed(self.spark, f"{self.root}/{self._folder(name)}"):
                folder = f"{self._folder(name)}/{version}"
                if folder in paths:
                    continue
                below = [] if not TABLES[name].partition else [
                    f"{folder}/{value}" for value, _, _ in listed(self.spark, f"{self.root}/{folder}")]
                dead = [p for p in below if p not in paths]
                found += [folder] if len(dead) == len(below) else dead
        return found

    def expire(self, keep: int) -> int:
        """Remove what only versions before the newest `keep` of a table list, and old drafts.

        To be called by the one writer, as it takes every draft for abandoned. Which versions
        are gone is recorded first. Returns how many folders were removed.
        """
        if keep < 1:
            raise ValueError("the current version must be kept")
        _, oldest = self._live(keep)
        dead = self.unreachable(keep)
        self._record([{"kind": "expired", "table": t, "rows": s} for t, s in oldest.items()])
        for folder in dead:
            remove(self.spark, f"{self.root}/{folder}")
        return len(dead)


class RunLog:
    """A record when a run starts, one per step, and a final one; the last one is its state.

    A run claims the next number by creating a file of that name, which only one can. While
    the run before it is neither finished nor silent for `stale_after`, none may start.
    """

    def __init__(self, spark: SparkSession, root: str, stale_after: timedelta = timedelta(hours=12)):
        self.spark, self.stale_after = spark, stale_after
        self.path = f"{root.rstrip('/')}/meta/pipeline_runs"
        self._claims = f"{root.rstrip('/')}/meta/claims"
        self._event = 0

    def _last(self) -> DataFrame:
        if not listed(self.spark, self.path):
            events = self.spark.createDataFrame([], RUN_EVENT)
        else:
            events = self.spark.read.schema(RUN_EVENT).json(self.path)
        names = [n for n in events.columns if n not in ("run_id", "event")]
        last = F.max_by(F.struct(*names), "event").alias("state")
        return events.groupBy("run_id").agg(last).select("run_id", "state.*")

    def runs(self) -> DataFrame:
        """The current state of every run. A killed run stays `running` until the next starts."""
        return self._last().select(*TABLES["meta.pipeline_runs"].names)

    def start(self, take_over: bool = False) -> tuple[int, datetime]:
        """Claim the store; refused while another run holds it, unless told to take over."""
        started = datetime.now(timezone.utc)
        claims = listed(self.spark, self._claims)
        last, seen = (int(claims[-1][0]), claims[-1][2] / 1e3) if claims else (0, 0.0)
        before = self._last().where(F.col("run_id") == last).select(
            "status", *[F.unix_micros(c).alias(c) for c in ("started_at", "recorded_at")]).first()
        holds = bool(last) and (before is None or before["status"] == "running")
        began = started
        if before is not None:
            seen = before["recorded_at"] / 1e6
            began = datetime.fromtimestamp(before["started_at"] / 1e6, timezone.utc)
        silent = started.timestamp() - seen
        if holds and not take_over and silent < self.stale_after.total_seconds():
            raise RunInProgress(f"run {last} is in progress, last seen {silent:.0f} s ago")
        run_id = last + 1
        if not put_if_absent(self.spark, f"{self._claims}/{run_id:09d}", [{"at": started}]):
            raise RunInProgress(f"run {run_id} has just started")
        if holds:
            self._append(last, began, "failed", started, "Taken over",
                         f"taken over by run {run_id}", event=TAKEN_OVER)
        self._event = 0
        self._append(run_id, started, "running")
        return run_id, started

    def step(self, run_id: int, started: datetime) -> None:
        """Show that the run is alive."""
        self._append(run_id, started, "running")

    def finish(self, run_id: int, started: datetime, status: str, rows_loaded: int,
               warnings: int, failed_step: str | None = None, error: str | None = None) -> None:
        finished = datetime.now(timezone.utc)
        seconds = Decimal(f"{(finished - started).total_seconds():.1f}")
        self._append(run_id, started, status, finished, failed_step, error, seconds,
                     rows_loaded, warnings)

    def _append(self, run_id, started, status, finished=None, failed_step=None, error=None,
                seconds=None, rows_loaded=None, warnings=None, event=None):
        if event is None:
            event, self._event = self._event, self._event + 1
        now = datetime.now(timezone.utc)
        values = (run_id, started, finished, status, failed_step, error,
                  None if seconds is None else float(seconds), rows_loaded, warnings, event, now)
        names = [c.split()[0] for c in RUN_EVENT.split(", ")]
        record = {n: v.isoformat() if isinstance(v, datetime) else v for n, v in zip(names, values)}
        put_if_absent(self.spark, f"{self.path}/{run_id:09d}-{event:07d}.json", [record])
