"""Which files the tables of a lake are made of.

A write puts a table's rows into a new folder, ``<root>/<zone>/<table>/<version>``, that
never changes or moves afterwards. What a reader sees is said by records in
``<root>/manifest``: JSON files of one row each, added last and never changed, so
a table is switched by the appearance of one small file. Nothing is renamed or deleted, so there is no
moment without the table, on an object store either.

A record names one run and stage and lists (zone, table, path, row_count). Its kind is

* ``commit``: from now on readers see these versions, all of them at once. Of two commits
  of a table the one with the larger ``seq`` holds;
* ``start``: the versions that a stage reads, fixed when it began;
* ``table``: a finished table of a stage that is not committed yet. A resumed run
  takes it as it is.

A reader resolves a ``Snapshot`` once and reads every table through it: a run that commits
meanwhile changes nothing for that reader. One run at a time should write a lake: with two, both
finish, and the later commit holds for the tables it lists.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("seq long, run string, stage string, kind string, written_at string, "
          "entries array<struct<zone: string, table: string, path: string, row_count: long>>")


@dataclass(frozen=True)
class Entry:
    """One version of a table."""
    zone: str
    table: str
    path: str
    row_count: int


@dataclass(frozen=True)
class Snapshot:
    """The versions that a reader sees, by (zone, table)."""
    entries: Mapping[tuple[str, str], Entry] = field(default_factory=dict)

    def get(self, zone: str, table: str) -> Entry | None:
        return self.entries.get((zone, table))

    def zone(self, zone: str) -> list[Entry]:
        return [e for e in self.entries.values() if e.zone == zone]


def new_version() -> str:
    """A folder name that starts with the time, in UTC."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def records(spark: SparkSession, root: str) -> DataFrame:
    """All records of a lake; none where nothing was written yet."""
    try:
        return spark.read.schema(SCHEMA).json(f"{root.rstrip('/')}/manifest/*").where("kind IS NOT NULL")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The newest commit of each table: one grouping, a row for each table to the driver."""
    newest = (records(spark, root).where("kind = 'commit'")
              .select("seq", "run", F.explode("entries").alias("e"))
              .groupBy("e.zone", "e.table").agg(F.max_by("e", F.struct("seq", "run")).alias("e")))
    return Snapshot({(r.e.zone, r.e.table): Entry(**r.e.asDict()) for r in newest.collect()})


def add(spark: SparkSession, root: str, run: str, stage: str, kind: str, entries: Iterable[Entry]) -> None:
    """Add a record. A commit's ``seq`` is one more than the largest so far."""
    seq = 0
    if kind == "commit":
        seq = 1 + (records(spark, root).agg(F.max("seq")).first()[0] or 0)
    row = (seq, run, stage, kind, datetime.now(timezone.utc).isoformat(),
           [(e.zone, e.table, e.path, e.row_count) for e in entries])
    # a folder for each record: writers never share an output folder
    (spark.createDataFrame([row], SCHEMA).coalesce(1)
     .write.mode("errorifexists").json(f"{root.rstrip('/')}/manifest/{new_version()}"))


def commit(spark: SparkSession, root: str, entries: Iterable[Entry], run: str | None = None, stage: str = "") -> None:
    """Switch readers to ``entries``, all at once."""
    add(spark, root, run or new_version(), stage, "commit", entries)


@dataclass
class Stage:
    """A stage of a run: the versions it reads and the tables it has finished."""
    spark: SparkSession
    root: str
    run: str
    name: str
    inputs: Snapshot
    finished: dict[tuple[str, str], Entry] = field(default_factory=dict)

    def done(self, entry: Entry) -> None:
        add(self.spark, self.root, self.run, self.name, "table", [entry])
        self.finished[entry.zone, entry.table] = entry

    def commit(self, entries: Iterable[Entry]) -> None:
        commit(self.spark, self.root, entries, self.run, self.name)


def begin(spark: SparkSession, root: str, name: str, run: str | None = None) -> Stage:
    """Begin a stage, or, where ``run`` has begun it before, take it up again with the inputs it had then
    and the tables it has finished."""
    if run is not None:
        held = records(spark, root).where((F.col("run") == run) & (F.col("stage") == name)
                                          & F.col("kind").isin("start", "table")).collect()
        started = [r for r in held if r.kind == "start"]
        if started:
            inputs = min(started, key=lambda r: r.written_at).entries
            finished = [Entry(**e.asDict()) for r in held if r.kind == "table" for e in r.entries]
            return Stage(spark, root, run, name, Snapshot({(e.zone, e.table): Entry(**e.asDict()) for e in inputs}),
                         {(e.zone, e.table): e for e in finished})
    inputs, run = snapshot(spark, root), run or new_version()
    add(spark, root, run, name, "start", inputs.entries.values())
    return Stage(spark, root, run, name, inputs)


def committed_stages(spark: SparkSession, root: str, run: str) -> dict[str, list[Entry]]:
    """The stages that ``run`` has finished, with their tables."""
    rows = records(spark, root).where((F.col("run") == run) & (F.col("kind") == "commit")).collect()
    return {r.stage: [Entry(**e.asDict()) for e in r.entries] for r in rows}


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The run that began a stage last."""
    return records(spark, root).where("kind = 'start'").agg(F.max_by("run", "written_at")).first()[0]
