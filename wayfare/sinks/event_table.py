"""The event table's partitions: who registers them, and packing of small files.

A batch writes the partitions (``event_day``, ``ingest_batch``) of its own days. A writer
that knows the table's name registers exactly those; a writer that knows only the folder
leaves a note below ``_wayfare/pending``, which the next named scan registers and removes.
No write and no scan by name lists the table.

``compact_events`` packs the batches of closed days into one batch ``compact-...``. Readers
go by the records below ``_wayfare/compactions``: a compact batch is seen once its record
exists, and the batches it replaces are seen until then. A record is one file that appears
at once, so a reader that plans a scan sees all old files or all new ones, and a scan that
was planned before keeps its files until ``vacuum_events`` removes them.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import operator
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schemas import BATCH_COL, EVENT_FIELDS, EVENT_SCHEMA, PARTITION_COL

COMPACT = "compact-"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"   # folder name of rows without a timestamp
TARGET_FILE_BYTES = 128 * 1024 * 1024
PARTITIONS_PER_STATEMENT = 200


class Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def sizes(self, name: str) -> list[int]:
        """Bytes of each data file directly below ``name``."""
        return [s.getLen() for s in self.fs.listStatus(self._at(name))
                if s.isFile() and not s.getPath().getName().startswith(("_", "."))]

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A file that appears under its name only when it is whole."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(draft, self._at(name)):
            raise OSError(f"cannot write {name} below {self.path}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def table_location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]


def ensure_event_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K2: create the event table, partitioned by UTC day and batch, if it does not exist.

    A new table over a folder that holds events already lists that folder, once."""
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {PARTITION_COL} DATE, {BATCH_COL} STRING) "
              f"USING parquet PARTITIONED BY ({PARTITION_COL}, {BATCH_COL}){loc}")
    folder = Folder(spark, table_location(spark, name))
    folder.put("_wayfare/table", name)
    if any(n.startswith(f"{PARTITION_COL}=") for n in folder.names()):
        spark.catalog.recoverPartitions(name)


def _spec(day: str | None, batch: str) -> str:
    return f"({PARTITION_COL}={'NULL' if day is None else repr(day)}, {BATCH_COL}='{batch}')"


def register_batch(spark: SparkSession, name: str, batch: str, days: list[str | None]) -> None:
    """Make a batch's partitions known to the catalog: as many steps as it has days."""
    for at in range(0, len(days), PARTITIONS_PER_STATEMENT):
        specs = " ".join(f"PARTITION {_spec(day, batch)}" for day in days[at:at + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")


def leave_note(spark: SparkSession, path: str, batch: str, days: list[str | None]) -> None:
    """For a batch written by folder: a note for the table over that folder, if there is one."""
    folder = Folder(spark, path)
    if folder.exists("_wayfare/table"):
        folder.put(f"_wayfare/pending/{batch}.json", json.dumps(days))


def register_pending(spark: SparkSession, name: str) -> None:
    """Register the batches that were written by folder since the last time. A note goes
    after its partitions are known, so a failure in between only repeats the step."""
    folder = Folder(spark, table_location(spark, name))
    for note in folder.names("_wayfare/pending"):
        if note.endswith(".json"):
            register_batch(spark, name, note.removesuffix(".json"), json.loads(folder.read(f"_wayfare/pending/{note}")))
            folder.delete(f"_wayfare/pending/{note}")


def days_of(value) -> list[str | None]:
    return sorted((None if d is None else d.isoformat() for d in value), key=str)


# ---------------------------------------------------------------------------
# Compaction
# ---------------------------------------------------------------------------


@dataclass
class Compactions:
    """The compact batches in force and the (day, batches) they replace and that exist."""

    live: list[str] = field(default_factory=list)
    replaced: dict[str, set[str]] = field(default_factory=dict)

    def shows(self, day: str, batch: str) -> bool:
        return (not batch.startswith(COMPACT) or batch in self.live) and batch not in self.replaced.get(day, ())


def compactions(spark: SparkSession, path: str) -> Compactions:
    folder, out = Folder(spark, path), Compactions()
    names = set(folder.names("_wayfare/compactions"))
    for name in sorted(n for n in names if n.endswith(".json")):
        label = name.removesuffix(".json")
        out.live.append(label)
        if f"{label}.vacuumed" not in names:
            for day, batches in json.loads(folder.read(f"_wayfare/compactions/{name}")).items():
                out.replaced.setdefault(day, set()).update(batches)
    return out


def visible_events(events: DataFrame, state: Compactions) -> DataFrame:
    """``events`` (with their batch column) without packed batches' originals and without
    compact batches that are not in force: a filter on partition columns only."""
    if not state.live:
        return events.filter(~F.startswith(F.col(BATCH_COL), F.lit(COMPACT)))
    shown = ~F.startswith(F.col(BATCH_COL), F.lit(COMPACT)) | F.col(BATCH_COL).isin(state.live)
    hidden = [(F.col(PARTITION_COL) == F.lit(dt.date.fromisoformat(day))) & F.col(BATCH_COL).isin(sorted(batches))
              for day, batches in state.replaced.items()]
    # A row without a day is never packed; its comparison is null and must not hide it.
    return events.filter(shown & ~F.coalesce(functools.reduce(operator.or_, hidden), F.lit(False)) if hidden else shown)


@dataclass
class CompactionResult:
    label: str | None
    days: list[str]
    files_before: int
    files_after: int


def compact_events(spark: SparkSession, target: str, before, first_day=None, table: bool = False,
                   target_bytes: int = TARGET_FILE_BYTES, min_files: int = 2) -> CompactionResult:
    """Pack the files of each day from ``first_day`` (none: the oldest) up to, not including,
    ``before`` into files of about ``target_bytes``, in one job for all days.

    Days with fewer than ``min_files`` files in view, or only a compact batch of full files,
    are left alone. Rows of a day are dealt evenly to its files, whatever their keys, and
    sorted by time inside a file. Late batches of a packed day stay beside the compact one
    until the next run packs both. A run that fails leaves files that no reader sees. One
    run at a time; batches being written meanwhile are not packed."""
    path = table_location(spark, target) if table else target
    folder, state = Folder(spark, path), compactions(spark, path)
    before, first_day = str(before), "" if first_day is None else str(first_day)
    replaced, files, n_before = {}, {}, 0
    for name in folder.names():
        day = name.removeprefix(f"{PARTITION_COL}=")
        if day == name or day == NO_DAY or not first_day <= day < before:
            continue
        batches = [b.removeprefix(f"{BATCH_COL}=") for b in folder.names(name) if b.startswith(f"{BATCH_COL}=")]
        batches = [b for b in batches if state.shows(day, b)]
        sizes = [size for b in batches for size in folder.sizes(f"{name}/{BATCH_COL}={b}")]
        wanted = max(1, -(-sum(sizes) // target_bytes))
        if len(sizes) >= max(min_files, wanted + 1):
            replaced[day], files[day], n_before = batches, wanted, n_before + len(sizes)
    if not replaced:
        return CompactionResult(None, [], 0, 0)
    label = f"{COMPACT}{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex}"
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(PARTITION_COL, T.DateType()), T.StructField(BATCH_COL, T.StringType())])
    events = (spark.read.schema(schema).option("basePath", path)
              .parquet(*[f"{path}/{PARTITION_COL}={d}/{BATCH_COL}={b}" for d, bs in replaced.items() for b in bs]))
    counts = spark.createDataFrame([(dt.date.fromisoformat(d), n) for d, n in files.items()], f"{PARTITION_COL} date, _files int")
    dealt = (events.join(F.broadcast(counts), PARTITION_COL)  # one row for each packed day
             .withColumn("_file", F.pmod(F.monotonically_increasing_id(), F.col("_files"))))
    (dealt.repartition(PARTITION_COL, "_file").sortWithinPartitions(PARTITION_COL, "_file", "timestamp")
     .select(*EVENT_FIELDS, PARTITION_COL, F.lit(label).alias(BATCH_COL))
     .write.mode("append").partitionBy(PARTITION_COL, BATCH_COL).parquet(path))
    if table:
        register_batch(spark, target, label, sorted(replaced))
    else:
        leave_note(spark, path, label, sorted(replaced))
    folder.put(f"_wayfare/compactions/{label}.json", json.dumps(replaced))
    after = sum(len(folder.sizes(f"{PARTITION_COL}={d}/{BATCH_COL}={label}")) for d in replaced)
    return CompactionResult(label, sorted(replaced), n_before, after)


def vacuum_events(spark: SparkSession, target: str, table: bool = False) -> int:
    """Remove the batches that compactions have replaced; returns how many partitions. Run
    it when no scan planned before those compactions is still at work and no stream may
    still replay the batches."""
    path = table_location(spark, target) if table else target
    folder, removed = Folder(spark, path), 0
    names = set(folder.names("_wayfare/compactions"))
    for name in sorted(n for n in names if n.endswith(".json")):
        label = name.removesuffix(".json")
        if f"{label}.vacuumed" in names:
            continue
        for day, batches in json.loads(folder.read(f"_wayfare/compactions/{name}")).items():
            for batch in batches:
                if table:
                    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION {_spec(day, batch)}")
                folder.delete(f"{PARTITION_COL}={day}/{BATCH_COL}={batch}")
                removed += 1
        folder.put(f"_wayfare/compactions/{label}.vacuumed", "")
    return removed
