"""Sinks K1-K5."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.scalar import day_of, epoch_millis_of
from wayfare.schemas import BATCH_COL, BUCKET_COL, DAY_COL, EVENT_FIELDS, JDBC_BATCH_SIZE, JDBC_WRITERS, PARTITION_COL
from wayfare.sinks.event_table import (  # noqa: F401
    compact_events,
    days_of,
    ensure_event_table,
    leave_note,
    register_batch,
    table_location,
    vacuum_events,
)


def encode_events(events: DataFrame) -> DataFrame:
    """K1 encoding: one self-describing payload per event, timestamp as epoch millis."""
    fields = [epoch_millis_of("timestamp").alias("timestamp") if f == "timestamp" else F.col(f)
              for f in EVENT_FIELDS]
    return events.select(F.to_json(F.struct(*fields)).alias("value"))


def publish_events(events: DataFrame, fmt: str, location: str, num_files: int | None = None,
                   **options) -> None:
    """K1: publish events, one payload per row and no key.

    ``fmt="kafka"``: ``location`` is the topic (needs the Kafka connector);
    ``fmt="text"``: newline-delimited payload files appended under ``location``."""
    payloads = encode_events(events)
    if num_files:
        payloads = payloads.repartition(num_files)
    if fmt == "kafka":
        payloads.write.format("kafka").option("topic", location).options(**options).save()
    elif fmt == "text":
        payloads.write.mode("append").text(location)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def with_event_day(events: DataFrame) -> DataFrame:
    """The UTC day of each event, used as partition value."""
    return events.withColumn(PARTITION_COL, day_of("timestamp"))


def write_batch(events: DataFrame, target: str, batch: str, table: bool = False,
                max_records_per_file: int | None = None) -> list[str | None]:
    """Write the events of one batch into their day partitions, once: writing the same
    batch again replaces its own rows and no others. Both the batch path and the stream
    write here, to a folder or to the folder of a catalog table (``table``). Returns the
    days written, which are gathered while writing; only they are registered."""
    spark = events.sparkSession
    folder = table_location(spark, target) if table else target
    seen = Observation()
    out = (with_event_day(events).observe(seen, F.collect_set(F.struct(PARTITION_COL)).alias("days"))
           .select(*EVENT_FIELDS, PARTITION_COL, F.lit(batch).alias(BATCH_COL)))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.partitionBy(PARTITION_COL, BATCH_COL).parquet(folder)
    days = days_of(r[PARTITION_COL] for r in seen.get["days"])
    if table:
        register_batch(spark, target, batch, days)
    else:
        leave_note(spark, folder, batch, days)
    return days


def append_events(events: DataFrame, target: str, files_per_day: int | None = None,
                  table: bool = False, max_records_per_file: int | None = None) -> list[str | None]:
    """K3: append events into their day partitions; nothing is ever overwritten. Returns
    the days written.

    ``files_per_day`` spreads each day over that many writer tasks (hash of the row and of
    the input partition, so one event repeated many times spreads too); None leaves the layout to the upstream partitioning. ``max_records_per_file`` caps
    file size within a task."""
    if files_per_day:
        row = F.xxhash64(*[F.col(f) for f in EVENT_FIELDS], F.spark_partition_id())
        events = (events.withColumn("_salt", F.pmod(row, F.lit(files_per_day)))
                  .repartition(day_of("timestamp"), F.col("_salt")).drop("_salt"))
    return write_batch(events, target, f"append-{uuid.uuid4().hex}", table, max_records_per_file)


def current_runs(spark: SparkSession, target: str) -> list[str]:
    """The run folders of a published Parquet target that make up its present content:
    the newest complete replacing run and the complete appending runs after it."""
    return [path for _, path in _runs(spark, target)[1]]


def run_buckets(path: str) -> int:
    """The passenger buckets of a run folder, 0 for a run without the serving layout."""
    parts = path.rstrip("/").rsplit("/", 1)[1].split("-")
    return int(parts[4].removeprefix("b")) if len(parts) == 5 else 0


def _runs(spark: SparkSession, target: str) -> tuple[int, list[tuple[str, str]]]:
    """(number for the next run, [(mode, path)] of the present content)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(str(s.getPath()) for s in fs.listStatus(folder)) if fs.exists(folder) else []
    last, content = 0, []
    for path in found:
        parts = path.rsplit("/", 1)[1].split("-")
        if len(parts) in (4, 5) and parts[0] == "run":
            last = int(parts[1])
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
                content = [(parts[2], path)] if parts[2] == "replace" else content + [(parts[2], path)]
    return last + 1, content


def passenger_bucket(passenger, buckets: int) -> Column:
    return F.pmod(F.xxhash64(passenger), F.lit(buckets)).cast("int")


def write_serving_layout(recs: DataFrame, path: str, buckets: int) -> None:
    """One run laid out for lookups: a folder for each day of ``generated_at`` and passenger
    bucket, rows sorted by passenger, Bloom filters on the passenger. A passenger has at
    most k rows in a run, so no bucket is hot."""
    out = recs.withColumn(DAY_COL, F.to_date("generated_at")).withColumn(
        BUCKET_COL, F.coalesce(passenger_bucket("passenger_id", buckets), F.lit(0)))
    (out.repartition(buckets, BUCKET_COL).sortWithinPartitions(DAY_COL, BUCKET_COL, "passenger_id", F.col("score").desc())
     .write.option("parquet.bloom.filter.enabled#passenger_id", "true")
     .partitionBy(DAY_COL, BUCKET_COL).parquet(path))


def publish_recommendations(recs: DataFrame, target: str, fmt: str = "parquet", mode: str = "replace",
                            num_writers: int | None = None, buckets: int | None = None,
                            **jdbc_options) -> DataFrame | None:
    """K4 + K5: publish recommendations.

    ``buckets`` (Parquet only) lays the run out for lookups by passenger and day, see
    ``write_serving_layout``; ``scan_recommendations`` then reads only what it is asked for.

    ``mode="replace"`` keeps only this run (truncate-and-load on JDBC, which keeps the
    table's DDL). ``mode="append"`` keeps history, which the "latest" serving query then
    resolves. On Parquet every run is a folder of its own that counts once it is complete
    (``scan_recommendations``), so a reader sees the old content or the new, never a part;
    replaced runs stay until they are removed. Returns the published rows of this run
    there. JDBC writes use ``num_writers`` connections (default 8) and 10 000-row batches;
    Parquet leaves parallelism to Spark unless ``num_writers`` is set."""
    save_mode = {"replace": "overwrite", "append": "append"}[mode]
    if fmt == "jdbc":
        out = recs.repartition(num_writers or JDBC_WRITERS)
        (out.write.format("jdbc").option("dbtable", target)
         .option("batchsize", str(JDBC_BATCH_SIZE)).option("truncate", "true")
         .options(**jdbc_options).mode(save_mode).save())
        return None
    if fmt == "parquet":
        path = f"{target}/run-{_runs(recs.sparkSession, target)[0]:010d}-{mode}-{uuid.uuid4().hex}"
        if buckets:
            write_serving_layout(recs, f"{path}-b{buckets}", buckets)
            return recs.sparkSession.read.parquet(f"{path}-b{buckets}").select(*recs.columns)
        out = recs.repartition(num_writers) if num_writers else recs
        out.write.parquet(path)
        return recs.sparkSession.read.schema(recs.schema).parquet(path)
    raise ValueError(f"unsupported format {fmt!r}")
