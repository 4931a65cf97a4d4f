"""Payload stream -> decoded events -> day-partitioned append-only table.

One Structured Streaming query decodes each micro-batch and writes it to two places:

- events go to the event table, a folder or a catalog table, under their day and the
  batch's own partition (R5), as the batch path's appends do;
- undecodable payloads and events without a usable timestamp (F9, F10) go to a
  quarantine folder with a reason instead of being lost silently or stopping the query.

A batch that failed mid-write is replayed from the checkpoint (R3) and replaces its own
partitions only, so delivery is exactly-once. Micro-batch size is bounded by
``maxOffsetsPerTrigger``, ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` (R1), and Kafka
batches can wait for a number of records or a delay; ``availableNow`` drains everything
present and stops (R2); the checkpoint carries the offsets and a new query starts from
the earliest one (R4). Empty batches write nothing (F12). Late events of any age land in
their own day (no watermark), and replays of the same payloads under a new checkpoint are
appended again, as an append-only log does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions.scalar import iso_text_to_utc, millis_to_utc
from wayfare.schemas import BATCH_COL, EVENT_FIELDS, PARTITION_COL, PAYLOAD_SCHEMA
from wayfare.sinks import write_batch


def decode_payloads(payloads: DataFrame) -> DataFrame:
    """F9 + P5 + X6/X7 + F10 on a DataFrame with a string column ``value``.

    Returns the 16 event fields, ``event_day`` and ``reason`` (null for good rows).
    A payload decodes when it is a JSON object whose fields are all present with the right
    types: each is looked up by its own path and its type asked for, so a number or an
    object is not taken for text wherever else in the payload a text of that name stands.
    Text that is not JSON, or an object that repeats a key, is rejected as well. The
    timestamp may be epoch millis (a JSON integer) or ISO-8601 text. A payload is parsed
    once."""
    staged = payloads.select("value", F.try_parse_json("value").alias("_json"))

    def get(field: str, kind: str):
        return F.try_variant_get("_json", f"$.{field}", kind)

    def typed(field: str, kind: str):
        return F.schema_of_variant(get(field, "variant")) == kind
    fields_ok = F.lit(True)
    for f in PAYLOAD_SCHEMA.fields[:-1]:
        text = isinstance(f.dataType, T.StringType)
        fields_ok = fields_ok & typed(f.name, "STRING" if text else "BIGINT") & get(f.name, f.dataType.simpleString()).isNotNull()
    ts = (F.when(typed("timestamp", "BIGINT"), millis_to_utc(get("timestamp", "bigint")))
          .when(typed("timestamp", "STRING"), iso_text_to_utc(get("timestamp", "string"))))
    decoded = staged.select(
        "value",
        *[get(f.name, f.dataType.simpleString()).alias(f.name) for f in PAYLOAD_SCHEMA.fields[:-1]],
        ts.alias("timestamp"),
        F.coalesce(fields_ok, F.lit(False)).alias("_fields_ok"),
    )
    return decoded.select(
        *[c for c in decoded.columns if c != "_fields_ok"],
        F.when(~F.col("_fields_ok"), F.lit("decode")).when(F.col("timestamp").isNull(), F.lit("timestamp"))
         .alias("reason"),
        F.to_date("timestamp").alias(PARTITION_COL),
    )


@dataclass
class IngestQueries:
    events: StreamingQuery

    def await_all(self, timeout: float | None = None) -> None:
        self.events.awaitTermination(timeout)

    def stop(self) -> None:
        if self.events.isActive:
            self.events.stop()


def _writer_id(payloads: DataFrame, checkpoint: str) -> str:
    """A name that lives and dies with the checkpoint: batch numbers repeat only there."""
    spark, path = payloads.sparkSession, f"{checkpoint}/writer"
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def ingest_stream(payloads: DataFrame, lake: str, checkpoint: str,
                  quarantine_path: str | None = None, available_now: bool = True,
                  interval: str | None = None, name: str | None = None,
                  max_records_per_file: int | None = None, table: bool = False) -> IngestQueries:
    """Start the ingest query into ``lake``, a folder or (``table``) a table's name;
    ``checkpoint`` is a folder on shared storage."""
    writer = _writer_id(payloads, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One pass writes the events, counts the rejects and gathers the days; only a
        # batch with rejects is decoded again, for the quarantine.
        label, seen = f"stream-{writer}-{batch_id}", Observation()
        counted = batch.observe(seen, F.count_if(F.col("reason").isNotNull()).alias("rejects"))
        write_batch(counted.filter("reason IS NULL").select(*EVENT_FIELDS), lake, label, table, max_records_per_file)
        if quarantine_path and seen.get["rejects"]:
            (batch.filter("reason IS NOT NULL").select("value", "reason")
             .write.mode("overwrite").parquet(f"{quarantine_path}/{BATCH_COL}={label}"))

    stream = (decode_payloads(payloads).writeStream.foreachBatch(write)
              .option("checkpointLocation", f"{checkpoint}/events"))
    if name:
        stream = stream.queryName(f"{name}_events")
    stream = (stream.trigger(availableNow=True) if available_now
              else stream.trigger(processingTime=interval or "10 seconds"))
    return IngestQueries(events=stream.start())
