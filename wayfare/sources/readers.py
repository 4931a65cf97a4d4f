"""Sources S1-S5. Every reader declares its schema up front: no inference passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.scalar import day_window
from wayfare.schemas import BATCH_COL, BUCKET_COL, DAY_COL, LOOKUP_CSV_SCHEMA, PARTITION_COL, RAW_CSV_SCHEMA
from wayfare.sinks import current_runs, passenger_bucket, run_buckets
from wayfare.sources.csv_records import csv_records
from wayfare.sinks.event_table import compactions, register_pending, table_location, visible_events

# How long a stream waits for ``min_per_trigger`` records.
FLUSH_DELAY = "30s"

# Stands for "no such field" where CSV text is read; no field holds it.
NO_FIELD = "\x00no field\x00"


def scan_events(spark: SparkSession, source: str) -> DataFrame:
    """The event table, by catalog name (``db.table`` / ``catalog.db.table``) or by path.

    A table or folder written by both writers (batch and stream) shows the rows of both, and
    packed batches in place of their originals. Filters applied later reach the Parquet scan
    (pushed filters) and, for a day-partitioned table, the partition column (partition
    filters). A scan by name lists nothing but the notes of batches written by folder."""
    return _event_scan(spark, source).drop(BATCH_COL)


def _event_scan(spark: SparkSession, source: str) -> DataFrame:
    if "/" in source or source.endswith(".parquet"):
        state = compactions(spark, source)
        while True:
            events = spark.read.parquet(source)
            now = compactions(spark, source)
            if now == state:  # else files of a compaction may have been listed in between
                break
            state = now
        return visible_events(events, state) if BATCH_COL in events.columns else events
    if PARTITION_COL in spark.table(source).columns and spark.catalog.tableExists(source):
        if any(c.isPartition and c.name == BATCH_COL for c in spark.catalog.listColumns(source)):
            register_pending(spark, source)
            return visible_events(spark.table(source), compactions(spark, table_location(spark, source)))
    return spark.table(source)


def event_batches(spark: SparkSession, source: str) -> DataFrame:
    """The batches in view of each day: (event_day, ingest_batch, n_events). Only file footers
    are read."""
    return _event_scan(spark, source).groupBy(PARTITION_COL, BATCH_COL).agg(F.count(F.lit(1)).alias("n_events"))


def scan_lookup(spark: SparkSession, path: str) -> DataFrame:
    """S2 + P4: headerless airport CSV, positions 2/3/4 = city/country/IATA code."""
    raw = spark.read.schema(LOOKUP_CSV_SCHEMA).option("header", "false").csv(path)
    return raw.select(F.col("_c2").alias("city"), F.col("_c3").alias("country"),
                      F.col("_c4").alias("iata_code"))


def scan_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, parallel: bool = False) -> DataFrame:
    """S3: raw dataset CSV with a header row, UTF-8, every value a string.

    Columns are matched by header name (any order, extra header columns ignored); a
    file lacking an expected column fails as a whole, and so does a folder whose files
    have different headers. A quote inside a quoted field is doubled. A row with fewer
    fields than the header fails the read when it is processed, as a strict reader aborts
    the run; a row with more fields keeps its header columns and drops the rest. An empty
    field is the empty string. ``multi_line`` reads line breaks inside quoted fields, at
    the price of one task for each file, or with ``parallel`` in many tasks a file, which
    needs every field that holds a quote to be quoted (``csv_records``)."""
    def reader():
        return (spark.read.option("header", "true").option("encoding", "UTF-8").option("escape", '"')
                .option("multiLine", str(multi_line).lower()).option("nullValue", NO_FIELD).option("emptyValue", ""))
    header = reader().option("inferSchema", "false").csv(path).columns
    missing = [h for h in RAW_CSV_SCHEMA.fieldNames() if h not in header]
    if missing:
        raise ValueError(f"raw CSV lacks columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header]
                          + [T.StructField("_corrupt_record", T.StringType(), True)])
    if multi_line and parallel:
        df = _parsed_records(csv_records(spark, path), schema, header)
    else:
        df = (reader().option("mode", "PERMISSIVE").option("enforceSchema", "false")
              .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).csv(path))
    # No text of a field reads as null, so a null last column is a field that was not there.
    short = F.col("_corrupt_record").isNotNull() & F.col(f"`{header[-1]}`").isNull()
    checked = df.filter(F.when(short, F.raise_error(F.concat(
        F.lit("raw CSV row with missing fields: "), F.col("_corrupt_record")))).otherwise(F.lit(True)))
    return checked.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in RAW_CSV_SCHEMA.fieldNames()])


def _parsed_records(records: DataFrame, schema: T.StructType, header: list[str]) -> DataFrame:
    options = {"escape": '"', "nullValue": NO_FIELD, "emptyValue": "", "mode": "PERMISSIVE", "multiLine": "true",
               "columnNameOfCorruptRecord": "_corrupt_record"}
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = records.select("file", "first", F.from_csv("record", ddl, options).alias("r"))
    same = F.lit(True)
    for name in header:
        same = same & F.col(f"r.`{name}`").eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit("header of another form in "), F.col("file")))
    return parsed.filter(F.when(F.col("first") & ~same, wrong).otherwise(~F.col("first"))).select("r.*")


def stream_payloads(spark: SparkSession, fmt: str, location: str,
                    max_per_trigger: int | None = 1000, min_per_trigger: int | None = None,
                    max_delay: str | None = None, max_bytes: int | str | None = None, **options) -> DataFrame:
    """An unbounded stream of event payloads as a string column ``value``.

    ``fmt="kafka"``: ``location`` is the topic; reading starts at the earliest offset
    and ``max_per_trigger`` bounds records per micro-batch. A batch is flushed once
    ``min_per_trigger`` records have come or ``max_delay`` (default 30 seconds) has passed.
    Needs the Kafka connector on the classpath. ``fmt="text"``: ``location`` is a folder of newline-delimited payload files;
    ``max_per_trigger`` bounds files per micro-batch or, for files of uneven size,
    ``max_bytes`` their bytes instead (a file is never split over batches)."""
    reader = spark.readStream
    if fmt == "kafka":
        if max_bytes:
            raise ValueError("max_bytes bounds batches of files; use max_per_trigger for Kafka")
        reader = (reader.format("kafka").option("subscribe", location)
                  .option("startingOffsets", options.pop("startingOffsets", "earliest")))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", int(max_per_trigger))
        if min_per_trigger:
            if max_per_trigger and min_per_trigger > max_per_trigger:
                raise ValueError("min_per_trigger is above max_per_trigger")
            reader = (reader.option("minOffsetsPerTrigger", int(min_per_trigger))
                      .option("maxTriggerDelay", max_delay or FLUSH_DELAY))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if fmt == "text":
        if min_per_trigger or max_delay:
            raise ValueError("files have no record offsets to wait for; bound them by max_per_trigger or max_bytes")
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        elif max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_per_trigger))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.format("text").load(location)
    raise ValueError(f"unsupported stream format {fmt!r}")


def scan_recommendations(spark: SparkSession, target: str, fmt: str = "parquet", day=None,
                         passengers: list[str] | DataFrame | None = None, **jdbc_options) -> DataFrame:
    """The published recommendations table (Parquet folder or JDBC table).

    A Parquet folder holds one folder for each run; those of the newest replacing run and
    of the appending runs after it are read. ``day`` and ``passengers`` keep the rows of a
    calendar day and of some passengers, given as a short list, which becomes a filter that
    reaches the files, or as a table of any size (its first column), which is joined. Of runs
    with the serving layout only the folders of that day and of those passengers' buckets
    are read; no more than one number for each bucket reaches the driver. ``jdbc_options`` may hold Spark's
    partitioning options (partitionColumn, lowerBound, upperBound, numPartitions)."""
    if fmt == "jdbc":
        found = spark.read.format("jdbc").options(dbtable=target, **jdbc_options).load()
        return _asked_for(found, day, passengers)
    plain, laid_out = [], []
    for path in current_runs(spark, target) or [target]:
        (laid_out if run_buckets(path) else plain).append(path)
    # A run with partition folders is a table of its own; those without are read as one.
    out = None
    for buckets, paths in [(0, plain)] * bool(plain) + [(run_buckets(path), [path]) for path in laid_out]:
        rows = spark.read.parquet(*paths)
        if buckets:
            if day is not None:
                rows = rows.filter(F.col(DAY_COL) == F.to_date(F.lit(str(day))))
            if passengers is not None:
                ids = passengers
                if not isinstance(ids, DataFrame):
                    ids = spark.createDataFrame([(p,) for p in passengers], "p string")
                bucket = passenger_bucket(F.col(ids.columns[0]).cast("string"), buckets)
                wanted = sorted(r[0] for r in ids.select(bucket).distinct().collect() if r[0] is not None)
                rows = rows.filter(F.col(BUCKET_COL).isin(wanted))
            rows = rows.drop(DAY_COL, BUCKET_COL)
        out = rows if out is None else out.unionByName(rows)
    return _asked_for(out, day, passengers)


def _asked_for(recs: DataFrame, day, passengers: list[str] | DataFrame | None) -> DataFrame:
    if isinstance(passengers, DataFrame):
        ids = passengers.select(F.col(passengers.columns[0]).cast("string").alias("passenger_id"))
        recs = recs.join(ids, "passenger_id", "left_semi")
    elif passengers is not None:
        recs = recs.filter(F.col("passenger_id").isin(list(passengers)))
    if day is not None:
        start, end = day_window(day)
        recs = recs.filter((F.col("generated_at") >= start) & (F.col("generated_at") < end))
    return recs
