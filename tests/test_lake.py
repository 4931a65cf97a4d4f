import datetime as dt


from wayfare.functions.scalar import utc_now
from wayfare.operators.interactions import interaction_strength
from wayfare.plans.inspect import physical_plan
from wayfare.schemas import EVENT_FIELDS
from wayfare.sinks import append_events, ensure_event_table, publish_events
from wayfare.sources.readers import scan_events, stream_payloads
from wayfare.streaming.ingest import ingest_stream

from conftest import SF_SMALL


def _events(spark, n_days=3):
    rows = []
    for d in range(n_days):
        for p in range(4):
            rows.append((f"p{p}", "f", "l", "g", 30 + p, "n", "an", "cc", "cn", "ac", "co", "2024-01-0%d" % (d + 1),
                         str(p % 2), "pilot", "On Time" if p else "Delayed", dt.datetime(2024, 1, 28 + d, 12)))
    schema = ", ".join(f"{f} {'int' if f == 'age' else 'timestamp_ntz' if f == 'timestamp' else 'string'}"
                       for f in EVENT_FIELDS)
    return spark.createDataFrame(rows, schema)


def test_table_ddl_insert_and_scan_by_name(spark, tmp_path):
    name = "default.wayfare_events_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_event_table(spark, name, str(tmp_path / "tbl"))
    ensure_event_table(spark, name, str(tmp_path / "tbl"))  # idempotent
    append_events(_events(spark), name, table=True)
    append_events(_events(spark), name, table=True)  # append-only: replays are appended again
    ev = scan_events(spark, name)
    assert ev.count() == 24
    assert sorted(str(r.event_day) for r in ev.select("event_day").distinct().collect()) == [
        "2024-01-28", "2024-01-29", "2024-01-30"]
    q = interaction_strength(ev, "2024-01-31 00:00:00", 2)
    assert "PartitionFilters" in physical_plan(q)
    assert {(r.passengerId, r.arrivalAirport): r.strength for r in q.collect()}[("p0", "0")] == 2 * 2 * 0.6
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_files_per_day_spreads_a_day(spark, tmp_path):
    # AQE merges small shuffle partitions (good: no tiny files); switch that off to
    # see how a day is spread over writer tasks, as a large day would be.
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        append_events(_events(spark, 1), str(tmp_path / "lake"), files_per_day=4)
    finally:
        spark.conf.set(key, old)
    files = list((tmp_path / "lake" / "event_day=2024-01-28").rglob("*.parquet"))
    assert 1 < len(files) <= 4


def test_stream_and_batch_share_one_table(spark, tmp_path):
    name, lake = "default.wayfare_shared_test", str(tmp_path / "tbl")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_event_table(spark, name, lake)
    publish_events(_events(spark), "text", str(tmp_path / "topic"))
    ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), lake, str(tmp_path / "ckpt")).await_all()
    append_events(_events(spark), lake)
    ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), name, str(tmp_path / "ckpt2"),
                  table=True).await_all()
    assert scan_events(spark, lake).count() == scan_events(spark, name).count() == 36
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_micro_batch_bound_and_continuous_trigger(spark, tmp_path):
    from wayfare.operators.normalize import clock_from, normalize_events
    from wayfare.sources.fixtures import load_table, raw_rows_from_event_log
    ev = normalize_events(raw_rows_from_event_log(load_table(spark, SF_SMALL, "events")),
                          clock=clock_from("_ingest_ts")).events
    publish_events(ev, "text", str(tmp_path / "topic"), num_files=4)
    qs = ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic"), max_per_trigger=2),
                       str(tmp_path / "lake"), str(tmp_path / "ckpt"))
    qs.await_all()
    batches = [p for p in qs.events.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 2  # 4 files, at most 2 per micro-batch
    # Continuous (processing-time) mode over the same source and a fresh checkpoint.
    qs2 = ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), str(tmp_path / "lake2"),
                        str(tmp_path / "ckpt2"), available_now=False, interval="1 second")
    try:
        qs2.events.processAllAvailable()
    finally:
        qs2.stop()
    assert spark.read.parquet(str(tmp_path / "lake2")).count() == ev.count()


def test_utc_now_is_wall_clock(spark):
    got = spark.range(1).select(utc_now().alias("t")).first()["t"]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - got).total_seconds()) < 120


def test_max_records_per_file(spark, tmp_path):
    append_events(_events(spark, 1), str(tmp_path / "lake"), max_records_per_file=1)
    files = list((tmp_path / "lake" / "event_day=2024-01-28").rglob("*.parquet"))
    assert len(files) == 4 and spark.read.parquet(str(tmp_path / "lake")).count() == 4
