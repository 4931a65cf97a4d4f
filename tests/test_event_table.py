import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.catalog import Catalog

from wayfare.operators.interactions import interaction_strength
from wayfare.operators.rollup import (
    interaction_strength_from_daily,
    refresh_daily_strengths,
    scan_daily_strengths,
    stale_days,
)
from wayfare.plans.inspect import physical_plan
from wayfare.schemas import EVENT_FIELDS
from wayfare.sinks import append_events, compact_events, ensure_event_table, publish_events, vacuum_events
from wayfare.sinks import event_table
from wayfare.sources.readers import event_batches, scan_events, stream_payloads
from wayfare.streaming.ingest import ingest_stream

SCHEMA = ", ".join(f"{f} {'int' if f == 'age' else 'timestamp_ntz' if f == 'timestamp' else 'string'}" for f in EVENT_FIELDS)


def _row(passenger, airport, status, ts):
    return (passenger, "f", "l", "g", 30, "n", "an", "cc", "cn", "ac", "co", "d", airport, "pilot", status, ts)


def _events(spark, days=(1, 2, 3), times=4):
    return spark.createDataFrame([_row(f"p{k}", str(k % 2), "On Time" if k else "Delayed", dt.datetime(2024, 1, d, 12, k))
                                  for d in days for k in range(times)], SCHEMA)


def _table(spark, tmp_path):
    name = f"default.wayfare_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_event_table(spark, name, str(tmp_path / "tbl"))
    return name, str(tmp_path / "tbl")


def _counts(df):
    return {str(r.event_day): r["count"] for r in df.groupBy("event_day").count().collect()}


def test_no_write_and_no_scan_lists_the_table(spark, tmp_path, monkeypatch):
    name, folder = _table(spark, tmp_path)
    monkeypatch.setattr(Catalog, "recoverPartitions", lambda *a: 1 / 0)
    registered = []
    inner = event_table.register_batch
    monkeypatch.setattr(event_table, "register_batch", lambda s, n, batch, days: (registered.append((batch, len(days))), inner(s, n, batch, days)))
    append_events(_events(spark), name, table=True)
    append_events(_events(spark, days=(2, 9)), folder)
    publish_events(_events(spark, days=(3,)), "text", str(tmp_path / "topic"))
    ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), folder, str(tmp_path / "ckpt")).await_all()
    want = {"2024-01-01": 4, "2024-01-02": 8, "2024-01-03": 8, "2024-01-09": 4}
    assert _counts(scan_events(spark, name)) == _counts(scan_events(spark, folder)) == want
    # What was written by folder is registered once, by its own days.
    assert sorted(n for _, n in registered) == [1, 2]
    assert _counts(scan_events(spark, name)) == want and len(registered) == 2
    spark.sql(f"DROP TABLE {name}")


def test_registering_is_linear_in_batches(spark, tmp_path, monkeypatch):
    """Each batch costs the statements of its own days, however many came before."""
    name, _ = _table(spark, tmp_path)
    statements = []
    inner = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (statements.append(q), inner(self, q, *a, **k))[1])
    for k in range(200):
        event_table.register_batch(spark, name, f"b{k}", [f"2024-01-{1 + (k + j) % 28:02d}" for j in range(3)])
    adds = [q for q in statements if "ADD IF NOT EXISTS" in q]
    assert len(adds) == len(statements) == 200 and max(map(len, adds)) < 400
    assert inner(spark, f"SHOW PARTITIONS {name}").count() == 600
    spark.sql(f"DROP TABLE {name}")


def test_rows_without_a_day_and_empty_batches(spark, tmp_path):
    name, folder = _table(spark, tmp_path)
    odd = spark.createDataFrame([_row("p", "1", "On Time", None)], SCHEMA)
    assert append_events(odd, name, table=True) == [None]
    assert append_events(_events(spark).limit(0), name, table=True) == []
    append_events(odd, folder)
    append_events(_events(spark, days=(1,)), folder)
    append_events(_events(spark, days=(1,)), folder)
    assert compact_events(spark, name, "2030-01-01", table=True).days == ["2024-01-01"]
    assert _counts(scan_events(spark, name)) == _counts(scan_events(spark, folder)) == {"None": 2, "2024-01-01": 8}
    spark.sql(f"DROP TABLE {name}")


def test_compaction_swaps_days_at_once(spark, tmp_path, monkeypatch):
    name, folder = _table(spark, tmp_path)
    for _ in range(5):
        append_events(_events(spark), name, table=True, files_per_day=2)
    want = {f"2024-01-0{d}": 20 for d in (1, 2, 3)}
    rows = sorted(map(str, scan_events(spark, name).collect()))
    before_name, before_path = scan_events(spark, name), scan_events(spark, folder)
    seen = []
    inner = event_table.Folder.put

    def put(self, at, text):
        if at.startswith("_wayfare/compactions"):  # the packed files are there, their record is not
            seen.append((_counts(scan_events(spark, name)), _counts(scan_events(spark, folder))))
        inner(self, at, text)
    monkeypatch.setattr(event_table.Folder, "put", put)
    result = compact_events(spark, name, "2024-01-03", table=True)
    assert seen == [(want, want)]
    assert result.days == ["2024-01-01", "2024-01-02"] and result.files_after == 2 < result.files_before
    for df in (scan_events(spark, name), scan_events(spark, folder), before_name, before_path):
        assert _counts(df) == want and sorted(map(str, df.select(*scan_events(spark, name).columns).collect())) == rows
    batches = {str(r.event_day): r["count"] for r in event_batches(spark, name).groupBy("event_day").count().collect()}
    assert batches == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 5}
    # A late batch stays beside the packed one until the next run.
    append_events(_events(spark, days=(1,)), folder)
    assert vacuum_events(spark, name, table=True) == 10 and vacuum_events(spark, name, table=True) == 0
    want["2024-01-01"] = 24
    assert _counts(scan_events(spark, name)) == _counts(scan_events(spark, folder)) == want
    files = lambda d: len([f for f in (tmp_path / "tbl" / f"event_day=2024-01-0{d}").rglob("*.parquet")])
    assert files(2) == 1 and files(3) >= 5
    assert compact_events(spark, name, "2024-01-03", table=True).days == ["2024-01-01"]
    vacuum_events(spark, name, table=True)
    assert files(1) == 1 and _counts(scan_events(spark, name)) == _counts(scan_events(spark, folder)) == want
    spark.sql(f"DROP TABLE {name}")


def test_failed_compaction_is_not_seen(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "lake")
    for _ in range(3):
        append_events(_events(spark), folder)
    with monkeypatch.context() as patched:
        patched.setattr(event_table.Folder, "put", lambda *a: 1 / 0)
        try:
            compact_events(spark, folder, "2024-02-01")
        except ZeroDivisionError:
            pass
    want = {f"2024-01-0{d}": 12 for d in (1, 2, 3)}
    assert _counts(scan_events(spark, folder)) == want
    assert len(compact_events(spark, folder, "2024-02-01", first_day="2024-01-02").days) == 2
    assert _counts(scan_events(spark, folder)) == want


def test_a_large_day_is_packed_into_several_files(spark, tmp_path):
    folder = str(tmp_path / "lake")
    for _ in range(12):
        append_events(_events(spark, days=(1,)), folder)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        size = sum(f.stat().st_size for f in (tmp_path / "lake").rglob("*.parquet"))
        result = compact_events(spark, folder, "2024-02-01", target_bytes=size // 3)
    finally:
        spark.conf.set(key, old)
    assert 2 <= result.files_after <= 4 and scan_events(spark, folder).count() == 48


def test_rollup_equals_events_and_reads_one_day(spark, tmp_path):
    lake, daily = str(tmp_path / "lake"), str(tmp_path / "daily")
    rows = [_row(None, "1", "On Time", dt.datetime(2024, 1, 5, 1)), _row("p1", None, "Delayed", dt.datetime(2024, 1, 5, 1)),
            _row("p9", "9", "Cancelled", dt.datetime(2024, 1, 6)), _row("p8", "8", "Cancelled", dt.datetime(2024, 1, 4)),
            _row("p8", "8", None, dt.datetime(2024, 1, 7))]
    append_events(_events(spark, days=(1, 2, 3, 4)), lake)
    assert [str(d) for d in refresh_daily_strengths(spark, lake, daily)] == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    append_events(spark.createDataFrame(rows, SCHEMA), lake)
    assert [str(d) for d in refresh_daily_strengths(spark, lake, daily)] == [f"2024-01-0{d}" for d in (4, 5, 6, 7)]
    assert refresh_daily_strengths(spark, lake, daily) == []
    assert stale_days(scan_events(spark, lake), scan_daily_strengths(spark, daily)) == []
    compact_events(spark, lake, "2024-01-05")
    assert refresh_daily_strengths(spark, lake, daily) == []
    for as_of, days in (("2024-01-08 00:00:00", 90), ("2024-01-08 12:02:00", 5), ("2024-01-08 00:00:00", 5), ("2025-01-01", 1)):
        events, table = scan_events(spark, lake), scan_daily_strengths(spark, daily)
        got = interaction_strength_from_daily(events, table, as_of, days)
        assert sorted(map(str, got.collect())) == sorted(map(str, interaction_strength(events, as_of, days).collect()))
    plan = physical_plan(interaction_strength_from_daily(events, table, "2024-01-08 12:00:00", 5))
    filters = [line for line in plan.splitlines() if line.strip().startswith("PartitionFilters")]
    assert filters and all("(event_day" in line and (" = 2024-01-03)" in line or " > 2024-01-03)" in line) for line in filters)


def test_empty_rollup(spark, tmp_path):
    assert scan_daily_strengths(spark, str(tmp_path / "none")).count() == 0
