import json
import os

from pyspark.sql import functions as F

from wayfare.sinks import encode_events, publish_events
from wayfare.sources.readers import stream_payloads
from wayfare.streaming.ingest import decode_payloads, ingest_stream

from conftest import SF_SMALL


def _normalized(spark):
    from wayfare.operators.normalize import clock_from, normalize_events
    from wayfare.sources.fixtures import load_table, raw_rows_from_event_log
    raw = raw_rows_from_event_log(load_table(spark, SF_SMALL, "events"))
    return normalize_events(raw, clock=clock_from("_ingest_ts")).events


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_stream_equals_batch_and_rerun_adds_nothing(spark, tmp_path):
    ev = _normalized(spark)
    base = str(tmp_path)
    publish_events(ev, "text", f"{base}/topic", num_files=3)
    for _ in range(2):  # second run: same checkpoint, nothing new
        qs = ingest_stream(stream_payloads(spark, "text", f"{base}/topic", max_per_trigger=1),
                           f"{base}/lake", f"{base}/ckpt", f"{base}/quarantine")
        qs.await_all()
    back = spark.read.parquet(f"{base}/lake")
    expected = ev.withColumn("event_day", F.to_date("timestamp"))
    assert _rows(back.select(*expected.columns)) == _rows(expected)
    assert qs.events.lastProgress is None or qs.events.lastProgress["numInputRows"] == 0


def test_bad_payloads_are_quarantined(spark, tmp_path):
    ev = _normalized(spark).limit(3)
    good = [r.value for r in encode_events(ev).collect()]
    partial = json.loads(good[0])
    del partial["pilotName"]
    text_ts = json.loads(good[1])
    text_ts["timestamp"] = "2024-01-01T01:00:00+03:30"
    date_only = json.loads(good[2])
    date_only["timestamp"] = "2024-01-01"
    payloads = [good[0], "{not json", json.dumps(partial), json.dumps(text_ts), json.dumps(date_only)]
    os.makedirs(tmp_path / "topic")
    (tmp_path / "topic" / "part-0.txt").write_text("\n".join(payloads) + "\n")
    qs = ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), str(tmp_path / "lake"),
                       str(tmp_path / "ckpt"), str(tmp_path / "quarantine"))
    qs.await_all()
    lake = spark.read.parquet(str(tmp_path / "lake"))
    assert lake.count() == 2
    assert {str(r.event_day) for r in lake.collect()} >= {"2023-12-31"}
    assert "event_day" in lake.columns
    reasons = sorted(r.reason for r in spark.read.parquet(str(tmp_path / "quarantine")).collect())
    assert reasons == ["decode", "decode", "timestamp"]


def test_decode_batch_same_as_stream_rules(spark):
    df = spark.createDataFrame([("[]",), ('{"timestamp": 0}',)], "value string")
    assert [r.reason for r in decode_payloads(df).collect()] == ["decode", "decode"]


def test_one_bad_payload_does_not_stop_ingest(spark, tmp_path):
    good = [json.loads(r.value) for r in encode_events(_normalized(spark).limit(2)).collect()]
    bad = [dict(good[0], timestamp=9223372036854775807), dict(good[0], timestamp=10**18),
           dict(good[0], timestamp=-10**18), dict(good[0], firstName=5), dict(good[0], firstName={"a": 1})]
    os.makedirs(tmp_path / "topic")
    lines = [json.dumps(x) for x in (good[0], *bad, good[1])]
    (tmp_path / "topic" / "p.txt").write_text("\n".join(lines) + "\n")
    ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), str(tmp_path / "lake"),
                  str(tmp_path / "ckpt"), str(tmp_path / "quarantine")).await_all()
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 2
    reasons = [r.reason for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()]
    assert sorted(reasons) == ["decode", "decode", "timestamp", "timestamp", "timestamp"]


def test_old_events_and_duplicates(spark, tmp_path):
    ev = _normalized(spark).limit(1)
    payload = json.loads(encode_events(ev).first().value)
    old = dict(payload, timestamp=-86_400_000 * 365 * 30)       # 1940: its own day
    edge = dict(payload, timestamp=1704067199999)               # last ms of 2023-12-31
    lines = [json.dumps(payload), json.dumps(payload), json.dumps(old), json.dumps(edge)]
    os.makedirs(tmp_path / "topic")
    (tmp_path / "topic" / "p.txt").write_text("\n".join(lines) + "\n")
    ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic")), str(tmp_path / "lake"),
                  str(tmp_path / "ckpt")).await_all()
    days = sorted(str(r.event_day) for r in spark.read.parquet(str(tmp_path / "lake")).collect())
    assert len(days) == 4                      # the duplicate is kept (append-only log)
    assert days[0].startswith("1940") and "2023-12-31" in days


def test_failed_batch_is_replayed_exactly_once(spark, tmp_path):
    ev = _normalized(spark)
    base = str(tmp_path)
    publish_events(ev, "text", f"{base}/topic", num_files=3)
    # A regular file where a day partition must go: the first micro-batch fails while
    # writing, after its offsets were logged.
    (tmp_path / "lake1").mkdir()
    (tmp_path / "lake1" / "event_day=2024-01-15").write_text("in the way")
    first = ingest_stream(stream_payloads(spark, "text", f"{base}/topic", max_per_trigger=1),
                          f"{base}/lake1", f"{base}/ckpt")
    try:
        first.events.awaitTermination()
        failed = first.events.exception() is not None
    except Exception:  # noqa: BLE001 - the failure is the point
        failed = True
    assert failed
    assert spark.read.text(f"{base}/ckpt/events/offsets").count() >= 1   # batch 0 was planned
    # Restart on the same checkpoint (table path freed up): the failed batch is
    # replayed, later batches follow, and nothing is lost or doubled.
    second = ingest_stream(stream_payloads(spark, "text", f"{base}/topic", max_per_trigger=1),
                           f"{base}/lake2", f"{base}/ckpt")
    second.await_all()
    back = spark.read.parquet(f"{base}/lake2")
    expected = ev.withColumn("event_day", F.to_date("timestamp"))
    assert back.count() == expected.count()
    assert _rows(back.select(*expected.columns)) == _rows(expected)


def test_flush_options_reach_the_reader(spark, monkeypatch):
    import pytest
    from pyspark.sql.streaming import DataStreamReader
    seen = {}
    monkeypatch.setattr(DataStreamReader, "option", lambda self, k, v: seen.update({k: v}) or self)
    monkeypatch.setattr(DataStreamReader, "load", lambda self, *a: spark.createDataFrame([], "value binary"))
    stream_payloads(spark, "kafka", "topic", max_per_trigger=5000, min_per_trigger=1000, max_delay="2m")
    assert seen == {"subscribe": "topic", "startingOffsets": "earliest", "maxOffsetsPerTrigger": 5000,
                    "minOffsetsPerTrigger": 1000, "maxTriggerDelay": "2m"}
    seen.clear()
    stream_payloads(spark, "kafka", "topic", max_per_trigger=None, min_per_trigger=1000)
    assert seen["maxTriggerDelay"] == "30s" and "maxOffsetsPerTrigger" not in seen
    for bad in ({"fmt": "kafka", "max_bytes": 5}, {"fmt": "text", "min_per_trigger": 5}, {"fmt": "text", "max_delay": "1s"},
                {"fmt": "kafka", "min_per_trigger": 10, "max_per_trigger": 5}):
        with pytest.raises(ValueError):
            stream_payloads(spark, location="x", **bad)


def test_uneven_files_are_bounded_by_bytes(spark, tmp_path):
    good = [r.value for r in encode_events(_normalized(spark).limit(60)).collect()]
    os.makedirs(tmp_path / "topic")
    for k, lines in enumerate([good[:40], good[40:42], good[42:44], good[44:46], good[46:]]):
        (tmp_path / "topic" / f"p{k}.txt").write_text("\n".join(lines) + "\n")
        os.utime(tmp_path / "topic" / f"p{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    bound = 3 * sum(map(len, good[:6])) // 2
    qs = ingest_stream(stream_payloads(spark, "text", str(tmp_path / "topic"), max_bytes=bound), str(tmp_path / "lake"),
                       str(tmp_path / "ckpt"), max_records_per_file=20)
    qs.await_all()
    sizes = [p["numInputRows"] for p in qs.events.recentProgress if p["numInputRows"]]
    # The large file is a batch of its own, the small ones share one.
    assert sum(sizes) == 60 and sizes[0] == 40 and 1 < len(sizes) < 5
    assert spark.read.parquet(str(tmp_path / "lake")).count() == 60


def test_types_are_those_of_the_field_itself(spark):
    good = encode_events(_normalized(spark).limit(1)).first().value
    record = json.loads(good)
    payloads = {good: None, json.dumps(dict(record, firstName=5, extra={"firstName": "a"})): "decode",
                json.dumps(dict(record, firstName=5, xfirstName="a")): "decode",
                json.dumps(dict(record, age="30")): "decode", json.dumps(dict(record, age=30.5)): "decode",
                json.dumps(dict(record, age=2**40)): "decode", json.dumps(dict(record, pilotName=None)): "decode",
                json.dumps(dict(record, extra=[1, {"a": "b"}])): None, good[:-1] + ',"gender":"x"}': "decode",
                json.dumps(dict(record, timestamp=True)): "timestamp", json.dumps(dict(record, timestamp="2024-01-01T00:00:00Z")): None}
    got = decode_payloads(spark.createDataFrame([(p,) for p in payloads], "value string")).collect()
    assert {r.value: r.reason for r in got} == payloads
