import datetime as dt
import hashlib

from pyspark.sql import functions as F

from wayfare.functions.scalar import (
    epoch_millis_of,
    holdout_key,
    iso_text_to_utc,
    millis_to_utc,
    parse_int_strict,
    status_weight,
    utc_to_zone,
)


def test_status_weight_exact_match_and_default(spark):
    rows = [("On Time",), ("Delayed",), ("Cancelled",), ("on time",), ("Boarding",), (None,)]
    df = spark.createDataFrame(rows, "s string").select("s", status_weight("s").cast("double").alias("w"))
    got = {r["s"]: r["w"] for r in df.collect()}
    assert got == {"On Time": 1.0, "Delayed": 0.6, "Cancelled": 0.0, "on time": 0.3, "Boarding": 0.3, None: 0.3}


def test_millis_to_utc_day_boundary(spark):
    df = spark.createDataFrame([(1704067199999,), (1704067200000,)], "m long")
    out = df.select(millis_to_utc("m").alias("ts")).select("ts", F.to_date("ts").alias("d")).collect()
    assert [r["d"] for r in out] == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert out[0]["ts"] == dt.datetime(2023, 12, 31, 23, 59, 59, 999000)


def test_millis_roundtrip_truncates_micros(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 123999),)], "ts timestamp_ntz")
    assert df.select(epoch_millis_of("ts").alias("m")).first()["m"] == 1704067200123


def test_iso_text_rules(spark):
    cases = {
        "2024-01-01T00:00:00Z": dt.datetime(2024, 1, 1),
        "2024-01-01T00:00:00": dt.datetime(2024, 1, 1),
        "2024-01-01T01:00:00+03:30": dt.datetime(2023, 12, 31, 21, 30),
        "2024-01-01T00:00": dt.datetime(2024, 1, 1),
        "2024-01-01t00:00:00z": dt.datetime(2024, 1, 1),
        "2024-01-01T00:00:00.5Z": dt.datetime(2024, 1, 1, 0, 0, 0, 500000),
        "2024-01-01": None,
        "yesterday": None,
        "2024": None,
        "2024-01-01 00:00:00": None,
        "2024-02-30T00:00:00": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", iso_text_to_utc("t").alias("p"))
    got = {r["t"]: r["p"] for r in df.collect()}
    assert got == cases


def test_iso_text_is_session_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-01-01T01:00:00+03:30",), ("2024-01-01T00:00:00",)], "t string")
        got = [r["p"] for r in df.select(iso_text_to_utc("t").alias("p")).collect()]
        assert got == [dt.datetime(2023, 12, 31, 21, 30), dt.datetime(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_int_strict(spark):
    cases = {"41": 41, "+41": 41, "-7": -7, "007": 7, "4x": None, "": None, " 41": None, "41.0": None,
             "99999999999": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "a string").select("a", parse_int_strict("a").alias("v"))
    assert {r["a"]: r["v"] for r in df.collect()} == cases


def test_holdout_key_is_plain_md5(spark):
    df = spark.createDataFrame([(3, 7)], "user_index int, item_index int")
    key = df.select(holdout_key().alias("k")).first()["k"]
    assert key == hashlib.md5(b"42|3|7").hexdigest()


def test_utc_to_tehran(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31),)], "ts timestamp_ntz")
    assert df.select(utc_to_zone("ts", "Asia/Tehran").alias("z")).first()["z"] == dt.datetime(2024, 1, 31, 3, 30)


def test_epoch_millis_ignores_session_zone(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    cases = ["2024-07-01 00:00:00.123456", "2024-03-10 02:30:00", "2024-11-03 01:30:00",
             "1969-12-31 23:59:59.500", "1940-06-01 12:00:00.250999"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(v,) for v in cases], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        out = df.select("t", epoch_millis_of("t").alias("m"), millis_to_utc(epoch_millis_of("t")).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r in out:
        assert r.m == (r.t - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
        assert r.back == r.t.replace(microsecond=r.t.microsecond // 1000 * 1000)
