import csv

import pytest
from pyspark.sql import functions as F

from wayfare.operators.normalize import normalize_events
from wayfare.schemas import EVENT_FIELDS, RAW_CSV_HEADERS
from wayfare.sources.readers import scan_raw_csv


def _row(**over):
    base = {h: f"v{i}" for i, h in enumerate(RAW_CSV_HEADERS)}
    base["Age"] = "41"
    base.update(over)
    return [base[h] for h in RAW_CSV_HEADERS]


def _write_csv(path, header, rows):

    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_age_rules_and_reasons(spark):
    rows = [_row(), _row(Age="4x"), _row(Age=""), _row(Age="+7")]
    raw = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in RAW_CSV_HEADERS))
    out = normalize_events(raw, clock=F.lit(1704067200000))
    ev = out.events.collect()
    assert [r.age for r in ev] == [41, 7]
    assert out.events.columns == EVENT_FIELDS
    assert {r.reason for r in out.rejects.collect()} == {"age"}
    assert out.rejects.count() == 2
    assert str(ev[0].timestamp) == "2024-01-01 00:00:00"


def test_csv_keeps_empty_strings_and_needs_all_columns(spark, tmp_path):
    good = tmp_path / "good.csv"
    _write_csv(good, RAW_CSV_HEADERS, [_row(**{"Arrival Airport": "", "Departure Date": "someday"})])
    raw = scan_raw_csv(spark, str(good))
    ev = normalize_events(raw, clock=F.lit(0)).events.first()
    assert ev.arrivalAirport == ""
    assert ev.departureDate == "someday"
    bad = tmp_path / "bad.csv"
    _write_csv(bad, [h for h in RAW_CSV_HEADERS if h != "Flight Status"], [_row()[:-1]])
    with pytest.raises(ValueError):
        scan_raw_csv(spark, str(bad))


def test_csv_columns_matched_by_name(spark, tmp_path):
    path = tmp_path / "reordered.csv"
    header = list(reversed(RAW_CSV_HEADERS)) + ["Extra"]
    _write_csv(path, header, [list(reversed(_row())) + ["x"]])
    ev = normalize_events(scan_raw_csv(spark, str(path)), clock=F.lit(0)).events.first()
    assert ev.passengerId == "v0" and ev.age == 41


def test_csv_quotes_line_breaks_and_mixed_headers(spark, tmp_path):
    names = ['Jo "Ace" Ray', "Ray, Jo", '"', "a,b\"c"]
    quoted = tmp_path / "quoted.csv"
    _write_csv(quoted, RAW_CSV_HEADERS, [_row(**{"First Name": n}) for n in names]
               + [_row(**{"First Name": "x,y"}) + ["sur,plus"]])
    got = scan_raw_csv(spark, str(quoted)).collect()
    assert [r["First Name"] for r in got] == names + ["x,y"]
    lines = tmp_path / "lines.csv"
    _write_csv(lines, RAW_CSV_HEADERS, [_row(**{"First Name": "two\nlines"}), _row()])
    got = scan_raw_csv(spark, str(lines), multi_line=True).collect()
    assert [r["First Name"] for r in got] == ["two\nlines", "v1"]
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    _write_csv(mixed / "a.csv", RAW_CSV_HEADERS, [_row()])
    _write_csv(mixed / "b.csv", list(reversed(RAW_CSV_HEADERS)), [list(reversed(_row()))])
    with pytest.raises(Exception, match="(?i)header"):
        scan_raw_csv(spark, str(mixed)).collect()


def test_short_rows_fail_extra_fields_are_dropped(spark, tmp_path):
    extra = tmp_path / "extra.csv"
    _write_csv(extra, RAW_CSV_HEADERS, [_row(), _row() + ["surplus"]])
    ev = normalize_events(scan_raw_csv(spark, str(extra)), clock=F.lit(0)).events.collect()
    assert len(ev) == 2 and {r.flightStatus for r in ev} == {"v14"}
    short = tmp_path / "short.csv"
    _write_csv(short, RAW_CSV_HEADERS, [_row(), _row()[:-2]])
    with pytest.raises(Exception, match="missing fields"):
        normalize_events(scan_raw_csv(spark, str(short)), clock=F.lit(0)).events.collect()


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_parallel_line_breaks_equal_the_one_task_reader(spark, tmp_path, newline):
    """Small byte ranges: records, quoted fields and even single lines span several of them."""
    import random
    rnd = random.Random(3)
    odd = ["two\nlines", 'say "hi"', 'a "b"\n"c"\n', "", "\n\n\n", "comma, and\nmore", "é\n中", "x" * 3000 + "\ny", '"', "plain", " "]
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        rows = [_row(**{"First Name": rnd.choice(odd), "Pilot Name": rnd.choice(odd), "Flight Status": rnd.choice(odd)})
                for _ in range(150)]
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator=newline)
            writer.writerow(RAW_CSV_HEADERS)
            for k, row in enumerate(rows):
                writer.writerow(row)
                if k % 50 == 7:
                    f.write(newline)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = sorted(map(tuple, scan_raw_csv(spark, str(folder), multi_line=True).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        from wayfare.sources.csv_records import csv_records
        tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
        got = sorted(map(tuple, scan_raw_csv(spark, str(folder), multi_line=True, parallel=True).collect()))
        firsts = csv_records(spark, str(folder)).filter("first").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert tasks > 20 and len(want) == 300 and got == want and firsts == 2


def test_parallel_reader_checks_headers_and_short_rows(spark, tmp_path):
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    _write_csv(mixed / "a.csv", RAW_CSV_HEADERS, [_row()])
    _write_csv(mixed / "b.csv", list(reversed(RAW_CSV_HEADERS)), [list(reversed(_row()))])
    with pytest.raises(Exception, match="(?i)header"):
        scan_raw_csv(spark, str(mixed), multi_line=True, parallel=True).collect()
    short = tmp_path / "short.csv"
    _write_csv(short, RAW_CSV_HEADERS, [_row(), _row()[:-2]])
    with pytest.raises(Exception, match="missing fields"):
        scan_raw_csv(spark, str(short), multi_line=True, parallel=True).collect()
    extra = tmp_path / "extra.csv"
    _write_csv(extra, RAW_CSV_HEADERS, [_row() + ["surplus"]])
    assert scan_raw_csv(spark, str(extra), multi_line=True, parallel=True).first()["Flight Status"] == "v14"
