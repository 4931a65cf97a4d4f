import datetime as dt

from wayfare.operators.enrich import attach_lookup
from wayfare.sinks import publish_recommendations
from wayfare.sources.readers import scan_lookup, scan_recommendations

SCHEMA = ("passenger_id string, arrival_airport_code string, arrival_city string, arrival_country string, "
          "score double, generated_at timestamp_ntz")


def test_replace_then_append(spark, tmp_path):
    target = str(tmp_path / "recs")
    a = spark.createDataFrame([("p1", "A", "c", "x", 1.0, dt.datetime(2024, 1, 1))], SCHEMA)
    b = spark.createDataFrame([("p1", "B", "c", "x", 2.0, dt.datetime(2024, 1, 2))], SCHEMA)
    publish_recommendations(a, target, mode="replace")
    publish_recommendations(b, target, mode="replace")
    assert [r.arrival_airport_code for r in scan_recommendations(spark, target).collect()] == ["B"]
    publish_recommendations(a, target, mode="append", num_writers=2)
    assert sorted(r.arrival_airport_code for r in scan_recommendations(spark, target).collect()) == ["A", "B"]


def test_readers_see_whole_runs_only(spark, tmp_path):
    target = tmp_path / "recs"
    a = spark.createDataFrame([("p1", "A", "c", "x", 1.0, dt.datetime(2024, 1, 1))], SCHEMA)
    publish_recommendations(a, str(target))
    before = scan_recommendations(spark, str(target))
    (target / "run-0000000002-replace-x").mkdir()  # a run that has not ended
    assert scan_recommendations(spark, str(target)).count() == 1
    published = publish_recommendations(a.unionByName(a), str(target))
    assert scan_recommendations(spark, str(target)).count() == published.count() == 2
    assert before.count() == 1  # a reader that had begun keeps its content


def test_sink_options_reach_the_writer(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, f: seen.update(format=f) or self)
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.update({k: v}) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(saved=True))
    import __spark_entry__ as ent
    from conftest import SF_SMALL
    from wayfare.plans.job import run_recommendation_job
    run_recommendation_job(ent._events(spark, SF_SMALL), ent._lookup(spark, SF_SMALL), as_of="2024-01-31 00:00:00",
                           target="recs", target_fmt="jdbc", num_writers=3, max_iter=1,
                           target_options={"url": "jdbc:x", "user": "me", "driver": "d"}).release()
    assert seen == {"format": "jdbc", "dbtable": "recs", "batchsize": "10000", "truncate": "true", "url": "jdbc:x",
                    "user": "me", "driver": "d", "saved": True}


def test_lookup_csv_positions_missing_and_duplicate_codes(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text("1,Foo Intl,Tehran,Iran,IKA,extra\n2,Bar,Shiraz,Iran,SYZ\n3,Dup,Other,Iran,SYZ\n")
    lookup = scan_lookup(spark, str(path))
    assert lookup.columns == ["city", "country", "iata_code"]
    recs = spark.createDataFrame([("p1", "IKA", 1.0), ("p1", "SYZ", 0.5), ("p1", "XXX", 0.1)],
                                 "passengerId string, arrivalAirport string, score double")
    out = attach_lookup(recs, lookup, generated_at="2024-01-31 00:00:00").collect()
    got = sorted((r.arrival_airport_code, r.arrival_city) for r in out)
    assert got == [("IKA", "Tehran"), ("SYZ", "Other"), ("SYZ", "Shiraz"), ("XXX", None)]
    assert {r.generated_at for r in out} == {dt.datetime(2024, 1, 31, 3, 30)}


def test_dedupe_lookup_keeps_one_row_per_code(spark, tmp_path):
    from wayfare.operators.enrich import dedupe_lookup
    lookup = spark.createDataFrame([("Shiraz", "Iran", "SYZ"), ("Other", "Iran", "SYZ"), (None, "X", "SYZ"),
                                    ("Tehran", "Iran", "IKA")], "city string, country string, iata_code string")
    got = sorted((r.iata_code, r.city) for r in dedupe_lookup(lookup).collect())
    assert got == [("IKA", "Tehran"), ("SYZ", "Other")]
