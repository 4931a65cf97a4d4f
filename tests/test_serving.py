import datetime as dt

from wayfare.operators.serving import latest_recommendations, recommendations_on

SCHEMA = ("passenger_id string, arrival_airport_code string, arrival_city string, arrival_country string, "
          "score double, generated_at timestamp_ntz")
D1 = dt.datetime(2024, 1, 30, 3, 30)
D2 = dt.datetime(2024, 1, 31, 3, 30)


def _recs(spark):
    return spark.createDataFrame([
        ("p1", "A", "cA", "x", 0.9, D1), ("p1", "B", "cB", "x", 0.5, D2), ("p1", "C", "cC", "x", 0.7, D2),
        ("p2", "A", "cA", "x", 0.9, D1),
        ("p3", "A", "cA", "x", 0.9, D1), ("p3", "Z", None, None, 0.8, D2),
        ("p4", "A", "cA", "x", 0.1, dt.datetime(2024, 1, 31, 0, 0)),
        ("p4", "B", "cB", "x", 0.2, dt.datetime(2024, 2, 1, 0, 0)),
    ], SCHEMA)


def test_latest_per_passenger(spark):
    got = sorted((r.passengerId, r.airportCode, r.position) for r in latest_recommendations(_recs(spark)).collect())
    # p1 newest run only, ordered by score; p2 has its own newest; p3's newest run has
    # only unknown cities so it returns nothing; p4 newest is 2024-02-01.
    assert got == [("p1", "B", 2), ("p1", "C", 1), ("p2", "A", 1), ("p4", "B", 1)]


def test_latest_for_passenger_list(spark):
    ids = spark.createDataFrame([("p2",), ("p9",)], "id string")
    got = [(r.passengerId, r.airportCode) for r in latest_recommendations(_recs(spark), ids).collect()]
    assert got == [("p2", "A")]


def test_day_window_is_half_open(spark):
    got = sorted((r.passengerId, r.airportCode) for r in recommendations_on(_recs(spark), "2024-01-31").collect())
    assert got == [("p1", "B"), ("p1", "C"), ("p4", "A")]
    cols = recommendations_on(_recs(spark), "2024-01-31").columns
    assert cols == ["passengerId", "airportCode", "city", "country", "generatedAt", "position"]


def test_serving_layout_prunes_buckets_and_days(spark, tmp_path):
    import datetime as dt

    from wayfare.plans.inspect import physical_plan
    from wayfare.sinks import publish_recommendations
    from wayfare.sources.readers import scan_recommendations
    schema = ("passenger_id string, arrival_airport_code string, arrival_city string, arrival_country string, "
              "score double, generated_at timestamp_ntz")
    target = str(tmp_path / "recs")

    def run(day, people, hour=5):
        return spark.createDataFrame([(p, f"A{k}", "c", "x", float(k), dt.datetime(2024, 1, day, hour)) for p in people
                                      for k in range(3)], schema)
    people = [f"p{k}" for k in range(200)] + ["", "é"]
    publish_recommendations(run(1, people), target, mode="replace", buckets=8)
    publish_recommendations(run(2, people[:50]), target, mode="append")  # without the layout
    publish_recommendations(run(4, people[:9]), target, mode="append", buckets=8)  # as many buckets as the first
    published = publish_recommendations(run(3, [*people[20:90], None], 0), target, mode="append", buckets=16)
    assert published.count() == 71 * 3 and published.columns == run(1, []).columns
    whole = run(1, people).unionByName(run(2, people[:50])).unionByName(
        run(3, [*people[20:90], None], 0)).unionByName(run(4, people[:9]))
    back = scan_recommendations(spark, target)
    assert sorted(map(str, back.collect())) == sorted(map(str, whole.collect()))
    few = scan_recommendations(spark, target, passengers=["p30", "p199", "", "nobody"])
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.filter("passenger_id IN ('p30', 'p199', '')").collect()))
    assert (sorted(map(str, latest_recommendations(few).collect()))
            == sorted(map(str, latest_recommendations(whole.filter("passenger_id IN ('p30', 'p199', '')")).collect())))
    plan = physical_plan(few)
    filters = [line for line in plan.splitlines() if line.strip().startswith("PartitionFilters") and "passenger_bucket" in line]
    assert len(filters) >= 2 and "PushedFilters: [In(passenger_id" in plan
    on_day = scan_recommendations(spark, target, day="2024-01-03")
    assert on_day.count() == 71 * 3 and "(generated_day" in physical_plan(on_day)
    assert recommendations_on(on_day, "2024-01-03").count() == recommendations_on(whole, "2024-01-03").count()
    files = {f.parent.name for f in (tmp_path / "recs").rglob("*.parquet") if "passenger_bucket" in f.parent.name}
    assert len(files) == 16
    assert scan_recommendations(spark, target, passengers=[]).count() == 0
    table = spark.createDataFrame([("p30",), ("p199",), ("",), (None,), ("p30",)], "who string")
    assert sorted(map(str, scan_recommendations(spark, target, passengers=table).collect())) == sorted(map(str, few.collect()))
    assert "passenger_bucket" in physical_plan(scan_recommendations(spark, target, passengers=table))
