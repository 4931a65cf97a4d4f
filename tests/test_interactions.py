import datetime as dt

from pyspark.sql import functions as F

from wayfare.operators.indexing import index_interactions
from wayfare.operators.interactions import interaction_strength

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "passengerId string, arrivalAirport string, flightStatus string, timestamp timestamp_ntz"
T = dt.datetime(2024, 1, 30)


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_strength_rules(spark):
    rows = [
        ("p1", "A", "On Time", T), ("p1", "A", "Delayed", T),           # 1.6
        ("p2", "A", "Cancelled", T),                                      # absent
        ("p3", "A", "Cancelled", T), ("p3", "A", None, T),                # 0.3
        ("p4", "A", "on time", T),                                        # 0.3
        ("p5", "A", "On Time", dt.datetime(2024, 1, 17)),                 # exactly at cutoff: out
        ("p6", "A", "Delayed", T), ("p6", "A", "Delayed", T), ("p6", "A", "Delayed", T),  # exactly 1.8
    ]
    got = {(r.passengerId, r.arrivalAirport): r.strength
           for r in interaction_strength(_events(spark, rows), AS_OF, 14).collect()}
    assert got == {("p1", "A"): 1.6, ("p3", "A"): 0.3, ("p4", "A"): 0.3, ("p6", "A"): 1.8}


def test_null_keys_dropped_by_indexing(spark):
    rows = [("p1", "A", "On Time", T), (None, "A", "On Time", T), ("p2", None, "On Time", T),
            ("p2", "B", "On Time", T)]
    inter = interaction_strength(_events(spark, rows), AS_OF, 14)
    assert inter.count() == 4  # grouping keeps null keys ...
    idx = index_interactions(inter)
    pairs = {(r.passengerId, r.arrivalAirport) for r in idx.indexed.collect()}
    assert pairs == {("p1", "A"), ("p2", "B")}  # ... indexing skips them
    # p2 has two interaction rows (one with a null airport): it is the most frequent user.
    users = {r.passengerId: r.user_index for r in idx.user_index.table.collect()}
    assert users == {"p2": 0, "p1": 1}


def test_partition_pruning_on_event_day(spark, tmp_path):
    from wayfare.plans.inspect import physical_plan
    from wayfare.schemas import EVENT_FIELDS
    from wayfare.sinks import append_events
    ev = _events(spark, [("p1", "A", "On Time", T), ("p1", "A", "On Time", dt.datetime(2023, 6, 1))])
    cols = [F.col(c) if c in ev.columns else (F.lit(1) if c == "age" else F.lit("")).alias(c)
            for c in EVENT_FIELDS]
    append_events(ev.select(*cols), str(tmp_path / "lake"))
    lake = spark.read.parquet(str(tmp_path / "lake"))
    q = interaction_strength(lake, AS_OF, 14)
    plan = physical_plan(q)
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThan(timestamp" in plan
    assert [r.strength for r in q.collect()] == [1.0]
