"""Recent events -> weighted (passenger, airport) interaction strengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.scalar import lookback_cutoff, status_weight
from wayfare.schemas import LOOKBACK_DAYS

PARTITION_COL = "event_day"


def recent_events(events: DataFrame, as_of, lookback_days: int = LOOKBACK_DAYS,
                  ts_col: str = "timestamp") -> DataFrame:
    """keep events strictly after ``as_of - lookback_days``.

    The timestamp predicate is pushed to the Parquet scan. On a day-partitioned
    table an extra ``event_day >= day(cutoff)`` predicate prunes whole partitions
    (a timestamp predicate alone does not)."""
    cutoff = lookback_cutoff(as_of, lookback_days)
    if PARTITION_COL in events.columns:
        events = events.filter(F.col(PARTITION_COL) >= F.to_date(cutoff))
    return events.filter(F.col(ts_col) > cutoff)


def interaction_strength(events: DataFrame, as_of, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """A1 + X1 + F2: sum of status weights per (passengerId, arrivalAirport), kept if > 0.

    The sum is exact (decimal) and cast to double at the end. Aggregation is partial
    per map task then final per key, so a passenger holding a third of all events
    still sends only one partial row per (task, airport) through the shuffle."""
    return positive_strengths(recent_events(events, as_of, lookback_days), status_weight("flightStatus"))


def positive_strengths(rows: DataFrame, weight: Column) -> DataFrame:
    """The exact sum of ``weight`` per (passengerId, arrivalAirport), where it is above 0."""
    agg = rows.groupBy("passengerId", "arrivalAirport").agg(F.sum(weight).alias("_strength"))
    return (agg.filter(F.col("_strength") > 0)
            .select("passengerId", "arrivalAirport", F.col("_strength").cast("double").alias("strength")))
