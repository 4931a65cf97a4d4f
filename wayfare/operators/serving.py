"""The two serving lookups, answered in bulk for every passenger (or a list).

The response drops the score (P11) and hides rows without a city (F8). Order by
score is carried by an explicit ``position`` column, since a bulk result has no
row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.scalar import day_window


def _only_passengers(recs: DataFrame, passengers: DataFrame | None) -> DataFrame:
    """F6 in bulk: a semi-join against a list of passenger ids."""
    if passengers is None:
        return recs
    ids = passengers.select(F.col(passengers.columns[0]).cast("string").alias("passenger_id"))
    return recs.join(ids, "passenger_id", "left_semi")


def _response(rows: DataFrame) -> DataFrame:
    """F8 + T4 + P11: drop null cities, number by score desc, project the response."""
    kept = rows.filter(F.col("arrival_city").isNotNull())
    w = Window.partitionBy("passenger_id").orderBy(
        F.col("score").desc(), F.col("generated_at").desc(), F.col("arrival_airport_code").asc())
    return kept.select(
        F.col("passenger_id").alias("passengerId"),
        F.col("arrival_airport_code").alias("airportCode"),
        F.col("arrival_city").alias("city"),
        F.col("arrival_country").alias("country"),
        F.col("generated_at").alias("generatedAt"),
        F.row_number().over(w).alias("position"),
    )


def latest_recommendations(recs: DataFrame, passengers: DataFrame | None = None) -> DataFrame:
    """E9 (J8/A6): each passenger's rows from their newest run only.

    The correlated ``= max(generated_at)`` is a rank of 1 by generated_at descending: one
    scan, and each task drops a passenger's older runs before the shuffle. The null-city
    filter runs after it, so a newest run holding only unknown airports yields nothing
    for that passenger. Rows without a passenger or a time match no lookup."""
    r = _only_passengers(recs, passengers).filter("passenger_id IS NOT NULL AND generated_at IS NOT NULL")
    by_time = Window.partitionBy("passenger_id").orderBy(F.col("generated_at").desc())
    return _response(r.withColumn("_age", F.rank().over(by_time)).filter("_age = 1"))


def recommendations_on(recs: DataFrame, day, passengers: DataFrame | None = None) -> DataFrame:
    """E10 (F7 + X13): rows generated within [day 00:00, next day 00:00)."""
    start, end = day_window(day)
    r = _only_passengers(recs, passengers)
    return _response(r.filter((F.col("generated_at") >= start) & (F.col("generated_at") < end)))
