"""Attach passenger/airport labels and lookup data to per-user recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.scalar import as_ntz_literal, utc_now, utc_to_zone
from wayfare.operators.joins import broadcast_if_small
from wayfare.schemas import SERVING_ZONE


def dedupe_lookup(lookup: DataFrame) -> DataFrame:
    """One row per airport code: the smallest (city, country), nulls last.

    Optional: the original left join multiplies a recommendation by every duplicate
    of its code. A grouped min is partially aggregated, so a code repeated a third of
    the time is still combined per task before the shuffle."""
    best = F.min(F.struct(F.col("city").isNull().alias("_cn"), F.col("city"),
                          F.col("country").isNull().alias("_kn"), F.col("country")))
    return (lookup.groupBy("iata_code").agg(best.alias("_b"))
            .select(F.col("_b.city").alias("city"), F.col("_b.country").alias("country"), "iata_code"))


def attach_lookup(labelled: DataFrame, lookup: DataFrame, generated_at=None, zone: str = SERVING_ZONE,
                  lookup_rows: int | None = None) -> DataFrame:
    """J3 + P10 + X10 on (passengerId, arrivalAirport, score) rows.

    ``generated_at`` is the run's UTC instant (default: now); it is published as the
    wall-clock time of ``zone``. The lookup is broadcast only behind a size check. A
    code missing from the lookup keeps the row with null city/country; a duplicated
    code multiplies it (plain left-join semantics)."""
    run_at = utc_now() if generated_at is None else as_ntz_literal(generated_at)
    look = broadcast_if_small(lookup.select("iata_code", "city", "country"), known_rows=lookup_rows)
    joined = labelled.join(look, F.col("arrivalAirport") == F.col("iata_code"), "left")
    return joined.select(
        F.col("passengerId").alias("passenger_id"),
        F.col("arrivalAirport").alias("arrival_airport_code"),
        F.col("city").alias("arrival_city"),
        F.col("country").alias("arrival_country"),
        F.col("score").cast("double").alias("score"),
        utc_to_zone(run_at, zone).alias("generated_at"),
    )


def enrich_recommendations(recs: DataFrame, user_map: DataFrame, item_map: DataFrame,
                           lookup: DataFrame, generated_at=None, zone: str = SERVING_ZONE,
                           item_rows: int | None = None, lookup_rows: int | None = None) -> DataFrame:
    """E6 = J1 + J2 + J3 + P10 + X10 on (user_index, item_index, score) rows.

    The user map is joined by shuffle (it grows with the data); the item map is
    broadcast only when its known or counted size is small."""
    items = broadcast_if_small(item_map, known_rows=item_rows)
    labelled = recs.join(user_map, "user_index").join(items, "item_index")
    return attach_lookup(labelled, lookup, generated_at, zone, lookup_rows)
