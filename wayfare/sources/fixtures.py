"""Mapping of the given test tables onto the roles the engine works with.

- ``events`` plays the flight event log: passenger <- user_id, arrival airport <-
  ``$.k`` of props, flight status <- event_type, timestamp <- ts.
- ``nation`` joined to ``region`` plays the airport lookup: code <- n_nationkey,
  city <- n_name, country <- r_name.
- ``orders`` joined to ``lineitem`` is a larger event log: passenger <- o_custkey,
  airport <- l_suppkey, status <- o_orderstatus, timestamp <- o_orderdate.

All mappings are projections over full tables; Spark prunes the columns they do not
use and pushes filters through them to the scans.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import EVENT_FIELDS, RAW_CSV_HEADERS

# Fixed values of the test mapping: event type -> flight status; other types keep their text.
EVENT_TYPE_STATUS = {"purchase": "On Time", "click": "Delayed", "error": "Cancelled"}
# Order status -> flight status.
ORDER_STATUS_STATUS = {"F": "On Time", "O": "Delayed", "P": "Cancelled"}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _map_text(c: Column, mapping: dict[str, str], default: Column | None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(default if default is not None else F.lit(None))


def event_status(event_type="event_type") -> Column:
    c = F.col(event_type)
    return _map_text(c, EVENT_TYPE_STATUS, c)


def events_from_event_log(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The four event fields the recommender reads, from the ``events`` table
    (plus any source columns named in ``keep``)."""
    return events.select(
        *keep,
        F.col("user_id").cast("string").alias("passengerId"),
        F.get_json_object("props", "$.k").alias("arrivalAirport"),
        event_status().alias("flightStatus"),
        F.col("ts").alias("timestamp"),
    )


def events_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A larger event log: one event per order line (shuffle join on the order key)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_suppkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("passengerId"),
        F.col("l_suppkey").cast("string").alias("arrivalAirport"),
        _map_text(F.col("o_orderstatus"), ORDER_STATUS_STATUS, F.col("o_orderstatus")).alias("flightStatus"),
        F.col("o_orderdate").alias("timestamp"),
    )


def lookup_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Airport lookup (city, country, iata_code) from nation and region."""
    r = region.select("r_regionkey", "r_name")
    return nation.join(r, nation.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.col("n_nationkey").cast("string").alias("iata_code"),
    )


def raw_rows_from_event_log(events: DataFrame) -> DataFrame:
    """Raw dataset rows (15 string columns named as the CSV header) from ``events``.

    Text fields are derived from the row; ``Age`` is the whole part of ``value``,
    except for error events, whose age is the full decimal text of ``value`` and so
    is rejected by normalisation."""
    uid = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    age = F.when(F.col("event_type") == "error", F.col("value").cast("string")) \
        .otherwise(F.floor("value").cast("bigint").cast("string"))
    values = {
        "Passenger ID": uid,
        "First Name": F.concat(F.lit("first-"), uid),
        "Last Name": F.concat(F.lit("last-"), uid),
        "Gender": F.lit(""),
        "Age": age,
        "Nationality": F.lit(""),
        "Airport Name": F.concat(F.lit("airport-"), k),
        "Airport Country Code": F.lit(""),
        "Country Name": F.lit(""),
        "Airport Continent": F.lit(""),
        "Continents": F.lit(""),
        "Departure Date": F.to_date("ts").cast("string"),
        "Arrival Airport": k,
        "Pilot Name": F.lit(""),
        "Flight Status": event_status(),
    }
    return events.select(*[values[h].alias(h) for h in RAW_CSV_HEADERS], F.col("ts").alias("_ingest_ts"))


assert len(EVENT_FIELDS) == len(RAW_CSV_HEADERS) + 1
