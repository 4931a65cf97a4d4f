"""Schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the original job's values for equal results.
# ---------------------------------------------------------------------------

# Header names of the raw dataset CSV, and the event field each one fills, in order.
RAW_CSV_HEADERS = [
    "Passenger ID", "First Name", "Last Name", "Gender", "Age", "Nationality",
    "Airport Name", "Airport Country Code", "Country Name", "Airport Continent",
    "Continents", "Departure Date", "Arrival Airport", "Pilot Name", "Flight Status",
]
EVENT_FIELDS = [
    "passengerId", "firstName", "lastName", "gender", "age", "nationality",
    "airportName", "airportCountryCode", "countryName", "airportContinent",
    "continents", "departureDate", "arrivalAirport", "pilotName", "flightStatus",
    "timestamp",
]

# Flight status weights (exact text, case-sensitive); any other value, null included, weighs 0.3.
STATUS_WEIGHTS = {"On Time": "1.0", "Delayed": "0.6", "Cancelled": "0.0"}
OTHER_STATUS_WEIGHT = "0.3"

TOP_K = 5
LOOKBACK_DAYS = 90
CANDIDATES = 50
SPLIT_SEED = 42
SERVING_ZONE = "Asia/Tehran"
MIN_EVAL_ROWS = 10

# Implicit-feedback ALS settings.
ALS_RANK = 20
ALS_REG = 0.1
ALS_ALPHA = 20.0
ALS_MAX_ITER = 15
ALS_BLOCKS = 10

# Partition columns of the event table: UTC day, and the batch that wrote the rows.
PARTITION_COL = "event_day"
BATCH_COL = "ingest_batch"

# Partition columns of published runs with the serving layout.
DAY_COL = "generated_day"
BUCKET_COL = "passenger_bucket"

# JDBC publish settings.
JDBC_BATCH_SIZE = 10000
JDBC_WRITERS = 8

# ---------------------------------------------------------------------------

RAW_TO_FIELD = dict(zip(RAW_CSV_HEADERS, EVENT_FIELDS[:-1]))

RAW_CSV_SCHEMA = T.StructType([T.StructField(h, T.StringType(), True) for h in RAW_CSV_HEADERS])

EVENT_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType(), True) for f in EVENT_FIELDS[:4]]
    + [T.StructField("age", T.IntegerType(), True)]
    + [T.StructField(f, T.StringType(), True) for f in EVENT_FIELDS[5:15]]
    + [T.StructField("timestamp", T.TimestampNTZType(), True)]
)

# Wire payload of one event: the timestamp travels as epoch milliseconds.
PAYLOAD_SCHEMA = T.StructType(
    [f if f.name != "timestamp" else T.StructField("timestamp", T.LongType(), True)
     for f in EVENT_SCHEMA.fields]
)

# Airport lookup CSV: headerless; only positions 2, 3 and 4 are used.
LOOKUP_CSV_SCHEMA = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(5)])
