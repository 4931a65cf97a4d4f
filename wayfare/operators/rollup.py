"""Daily partial strengths: E3 without reading the whole lookback again every day.

``refresh_daily_strengths`` keeps a table, partitioned by day, of the exact sum of status
weights and the number of events of each (day, passenger, airport). The lookback's strength
is then the sum of its whole days' rows and of one day of raw events, the day that the
cutoff falls into. Sums are decimals, so the result equals that over the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.scalar import lookback_cutoff, status_weight
from wayfare.operators.interactions import positive_strengths
from wayfare.schemas import LOOKBACK_DAYS, PARTITION_COL
from wayfare.sources.readers import scan_events

WEIGHT = "decimal(38,1)"
ROLLUP_DDL = f"passengerId string, arrivalAirport string, weight {WEIGHT}, n_events long, {PARTITION_COL} date"


def daily_strengths(events: DataFrame) -> DataFrame:
    """(event_day, passengerId, arrivalAirport, weight, n_events) of events with their day.
    A pair whose weights sum to 0 keeps its row: other days may add to it."""
    return (events.groupBy(PARTITION_COL, "passengerId", "arrivalAirport")
            .agg(F.sum(status_weight("flightStatus")).cast(WEIGHT).alias("weight"), F.count(F.lit(1)).alias("n_events"))
            .select("passengerId", "arrivalAirport", "weight", "n_events", PARTITION_COL))


def scan_daily_strengths(spark: SparkSession, rollup: str) -> DataFrame:
    """The table below ``rollup``; no rows if nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(rollup)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], ROLLUP_DDL)
    return spark.read.schema(ROLLUP_DDL).parquet(rollup)


def stale_days(events: DataFrame, rollup: DataFrame) -> list:
    """Days with events that the rollup has not counted: new days and late events.

    The events' counts come from file footers (no column is read); one row for each stale
    day reaches the driver."""
    have = events.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("_have"))
    known = rollup.groupBy(F.col(PARTITION_COL).alias("_day")).agg(F.sum("n_events").alias("_known"))
    both = have.join(known, F.col("_day") == F.col(PARTITION_COL), "left")
    return sorted(r[0] for r in both.filter(~F.col("_have").eqNullSafe(F.col("_known"))).select(PARTITION_COL).collect())


def refresh_daily_strengths(spark: SparkSession, source: str, rollup: str, days: list | None = None) -> list:
    """Bring the rollup up to date with the event table: rewrite the partitions of ``days``
    (none given: the stale ones) from those days of the table alone. Returns the days.

    A day's partition is replaced whole, so a refresh that fails is simply run again. Rows
    without a day cannot fall into a lookback and are not kept."""
    events = scan_events(spark, source)
    if days is None:
        days = stale_days(events.filter(F.col(PARTITION_COL).isNotNull()), scan_daily_strengths(spark, rollup))
    days = [d for d in days if d is not None]
    if days:
        of_days = events.filter(F.col(PARTITION_COL).isin([F.lit(str(d)).cast("date") for d in days]))
        (daily_strengths(of_days).repartition(PARTITION_COL, "passengerId")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(rollup))
    return days


def interaction_strength_from_daily(events: DataFrame, daily: DataFrame, as_of,
                                    lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """E3 from the rollup and the one day of ``events`` that the cutoff cuts."""
    cutoff = lookback_cutoff(as_of, lookback_days)
    day = F.to_date(cutoff)
    cut = events.filter((F.col(PARTITION_COL) == day) & (F.col("timestamp") > cutoff)).select(
        "passengerId", "arrivalAirport", status_weight("flightStatus").cast(WEIGHT).alias("weight"))
    whole = daily.filter(F.col(PARTITION_COL) > day).select("passengerId", "arrivalAirport", "weight")
    return positive_strengths(whole.unionByName(cut), F.col("weight"))
