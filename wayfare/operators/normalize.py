"""Raw dataset rows -> typed events, with rejected rows set aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.scalar import epoch_millis_of, millis_to_utc, parse_int_strict
from wayfare.schemas import EVENT_FIELDS, RAW_CSV_HEADERS, RAW_TO_FIELD


@dataclass
class Normalized:
    events: DataFrame   # the 16 typed event fields
    rejects: DataFrame  # the 15 raw columns + reason


def _with_reason(raw: DataFrame, clock: Column | None) -> DataFrame:
    missing = [h for h in RAW_CSV_HEADERS if h not in raw.columns]
    if missing:
        raise ValueError(f"raw rows lack columns: {missing}")
    millis = F.unix_millis(F.current_timestamp()) if clock is None else clock
    staged = raw.select(*[F.col(f"`{h}`").alias(RAW_TO_FIELD[h]) for h in RAW_CSV_HEADERS],
                        millis.cast("long").alias("_millis"))
    null_field = None
    for f in EVENT_FIELDS[:-1]:
        cond = F.col(f).isNull()
        label = F.lit(f"null:{f}")
        null_field = F.when(cond, label) if null_field is None else null_field.when(cond, label)
    age = parse_int_strict("age")
    reason = null_field.when(age.isNull(), F.lit("age"))
    return staged.withColumn("_age", age).withColumn("_reason", reason)


def normalize_events(raw: DataFrame, clock: Column | None = None) -> Normalized:
    """Rename the 15 headers to event fields, parse ``age`` strictly, stamp the ingest
    time (epoch millis from ``clock``, default now) as a zone-less UTC timestamp.

    A row is rejected when a field is null (reason ``null:<field>``) or age is not a
    plain integer (reason ``age``). Both outputs come from one projection; callers
    that need both should persist it."""
    staged = _with_reason(raw, clock)
    fields = [F.col("_age").alias("age") if f == "age" else F.col(f) for f in EVENT_FIELDS[:-1]]
    events = staged.filter(F.col("_reason").isNull()).select(
        *fields, millis_to_utc("_millis").alias("timestamp"))
    rejects = staged.filter(F.col("_reason").isNotNull()).select(
        *[F.col(RAW_TO_FIELD[h]).alias(h) for h in RAW_CSV_HEADERS], F.col("_reason").alias("reason"))
    return Normalized(events=events, rejects=rejects)


def clock_from(ts_col: str) -> Column:
    """An injectable clock: epoch millis of a zone-less UTC timestamp column."""
    return epoch_millis_of(ts_col)
