"""Column expressions. All are built-in Spark expressions, so they stay inside
whole-stage codegen; none depends on the session time zone."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.schemas import OTHER_STATUS_WEIGHT, SPLIT_SEED, STATUS_WEIGHTS

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# ISO-8601 date-time as the event writer accepts it: date, 'T', hours and minutes,
# optional seconds and fraction, then optionally 'Z' or a numeric offset.
ISO_DATE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)?$"
ISO_ZONED_SUFFIX = r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"


# 0001-01-01T00:00:00.000Z and 9999-12-31T23:59:59.999Z.
MIN_MILLIS, MAX_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ntz_literal(value) -> Column:
    """A zone-less timestamp literal from a str/date/datetime (or a Column, passed through)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def status_weight(status="flightStatus") -> Column:
    """Weight of a flight status; exact-match, anything else (null too) is the default.

    Exact decimals, so a sum of weights does not depend on summation order."""
    expr = None
    for text, weight in STATUS_WEIGHTS.items():
        cond = _col(status) == F.lit(text)
        w = F.lit(Decimal(weight))
        expr = F.when(cond, w) if expr is None else expr.when(cond, w)
    return expr.otherwise(F.lit(Decimal(OTHER_STATUS_WEIGHT)))


def millis_to_utc(millis) -> Column:
    """Epoch milliseconds -> zone-less UTC timestamp; null outside years 1 to 9999,
    so that no payload can make the conversion overflow."""
    ms = _col(millis).cast("long")
    return F.when(ms.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH)))


def epoch_millis_of(ts) -> Column:
    """Zone-less UTC timestamp -> epoch milliseconds (inverse of X6), floored like
    ``Instant.toEpochMilli``.

    Built from parts that never consult the session time zone (day number, hour,
    minute, seconds with fraction). ``timestampdiff`` on a zone-less value converts it
    through the session zone first, which shifts wall-clock times that do not exist
    there (a daylight-saving gap) by an hour."""
    c = _col(ts)
    return (F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000)
            + F.hour(c).cast("long") * F.lit(3_600_000)
            + F.minute(c).cast("long") * F.lit(60_000)
            + F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("long"))


def iso_text_to_utc(text) -> Column:
    """ISO-8601 text -> zone-less UTC timestamp, or null.

    Text with 'Z' or an offset is an instant; text without one is read as UTC wall
    clock. Anything else (a bare date, 'yesterday', a bare year) is null, although
    Spark's own cast would accept some of those; the pattern guard rules them out."""
    t = F.upper(_col(text))  # ISO parsers read 't' and 'z' like 'T' and 'Z'
    ok = t.rlike(ISO_DATE_TIME)
    zoned = t.rlike(ISO_ZONED_SUFFIX)
    instant = F.timestamp_add("MICROSECOND", F.unix_micros(t.try_cast("timestamp")), F.expr(_EPOCH))
    local = t.try_cast("timestamp_ntz")
    return F.when(ok & zoned, instant).when(ok, local)


def day_of(ts) -> Column:
    """The UTC day of a zone-less timestamp."""
    return F.to_date(_col(ts))


def days_since_epoch(ts) -> Column:
    """Days since 1970-01-01 of a zone-less timestamp."""
    return F.unix_date(F.to_date(_col(ts)))


def lookback_cutoff(as_of, days: int) -> Column:
    """as_of minus N days, as a zone-less timestamp (constant-folded)."""
    return as_ntz_literal(as_of) - F.make_dt_interval(F.lit(int(days)))


def utc_now() -> Column:
    """X11: current UTC wall clock, zone-less; constant within one query."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def utc_to_zone(ts, zone: str) -> Column:
    """UTC wall clock -> wall clock of `zone` (both zone-less)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def day_window(day) -> tuple[Column, Column]:
    """[start of day, start of next day) as zone-less timestamps."""
    start = F.to_date(F.lit(str(day))).cast("timestamp_ntz")
    return start, start + F.make_dt_interval(F.lit(1))


def holdout_key(user="user_index", item="item_index", seed: int = SPLIT_SEED) -> Column:
    """A seeded pseudo-random sort key per (user, item) that any engine can recompute.

    md5 of 'seed|user|item' as lowercase hex; unlike rand(seed) it does not depend on
    partitioning and is identical on every recomputation."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), _col(user).cast("string"), _col(item).cast("string")))


def parse_int_strict(text) -> Column:
    """Integer text as a strict integer parser reads it: optional sign and ASCII digits
    only, no blanks or decimals, within int range; else null."""
    t = _col(text)
    return F.when(t.rlike(INTEGER_TEXT), t.try_cast("int"))
