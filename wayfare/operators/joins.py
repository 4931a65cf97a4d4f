"""Join helpers: broadcast only behind a size check, shuffle join otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast up to this many rows and this many bytes, as its schema sizes a row.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def row_bytes(df: DataFrame) -> int:
    """An estimate of a row in memory: the default size Spark gives each type."""
    return 8 + sum(df.sparkSession._jvm.org.apache.spark.sql.types.DataType.fromJson(f.dataType.json()).defaultSize()
                   for f in df.schema.fields)


def broadcast_if_small(df: DataFrame, known_rows: int | None = None,
                       max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it is proven to have at most max_rows rows and,
    by the size of its types, at most max_bytes bytes.

    ``known_rows`` skips the count when the caller already knows the exact size (e.g.
    an index whose size falls out of its construction). The count is a partial
    aggregate: one number from each task. Larger sides are returned untouched and joined
    by shuffle, where AQE may still switch to a broadcast from runtime statistics."""
    rows = df.count() if known_rows is None else known_rows
    return F.broadcast(df) if rows <= max_rows and rows * row_bytes(df) <= max_bytes else df
