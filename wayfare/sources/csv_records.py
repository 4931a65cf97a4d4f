"""S3 with line breaks inside quotes, in parallel: CSV records from byte ranges.

Spark reads a file with quoted line breaks in one task. Here the file is read as lines, in as
many ranges as Spark cuts it into. Whether a range begins inside quotes follows from the
number of quotes before it: each range counts its own, and a sum over the ranges of a file,
one row each, gives the rest. A line then starts a record unless it begins inside quotes.
Records of one line go on as they are; the lines of others, which may lie in several ranges,
are brought together by the record's number, again a sum over ranges.

This needs quotes to be balanced: a field that holds a quote is itself quoted and doubles it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.operators.joins import broadcast_if_small
from wayfare.session import checkpoint_root

_RANGE = ["_file", "_range"]


def _quotes(text: str = "value") -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _before(column: str) -> Column:
    """The sum of ``column`` over the earlier ranges of the file."""
    earlier = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the text of each record without its line end, ``first`` for the
    first of a file, which holds the header. Empty lines outside quotes are left out."""
    checkpoint_root(spark)
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range"),
                     F.monotonically_increasing_id().alias("_line")))
    counted = lines.groupBy(*_RANGE).agg((F.sum(_quotes()) % 2).alias("_odd"))
    opening = counted.select(*_RANGE, (_before("_odd") % 2).alias("_open")).checkpoint()
    in_range = Window.partitionBy(*_RANGE).orderBy("_line")
    so_far = F.coalesce(F.sum(_quotes()).over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = (lines.join(broadcast_if_small(opening), _RANGE)
              .withColumn("_starts", (F.col("_open") + so_far) % 2 == 0)
              .withColumn("_ends", (F.col("_open") + so_far + _quotes()) % 2 == 0)
              .filter(~(F.col("_starts") & F.col("value").isin("", "\r"))))
    starts = marked.groupBy(*_RANGE).agg(F.sum(F.col("_starts").cast("long")).alias("_number"))
    numbered = starts.select(*_RANGE, _before("_number").alias("_earlier")).checkpoint()
    lined = (marked.withColumn("_place", F.sum(F.col("_starts").cast("long")).over(in_range))
             .join(broadcast_if_small(numbered), _RANGE)
             .withColumn("_record", F.col("_earlier") + F.col("_place")))
    one = lined.filter("_starts AND _ends").select("_file", "_record", F.col("value").alias("record"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_range", "_line", "value"))), lambda x: x["value"])
    more = (lined.filter("NOT (_starts AND _ends)").groupBy("_file", "_record")
            .agg(F.array_join(parts, "\n").alias("record")))
    first = F.col("_record") == 1
    text = F.regexp_replace("record", "\r\\z", "")
    return one.unionByName(more).select(F.col("_file").alias("file"), first.alias("first"),
                                        F.when(first, F.ltrim(text, F.lit("\ufeff"))).otherwise(text).alias("record"))
