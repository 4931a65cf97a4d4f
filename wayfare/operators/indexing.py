"""Distributed label index (frequency descending, ties by label ascending).

A label index like ML's StringIndexer (``frequencyDesc``) gathers every distinct label
on the driver. Here it stays distributed:

1. count rows per label (partial + final aggregation);
2. range-partition the (label, count) table on (count desc, label asc) and sort
   within partitions, so partition p holds a contiguous slice of the global order
   (several label columns share one pass, with the column as leading sort key);
3. number rows inside each partition;
4. checkpoint this table to the shared folder: range bounds are sampled and could
   move on recomputation, and the numbering must never change once handed out;
5. add to each row the number of rows in all earlier partitions. Those offsets are
   one count per partition, so they are bounded by the partition count, not the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.joins import broadcast_if_small
from wayfare.session import checkpoint_root

INT_MAX = 2**31 - 1


@dataclass
class LabelIndex:
    """Index table (label, index, freq) plus its exact size."""

    table: DataFrame
    size: int
    label_col: str
    index_col: str


def number_rows(df: DataFrame, order: list, index_col: str, num_partitions: int | None = None,
                group_col: str | None = None) -> tuple[DataFrame, dict]:
    """``row_number() - 1`` over a global order (restarting per ``group_col`` value),
    without funnelling the table through one task as an unpartitioned window would.

    The order must be total (no ties). Rows are range-partitioned on (group, order),
    numbered inside each partition, checkpointed to the shared folder (range bounds
    are sampled and must not move on recompute), and shifted by the number of rows of
    the same group in earlier partitions. Only one count per (partition, group)
    reaches the driver. Returns the numbered table and the row count per group."""
    spark = df.sparkSession
    checkpoint_root(spark)
    full_order = ([F.col(group_col).asc()] if group_col else []) + list(order)
    group = F.col(group_col) if group_col else F.lit(0)
    # Without an explicit count, AQE may merge adjacent ranges into fewer partitions
    # of its advisory size; merged partitions stay contiguous in the global order, and
    # the partition id is read after the merge, so the offsets below remain exact.
    ranged_in = (df.repartitionByRange(int(num_partitions), *full_order) if num_partitions
                 else df.repartitionByRange(*full_order))
    ranged = (ranged_in
              .sortWithinPartitions(*full_order)
              .select("*", group.alias("_group"),
                      F.spark_partition_id().alias("_part"),
                      (F.monotonically_increasing_id()
                       - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("_pos"))
              .checkpoint(eager=True))
    counts = {(r["_part"], r["_group"]): r["cnt"] for r in
              ranged.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    # One pass over partitions in order: a row of group g in partition p is shifted by
    # the rows of g in earlier partitions, minus the rows of earlier groups in p (they
    # sort first there and are already counted in the row's position).
    groups = sorted({g for _, g in counts})
    running = {g: 0 for g in groups}
    adjust = {}
    for p in sorted({p for p, _ in counts}):
        before_in_p = 0
        for g in groups:
            c = counts.get((p, g), 0)
            if c:
                adjust[(p, g)] = running[g] - before_in_p
            before_in_p += c
            running[g] += c
    sizes = dict(running)
    if any(v > INT_MAX for v in sizes.values()):
        raise ValueError("row count exceeds the int index range")
    if not adjust:
        return ranged.withColumn(index_col, F.lit(None).cast("int")).drop("_group", "_part", "_pos"), sizes
    # One offset per (partition, group): a table bounded by the partition count, so
    # broadcasting it is safe at any data size (no map literal carried in every task). As an
    # Arrow table it is read by the JVM alone; rows would take a Python worker for each core.
    offsets = spark.createDataFrame(pa.table({
        "_part": pa.array([p for p, _ in adjust], pa.int32()), "_group": pa.array([g for _, g in adjust], pa.int32()),
        "_shift": pa.array(list(adjust.values()), pa.int64())}))
    numbered = (ranged.join(F.broadcast(offsets), ["_part", "_group"])
                .withColumn(index_col, (F.col("_shift") + F.col("_pos")).cast("int"))
                .drop("_group", "_part", "_pos", "_shift"))
    return numbered, sizes


def build_label_indexes(df: DataFrame, specs: list[tuple[str, str]],
                        num_partitions: int | None = None) -> list[LabelIndex]:
    """M1/M2 for several label columns in one pass: one range partitioning, one
    checkpoint and one collect of per-partition counts serve all of them.

    ``specs`` lists (label_col, index_col). Labels are compared as strings. Index 0
    goes to the most frequent label, ties to the smaller label; nulls get no index."""
    freqs = None
    for kind, (label_col, _) in enumerate(specs):
        f = (df.select(F.col(label_col).cast("string").alias("label")).filter(F.col("label").isNotNull())
             .groupBy("label").agg(F.count(F.lit(1)).alias("freq"))
             .select(F.lit(kind).alias("kind"), "label", "freq"))
        freqs = f if freqs is None else freqs.unionByName(f)
    numbered, sizes = number_rows(freqs, [F.col("freq").desc(), F.col("label").asc()], "_index",
                                  num_partitions, group_col="kind")
    out = []
    for kind, (label_col, index_col) in enumerate(specs):
        table = numbered.filter(F.col("kind") == kind).select(
            F.col("label").alias(label_col), F.col("_index").alias(index_col), F.col("freq"))
        out.append(LabelIndex(table=table, size=sizes.get(kind, 0), label_col=label_col, index_col=index_col))
    return out


def build_label_index(df: DataFrame, label_col: str, index_col: str,
                      num_partitions: int | None = None) -> LabelIndex:
    """M1/M2: index 0 for the most frequent label; null labels get no index."""
    return build_label_indexes(df, [(label_col, index_col)], num_partitions)[0]


@dataclass
class IndexedInteractions:
    indexed: DataFrame
    user_index: LabelIndex
    item_index: LabelIndex
    source: DataFrame | None = None

    def release(self) -> None:
        self.indexed.unpersist()
        if self.source is not None:
            self.source.unpersist()

    @property
    def user_map(self) -> DataFrame:
        """M4: user_index -> passengerId."""
        return self.user_index.table.select("user_index", "passengerId")

    @property
    def item_map(self) -> DataFrame:
        """M4: item_index -> arrivalAirport."""
        return self.item_index.table.select("item_index", "arrivalAirport")


def index_interactions(inter: DataFrame, num_partitions: int | None = None,
                       persist_input: bool = True) -> IndexedInteractions:
    """E4 (M1-M4, F3): both label indexes, applied by equi-join.

    Users are joined by shuffle (both sides grow with the data). The item index is
    broadcast only when its exact size (known from its construction) is small.
    Inner joins drop rows whose passenger or airport is null (the "skip" rule).
    The interactions are read by the index build and by the joins, so they are
    persisted (deterministic input: a lost block recomputes to the same rows)."""
    if persist_input:
        inter = inter.persist(StorageLevel.MEMORY_AND_DISK)
    users, items = build_label_indexes(
        inter, [("passengerId", "user_index"), ("arrivalAirport", "item_index")], num_partitions)
    item_side = broadcast_if_small(items.table.select("arrivalAirport", "item_index"), known_rows=items.size)
    indexed = (inter
               .join(users.table.select("passengerId", "user_index"), "passengerId")
               .join(item_side, "arrivalAirport")
               .select("passengerId", "arrivalAirport",
                       F.col("user_index").cast("int").alias("user_index"),
                       F.col("item_index").cast("int").alias("item_index"),
                       F.col("strength").cast("float").alias("rating")))
    return IndexedInteractions(indexed=indexed, user_index=users, item_index=items, source=inter)
