"""Helpers that several operators share: scratch tables, Arrow plumbing, components."""

from __future__ import annotations

import contextlib
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import scratch_path

# Rows handled at a time inside one Arrow batch, so a task holds few texts at once.
SLICE_ROWS = 256


_watching: list[list[Scratch]] = []


@contextlib.contextmanager
def scratches() -> Iterator[list[Scratch]]:
    """The Scratch objects made inside the block, so that a caller that has written what it
    got can remove what it was read from (``keep_only()``)."""
    made: list[Scratch] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching.remove(made)


def refuse_clash(columns: Iterable[str], taken: Iterable[str]) -> None:
    """An error before any job if a carried column has the name of a result or working one."""
    clash = sorted(set(columns) & set(taken))
    if clash:
        raise ValueError(f"carried columns clash with result or working columns: {clash}")


class Scratch:
    """Tables written below ``spark.checkpoint.dir``; ``drop`` and ``keep_only`` remove
    finished ones.

    A written table cuts lineage, survives lost executors and carries no partitioning,
    so joins on it get exchanges whose skewed partitions AQE can split."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, name), []
        for made in _watching:
            made.append(self)

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.root}/{len(self.paths):03d}-{label}"
        self.paths.append(path)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that no later step and no result reads."""
        self._delete(table.scratch_path for table in tables)

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all written tables but those that the result reads."""
        self._delete(set(self.paths) - {table.scratch_path for table in tables})

    def _delete(self, paths) -> None:
        for name in paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def no_collection() -> Iterator[None]:
    """Without cyclic garbage collection inside the block. A worker's caches hold many objects
    and no cycles, and each collection would walk all of them."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def worker_cache(key: str, make: Callable[[], object]) -> object:
    """An object kept for the life of a Python worker, across the tasks it serves."""
    holder = sys.modules.setdefault("_wayfare_llm_worker", types.ModuleType("_wayfare_llm_worker"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def map_slices(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over small slices, as dicts of Python lists.

    ``make`` runs once per task and returns the function of a slice, which gives a dict
    of columns (lists or numpy arrays) named as in ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                with no_collection():
                    out = fn(batch.slice(at, SLICE_ROWS).to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type, from_pandas=False) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """One pandas frame for each run of equal ``keys`` (integers) in sorted batches.

    A run is held whole, so callers bound the rows that share a key."""
    rest = None
    for batch in batches:
        frame = batch.to_pandas()
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        values = frame[keys].to_numpy()
        at = 0
        for cut in (np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist():
            yield frame.iloc[at:cut]
            at = cut
        rest = frame.iloc[at:]
    if rest is not None and len(rest):
        yield rest


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u > v) is either a centre or has one edge to one."""
    roles = (edges.select(F.col("u").alias("node"), F.lit(1).alias("own"), F.lit(0).alias("centre"))
             .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("own"), F.lit(1).alias("centre"))))
    return (roles.groupBy("node").agg(F.sum("own").alias("own"), F.max("centre").alias("centre"))
            .filter("own + centre > 1").isEmpty())


def connected_components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v longs); component is the
    smallest node reachable.

    Alternating large-star and small-star rounds: every round links the neighbours of a
    node to the smallest of them, until the edges are stars around each component's
    minimum. Nothing but that answer reaches the driver. Each round is a written table,
    so a lost executor costs at most one round. A hub with very many neighbours is a
    partial ``min`` and a join that AQE can split."""
    edges = scratch.write(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.min("v").alias("m"))
                            .select("u", F.least("u", "m").alias("m")), "large")
        large = scratch.write(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .filter("u != v").distinct(), "large-edges")
        low2 = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        joined = large.join(low2, "u")
        small = scratch.write(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .filter("u != v").distinct(), "small-edges")
        scratch.drop(edges, low, large, low2)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
