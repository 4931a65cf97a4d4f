"""M5 for a hot airport or passenger: implicit ALS by partial normal equations.

MLlib puts all ratings of an item into one block, so an item with a third of all ratings is
one task's. Here the ratings are cut into even ranges twice, sorted by user and by item. A
task sums the normal equations of its range and solves every id that is whole in it; the
sums of its first and last id, which may go on in other ranges, are added and solved on the
driver, two small sums a task. The model is that of MLlib's implicit fit (confidence 1 + alpha |r|, regularisation
by the number of positive ratings); the first factors are drawn by id, so the result does
not depend on blocks, partitions or cores beyond rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators._normal_equations import FACTORS, first_factors, gram_of, matrix_of, solve_sorted, solved, sum_by_id
from wayfare.operators.joins import broadcast_if_small
from wayfare.schemas import ALS_ALPHA, ALS_MAX_ITER, ALS_RANK, ALS_REG
from wayfare.session import checkpoint_root

_FACTORS = "id int, features array<float>"
# Ratings of one range.
ROWS_A_TASK = 100_000


@dataclass
class Factors:
    """What ``recommend_top_n`` needs of a model."""

    userFactors: DataFrame
    itemFactors: DataFrame


def _gram(factors: DataFrame, rank: int) -> np.ndarray:
    """Y'Y: one rank x rank matrix from each partition."""
    found = factors.select("features").mapInArrow(lambda batches: gram_of(batches, rank), "gram array<double>").toArrow()
    return np.array(found.column("gram").to_pylist(), dtype=np.float64).reshape(-1, rank, rank).sum(axis=0)


def _ranges(ratings: DataFrame, tasks: int, side: str, other: str) -> DataFrame:
    """``ratings`` in ranges of (side, other), sorted: an id with many ratings has many ranges."""
    return ratings.repartitionByRange(tasks, side, other).sortWithinPartitions(side, other)


def _half_step(ranges: DataFrame, given: DataFrame, n_given: int, side: str, other: str, rank: int, reg: float, alpha: float) -> DataFrame:
    """Factors of ``side`` from those of ``other`` (``given``), in a written checkpoint."""
    gram = _gram(given, rank)
    renamed = given.withColumnRenamed("id", other)
    known = broadcast_if_small(renamed, known_rows=n_given)
    rows = ranges.join(known, other)
    if known is renamed:  # joined by shuffle, which deals the ratings anew
        rows = _ranges(rows, ranges.rdd.getNumPartitions(), side, other)
    rows = rows.select(F.col(side).alias("id"), "rating", "features")
    parts = rows.mapInArrow(lambda batches: solve_sorted(batches, rank, alpha, gram, reg), f"{_FACTORS}, sums array<double>").checkpoint()
    ready = parts.filter(F.col("sums").isNull()).select("id", "features")
    ends = parts.filter(F.col("sums").isNotNull()).select("id", "sums").toArrow()
    if not ends.num_rows:
        return ready
    last = solved(*sum_by_id(ends.column("id").to_numpy(), matrix_of(ends.column("sums"))), rank, gram, reg)
    return ready.unionByName(given.sparkSession.createDataFrame(pa.Table.from_batches([last], schema=FACTORS)))


def fit_partial_als(indexed: DataFrame, rank: int = ALS_RANK, reg: float = ALS_REG, alpha: float = ALS_ALPHA,
                    max_iter: int = ALS_MAX_ITER, seed: int = 42) -> Factors:
    """Fit on (user_index, item_index, rating); every (user, item) counts once for each row.

    Each iteration solves the users, then the items. Both orders of the ratings and both
    factor tables are checkpointed to the shared folder, so a lost executor costs a part of
    one half-step. An empty table gives empty factors. Ratings must be finite."""
    checkpoint_root(indexed.sparkSession)
    ratings = indexed.select(F.col("user_index").cast("int").alias("user_index"), F.col("item_index").cast("int").alias("item_index"),
                             F.col("rating").cast("float").alias("rating")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tasks = max(1, -(-ratings.count() // ROWS_A_TASK))
        by_user = _ranges(ratings, tasks, "user_index", "item_index").checkpoint()
        by_item = _ranges(ratings, tasks, "item_index", "user_index").checkpoint()
    finally:
        ratings.unpersist()
    items = (by_item.select(F.col("item_index").alias("id")).distinct()
             .mapInArrow(lambda batches: first_factors(batches, rank, seed), _FACTORS).checkpoint())
    n_users, n_items = by_user.select("user_index").distinct().count(), items.count()
    users = items.limit(0)
    for _ in range(max_iter):
        users = _half_step(by_user, items, n_items, "user_index", "item_index", rank, reg, alpha)
        items = _half_step(by_item, users, n_users, "item_index", "user_index", rank, reg, alpha)
    return Factors(users, items)


def implicit_objective(ratings: DataFrame, model, rank: int = ALS_RANK, reg: float = ALS_REG, alpha: float = ALS_ALPHA) -> float:
    """What implicit ALS minimises, over all pairs: sum of c (p - x'y)^2 plus the
    regularisation. Pairs without a rating enter through the factors' gram matrices."""
    users = model.userFactors.select(F.col("id").alias("user_index"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item_index"), F.col("features").alias("y"))
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda t, a: t + a.cast("double") * a.cast("double"))
    product = F.aggregate(F.zip_with("x", "y", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda t, a: t + a)
    liked = F.col("rating") > 0
    c = 1 + alpha * F.abs(F.col("rating").cast("double"))
    rows = ratings.join(broadcast_if_small(items), "item_index").join(users, "user_index").select(
        c.alias("c"), product.alias("s"), liked.alias("liked"), (square("x") + square("y")).alias("size"))
    fit = F.when(F.col("liked"), F.col("c") * (1 - F.col("s")) ** 2).otherwise(F.col("c") * F.col("s") ** 2) - F.col("s") ** 2
    seen = rows.agg(F.sum(fit).alias("fit"), F.sum(F.when(F.col("liked"), F.col("size"))).alias("size")).first()
    unseen = float((_gram(model.userFactors, rank) * _gram(model.itemFactors, rank)).sum())
    return unseen + (seen["fit"] or 0.0) + reg * (seen["size"] or 0.0)
