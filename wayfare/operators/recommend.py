"""E5: implicit-feedback ALS and the per-user top-N it recommends."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators._scoring import ItemBlock, item_block, score_batches
from wayfare.operators.indexing import number_rows
from wayfare.operators.joins import broadcast_if_small
from wayfare.schemas import ALS_ALPHA, ALS_BLOCKS, ALS_MAX_ITER, ALS_RANK, ALS_REG, TOP_K
from wayfare.session import checkpoint_root, scratch_path

# Item factors scored in one pass: this many bytes reach the driver and each executor.
ITEM_BLOCK_BYTES = 16 * 1024 * 1024
# Places in one of Spark's bitmaps.
BITMAP_BITS = 8 * 4096
# A task scores about this many (user, item) pairs of a block: users are dealt to more tasks.
PAIRS_A_TASK = 2_000_000_000


def make_als(rank: int = ALS_RANK, reg: float = ALS_REG, alpha: float = ALS_ALPHA,
             max_iter: int = ALS_MAX_ITER, seed: int = 42, num_blocks: int = ALS_BLOCKS,
             checkpoint_interval: int = 5) -> ALS:
    """Implicit ALS with cold-start drop.

    ``num_blocks`` user and item blocks are part of the result: initial factors are drawn
    block by block. The default is MLlib's own; raise it for data whose blocks would
    outgrow a task, and keep it with the run. It never follows the cluster's size.

    Factor lineage is checkpointed every few iterations to the shared folder, so a lost
    executor costs a few iterations, not the whole fit."""
    return ALS(userCol="user_index", itemCol="item_index", ratingCol="rating",
               implicitPrefs=True, rank=rank, regParam=reg, alpha=alpha, maxIter=max_iter,
               coldStartStrategy="drop", seed=seed, checkpointInterval=checkpoint_interval,
               nonnegative=False, numUserBlocks=num_blocks, numItemBlocks=num_blocks)


def fit_als(indexed: DataFrame, **als_params) -> ALSModel:
    """Fit implicit ALS on (user_index, item_index, rating)."""
    checkpoint_root(indexed.sparkSession)
    return make_als(**als_params).fit(indexed.select("user_index", "item_index", "rating"))


def _length(features: str = "features") -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _item_blocks(item_factors: DataFrame, room: int) -> tuple[DataFrame, int, int | None]:
    """(items with block and slot, number of blocks, the last id where slots are ids).

    Items that fit one block keep their ids as slots. A larger catalogue is numbered by
    falling length and written once, a folder for each block."""
    spark = item_factors.sparkSession
    last = item_factors.agg(F.max("id")).first()[0]
    items = item_factors.select("id", "features")
    if last is None or last < room:
        return items.withColumn("slot", F.col("id")).withColumn("block", F.lit(0)), int(last is not None), -1 if last is None else last
    numbered, sizes = number_rows(items.withColumn("_length", _length()), [F.col("_length").desc(), F.col("id").asc()], "_place")
    path = scratch_path(spark, "item-blocks")
    (numbered.select("id", "features", (F.col("_place") % room).alias("slot"), F.floor(F.col("_place") / room).cast("int").alias("block"))
     .write.partitionBy("block").parquet(path))
    return (spark.read.schema("id int, features array<float>, slot int, block int").parquet(path),
            -(-sizes.get(0, 0) // room), None)


def seen_bitmaps(seen: DataFrame, items: DataFrame, blocks: int, last_id: int | None) -> DataFrame:
    """(id, block, mask): for each user and block of items one bitmap of the slots that the
    user has seen, from one pass over ``seen`` (user_index, item_index). Repeated pairs and
    items without factors do no harm. A bitmap ends with its last marked byte. Several
    blocks are written, a folder for each."""
    pairs = seen.select(F.col("user_index").alias("id"), F.col("item_index"))
    if last_id is not None:
        placed = pairs.filter(F.col("item_index") <= last_id).select("id", F.lit(0).alias("block"), F.col("item_index").alias("slot"))
    else:
        slots = items.select(F.col("id").alias("item_index"), "slot", "block")
        placed = pairs.join(broadcast_if_small(slots), "item_index")
    masks = placed.groupBy("id", "block").agg(F.bitmap_construct_agg(F.col("slot").cast("long")).alias("bits"), F.max("slot").alias("top"))
    masks = masks.select("id", "block", F.expr("substring(bits, 1, cast(shiftright(top, 3) as int) + 1)").alias("mask"))
    if blocks == 1:
        return masks
    path = scratch_path(seen.sparkSession, "seen")
    masks.write.partitionBy("block").parquet(path)
    return seen.sparkSession.read.schema("id int, mask binary, block int").parquet(path)


def score_top_n(user_factors: DataFrame, item_factors: DataFrame, n: int, seen: DataFrame | None = None,
                block_bytes: int = ITEM_BLOCK_BYTES, scored: list[int] | None = None) -> DataFrame:
    """Exact top-n items per user from factor tables (id, features): score descending,
    ties to the smaller item id, at any catalogue size.

    Items go in blocks of ``block_bytes``, the longest factors first. A pass broadcasts one
    block, and each task scores its users against it and merges the result into each user's
    running n best; no (user, item) table exists. A task looks only at the leaves of close
    items that can reach a user's n-th score, and has at most about ``PAIRS_A_TASK`` pairs.
    A score is at most the product of both lengths, so a user whose n-th score is above the product with the next block's longest
    item is finished: no later block can change its list. Only the others go on, and the
    passes end with them. ``scored`` receives the number of users of each pass.

    ``seen`` (user_index, item_index) is read once, into a bitmap for each user and block.
    Between passes the lists of those who go on are checkpointed."""
    spark = user_factors.sparkSession
    checkpoint_root(spark)
    rank, n_items = item_factors.agg(F.max(F.size("features")), F.count(F.lit(1))).first()
    room = max(1, block_bytes // (4 * (rank or 1)))
    if seen is not None:
        room = min(room, BITMAP_BITS)
    items, blocks, last_id = _item_blocks(item_factors, room)
    masks = None if seen is None else seen_bitmaps(seen, items, blocks, last_id)
    rows = user_factors.select("id", "features", _length().alias("norm"), F.lit(None).cast("array<int>").alias("items"),
                               F.lit(None).cast("array<float>").alias("scores"), F.lit(float("-inf")).alias("nth"))
    tasks = -(-user_factors.count() * min(room, n_items) // PAIRS_A_TASK)
    if tasks > 1:
        rows = rows.repartition(int(tasks), "id")
    finished = []
    for block in range(blocks):
        part = items.filter(F.col("block") == block).select("id", "slot", "features")
        held = item_block(part.toArrow())
        if block:
            # Both lengths and the product are rounded: a margin far above that.
            reach = F.col("norm") * float(held.lengths.max()) * (1 + 1e-6)
            finished.append(rows.filter(reach < F.col("nth")))
            rows = rows.filter(reach >= F.col("nth"))
        if block or scored is not None:
            users = rows.count()
            if not users:
                break
            if scored is not None:
                scored.append(users)
        masked = rows.withColumn("mask", F.lit(None).cast("binary")) if masks is None else rows.join(
            masks.filter(F.col("block") == block).select("id", "mask"), "id", "left")
        shared = spark.sparkContext.broadcast(tuple(vars(held).values()))
        rows = _scored(masked, shared, n)
        if block + 1 < blocks:
            rows = rows.checkpoint()
            shared.unpersist()
    for other in finished:
        rows = rows.unionByName(other)
    return rows.select("id", F.posexplode(F.arrays_zip("items", "scores")).alias("place", "best")).select(
        F.col("id").alias("user_index"), F.col("best.items").alias("item_index"),
        F.col("best.scores").cast("double").alias("score"), (F.col("place") + 1).alias("rank"))


def _scored(rows: DataFrame, shared, n: int) -> DataFrame:
    """``rows`` (id, features, norm, items, scores, mask) with the lists merged with one block of items."""
    def run(batches):
        return score_batches(batches, ItemBlock(*shared.value), n)
    return rows.select("id", "features", "norm", "items", "scores", "mask").mapInArrow(
        run, "id int, features array<float>, norm double, items array<int>, scores array<float>, nth double")


def recommend_top_n(model: ALSModel, n: int = TOP_K, users: DataFrame | None = None,
                    seen: DataFrame | None = None, block_bytes: int = ITEM_BLOCK_BYTES,
                    scored: list[int] | None = None) -> DataFrame:
    """M6 + P7 + P8: top-n items per user as rows (user_index, item_index, score, rank).

    ``users`` (a column ``user_index``) restricts the users scored; ``seen`` (user_index,
    item_index) excludes those pairs exactly, and a user with fewer than n unseen items
    gets fewer rows."""
    user_factors = model.userFactors
    if users is not None:
        user_factors = user_factors.join(users.select(F.col("user_index").alias("id")), "id", "left_semi")
    return score_top_n(user_factors, model.itemFactors, n, seen, block_bytes, scored)
