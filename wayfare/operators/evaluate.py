"""Leave-one-out evaluation (M7-M12, F13) with a pluggable scorer.

Split rule (W1/F4/J4): per user, the interaction with the largest seeded key
(``md5('seed|user|item')``, ties to the smaller item) is the test item, the rest is
train; a user is evaluated only if train still has one of their items.

The split is computed as a grouped ``max`` rather than a per-user window sort:
partial aggregation keeps a user holding a third of all rows from landing in a
single task, and train is a left-anti join on the full (user, item) key, which
spreads such a user over all shuffle partitions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.scalar import holdout_key
from wayfare.operators.indexing import number_rows
from wayfare.operators.joins import broadcast_if_small
from wayfare.operators.recommend import fit_als, recommend_top_n
from wayfare.operators.topk import global_top_k, top_k_per_group
from wayfare.schemas import CANDIDATES, MIN_EVAL_ROWS, SPLIT_SEED, TOP_K

# scorer(train, users, n) -> (user_index, item_index, score), at most n rows per user.
Scorer = Callable[[DataFrame, DataFrame, int], DataFrame]


@dataclass
class Holdout:
    test: DataFrame   # (user_index, true_item): users with >= 2 items only
    train: DataFrame  # indexed rows minus each user's test item


def holdout_pick(indexed: DataFrame, seed: int = SPLIT_SEED) -> DataFrame:
    """The test item of every user and the user's item count, in one grouped pass."""
    key = F.struct(holdout_key("user_index", "item_index", seed).alias("k"),
                   (-F.col("item_index")).alias("neg_item"))
    return (indexed.groupBy("user_index").agg(F.max(key).alias("_m"), F.count(F.lit(1)).alias("n_items"))
            .select("user_index", (-F.col("_m.neg_item")).alias("true_item"), "n_items"))


def holdout_split(indexed: DataFrame, seed: int = SPLIT_SEED) -> Holdout:
    """Train = indexed minus each user's test item (anti-join on the full key).
    Test = users whose train part is not empty. As (user, item) is unique in
    ``indexed``, that is the users with at least two items, so the original
    "join with distinct train users" becomes a filter on the count taken with the
    pick: no extra shuffle."""
    pick = holdout_pick(indexed, seed)
    train = indexed.join(pick.select("user_index", F.col("true_item").alias("item_index")),
                         ["user_index", "item_index"], "left_anti")
    test = pick.filter(F.col("n_items") >= 2).select("user_index", "true_item")
    return Holdout(test=test, train=train)


def item_popularity(train: DataFrame) -> DataFrame:
    """A2: summed rating per item.

    Float ratings of 0.25 or more are whole multiples of 2**-26, so they are summed as
    integers: exact at any total, whatever the order of summation."""
    units = (F.col("rating").cast("double") * F.lit(float(1 << 26))).cast("long").cast("decimal(20,0)")
    return train.groupBy("item_index").agg((F.sum(units).cast("double") / F.lit(float(1 << 26))).alias("pop"))


def popularity_ranks(train: DataFrame, num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Global popularity rank (1-based, pop desc, ties to the smaller item) of every
    train item, numbered without a single-partition window; plus the item count."""
    numbered, sizes = number_rows(item_popularity(train), [F.col("pop").desc(), F.col("item_index").asc()],
                                  "_r0", num_partitions)
    return numbered.select("item_index", "pop", (F.col("_r0") + 1).alias("pop_rank")), sizes.get(0, 0)


def fair_popularity_ranks(test: DataFrame, train: DataFrame, k: int = TOP_K) -> DataFrame:
    """Fair baseline: each user's list is the global popularity order without the
    items that user already has in train. Returns (user_index, true_item, fair_rank),
    fair_rank null when the true item is not among the user's first k.

    No per-user lists are built. The held-out item is never in the user's train set,
    so its position in the user's list is its global rank minus the number of the
    user's own train items ranked above it: one join of train with the rank table
    (broadcast when the catalogue is small) and a grouped count."""
    ranks, n_items = popularity_ranks(train)
    r = broadcast_if_small(ranks.select("item_index", "pop_rank"), known_rows=n_items)
    t = test.join(r.select(F.col("item_index").alias("true_item"), F.col("pop_rank").alias("r_t")),
                  "true_item", "left")
    # The rank table is joined last, as a bare relation: placing it inside both join
    # sides makes some analyzer configurations fail to tell the two copies apart.
    ahead = (train.select("user_index", "item_index")
             .join(t.filter(F.col("r_t").isNotNull()).select("user_index", "r_t"), "user_index")
             .join(r, "item_index")
             .filter(F.col("pop_rank") < F.col("r_t"))
             .groupBy("user_index").agg(F.count(F.lit(1)).alias("_ahead")))
    fair = F.col("r_t") - F.coalesce(F.col("_ahead"), F.lit(0))
    return t.join(ahead, "user_index", "left").select(
        "user_index", "true_item", F.when(fair <= k, fair.cast("int")).alias("fair_rank"))


def fair_popularity_metrics(test: DataFrame, train: DataFrame, k: int = TOP_K) -> DataFrame:
    """HitRate@k and MRR@k of the fair (seen-removed) popularity baseline."""
    joined = fair_popularity_ranks(test, train, k)
    return joined.agg(F.count(F.lit(1)).alias("users_evaluated"), *_metrics(joined, "fair_rank", "fair_baseline", k))


def popular_top_k(train: DataFrame, k: int) -> DataFrame:
    """T1 + W3: the k most popular items (ties to the smaller item), ranked 1..k."""
    return global_top_k(item_popularity(train), [F.col("pop").desc(), F.col("item_index").asc()], k)


def popularity_scorer(train: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """Deterministic scorer: the n most popular train items, identical for every user.

    The n items (a bounded list) are attached to each user by a generator, one
    output row per (user, item): no join at all."""
    top = popular_top_k(train, n).select("item_index", "pop").collect()
    if not top:
        return users.select("user_index", F.lit(None).cast("int").alias("item_index"),
                            F.lit(None).cast("double").alias("score")).limit(0)
    items = F.array(*[F.struct(F.lit(int(r["item_index"])).alias("item_index"),
                                F.lit(float(r["pop"])).alias("score")) for r in top])
    return users.select("user_index", F.inline(items))


def als_scorer(**als_params) -> Scorer:
    """ALS fitted on train; top-n per requested user."""
    def score(train: DataFrame, users: DataFrame, n: int) -> DataFrame:
        return recommend_top_n(fit_als(train, **als_params), n, users=users).select(
            "user_index", "item_index", "score")
    return score


def unseen_candidates(cands: DataFrame, train: DataFrame) -> DataFrame:
    """Drop candidates the user already has in train ((user, item) is unique there)."""
    return cands.join(train.select("user_index", "item_index"), ["user_index", "item_index"], "left_anti")


def top_k_unseen(cands: DataFrame, train: DataFrame, k: int = TOP_K) -> DataFrame:
    """M8 re-rank: best k unseen candidates per user by score (ties to the smaller item)."""
    ranked = top_k_per_group(unseen_candidates(cands, train), ["user_index"],
                             [F.col("score").desc(), F.col("item_index").asc()], k)
    return ranked.select("user_index", "item_index", "rank")


def _rr_units(k: int) -> int:
    return math.lcm(*range(1, k + 1))


def _metrics(joined: DataFrame, rank_col: str, prefix: str, k: int) -> list:
    """Hit rate and MRR from exact integer sums, divided once in double."""
    units = _rr_units(k)
    n = F.count(F.lit(1)).cast("double")
    hits = F.sum(F.when(F.col(rank_col).isNotNull(), 1).otherwise(0)).cast("double")
    rr = F.sum(F.when(F.col(rank_col).isNotNull(), F.lit(units).cast("decimal(38,0)") / F.col(rank_col))
               .otherwise(F.lit(0)).cast("decimal(38,0)")).cast("double")
    return [(hits / n).alias(f"{prefix}_hit_rate"),
            (rr / (n * F.lit(float(units)))).alias(f"{prefix}_mrr")]


def hit_metrics(test: DataFrame, topk: DataFrame, k: int = TOP_K, prefix: str = "model") -> DataFrame:
    """HitRate@k and MRR@k of per-user top-k lists against the held-out items."""
    joined = test.join(topk.select("user_index", F.col("item_index").alias("true_item"), "rank"),
                       ["user_index", "true_item"], "left")
    return joined.agg(F.count(F.lit(1)).alias("users_evaluated"), *_metrics(joined, "rank", prefix, k))


def popularity_metrics(test: DataFrame, train: DataFrame, k: int = TOP_K) -> DataFrame:
    """Every user gets the same top-k popular list (seen items kept).

    Each test user has exactly one true item, so matching it against the k-row list
    by item equals matching against the per-user copies, without building them."""
    top = F.broadcast(popular_top_k(train, k).select(F.col("item_index").alias("true_item"),
                                                     F.col("rank").alias("pop_rank")))
    joined = test.join(top, "true_item", "left")
    return joined.agg(F.count(F.lit(1)).alias("users_evaluated"), *_metrics(joined, "pop_rank", "baseline", k))


def _report_schema(fair_baseline: bool) -> str:
    kinds = ["model", "baseline"] + (["fair_baseline"] if fair_baseline else [])
    metrics = ", ".join(f"{kind}_hit_rate double, {kind}_mrr double" for kind in kinds)
    return (f"users_evaluated long, {metrics}, model_beats_baseline boolean"
            + (", model_beats_fair_baseline boolean" if fair_baseline else ""))


def evaluation_report(indexed: DataFrame, scorer: Scorer = popularity_scorer, k: int = TOP_K,
                      candidates: int = CANDIDATES, seed: int = SPLIT_SEED,
                      min_rows: int = MIN_EVAL_ROWS, fair_baseline: bool = False,
                      hold: list[DataFrame] | None = None) -> DataFrame:
    """M12 + F13: one row (users, model and baseline metrics, verdict), or no row when
    there are fewer than ``min_rows`` interactions or no eligible user.

    The baseline keeps seen items, as the original evaluation does, while the model's
    seen items are removed. ``fair_baseline=True`` adds the seen-removed baseline
    (``fair_baseline_hit_rate``, ``fair_baseline_mrr``) for a like-for-like verdict.

    The guards come first: where they hold, nothing is fitted or scored. ``indexed`` and
    the split are persisted for the lazy report; ``hold`` receives them, for the caller to
    unpersist when the report has been used."""
    if indexed.storageLevel == StorageLevel.NONE:
        indexed = indexed.persist(StorageLevel.MEMORY_AND_DISK)
        if hold is not None:
            hold.append(indexed)
    split = holdout_split(indexed, seed)
    # train feeds popularity, the scorer, the seen-filter and the eligibility check;
    # test feeds the scorer and the metrics. Both are deterministic functions of
    # ``indexed``, so a lost cached block recomputes to the same rows.
    split = Holdout(test=split.test.persist(StorageLevel.MEMORY_AND_DISK),
                    train=split.train.persist(StorageLevel.MEMORY_AND_DISK))
    if hold is not None:
        hold += [split.test, split.train]
    if indexed.count() < min_rows or split.test.isEmpty():
        return indexed.sparkSession.createDataFrame([], _report_schema(fair_baseline))
    cands = scorer(split.train, split.test.select("user_index"), candidates)
    topk = top_k_unseen(cands, split.train, k)
    pop = F.broadcast(popular_top_k(split.train, k).select(F.col("item_index").alias("true_item"),
                                                           F.col("rank").alias("pop_rank")))
    joined = (split.test
              .join(topk.select("user_index", F.col("item_index").alias("true_item"), "rank"),
                    ["user_index", "true_item"], "left")
              .join(pop, "true_item", "left"))
    extra = []
    if fair_baseline:
        joined = joined.join(fair_popularity_ranks(split.test, split.train, k).drop("true_item"),
                             "user_index", "left")
        extra = _metrics(joined, "fair_rank", "fair_baseline", k)
    report = joined.agg(F.count(F.lit(1)).alias("users_evaluated"),
                        *_metrics(joined, "rank", "model", k),
                        *_metrics(joined, "pop_rank", "baseline", k), *extra)
    report = report.withColumn("model_beats_baseline", F.col("model_hit_rate") > F.col("baseline_hit_rate"))
    if fair_baseline:
        report = report.withColumn("model_beats_fair_baseline",
                                   F.col("model_hit_rate") > F.col("fair_baseline_hit_rate"))
    return report
