"""Composed plans: the batch recommendation job and its deterministic stand-in."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.enrich import attach_lookup, enrich_recommendations
from wayfare.operators.evaluate import als_scorer, evaluation_report
from wayfare.operators.indexing import IndexedInteractions, index_interactions
from wayfare.operators.interactions import interaction_strength
from wayfare.operators.recommend import ITEM_BLOCK_BYTES, fit_als, recommend_top_n
from wayfare.operators.topk import top_k_per_group
from wayfare.schemas import LOOKBACK_DAYS, SERVING_ZONE, TOP_K
from wayfare.sinks import publish_recommendations


@dataclass
class RecommendationRun:
    recommendations: DataFrame
    index: IndexedInteractions
    evaluation: DataFrame | None = None
    held: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        """Drop what the run persisted; call it when its frames have been used."""
        self.index.release()
        for frame in self.held:
            frame.unpersist()


def run_recommendation_job(events: DataFrame, lookup: DataFrame, as_of=None,
                           lookback_days: int = LOOKBACK_DAYS, k: int = TOP_K,
                           generated_at=None, zone: str = SERVING_ZONE, evaluate: bool = False,
                           target: str | None = None, target_fmt: str = "parquet",
                           target_mode: str = "replace", target_options: dict[str, str] | None = None,
                           num_writers: int | None = None, num_partitions: int | None = None,
                           exclude_seen: bool = False, block_bytes: int = ITEM_BLOCK_BYTES,
                           fit=fit_als, buckets: int | None = None, **als_params) -> RecommendationRun:
    """E3 -> E4 -> E5 -> E6 (-> E7): the daily batch job.

    ``indexed`` feeds the fit, the two maps and the optional evaluation, so it is
    persisted (memory and disk) once; its inputs are checkpointed index tables, so a
    lost block recomputes to the same rows. Errors propagate to the caller.

    The run's instant is taken once, on the driver, so every row and every later action
    carries the same one. With a Parquet target the rows returned are the published ones.
    ``target_options`` (JDBC url, user, driver and so on) and ``num_writers`` go to the
    sink; ``block_bytes`` sizes the blocks of items that are scored at a time; ``buckets`` asks for the sink's serving layout; ``fit`` is
    MLlib's ALS or, for data with a hot airport, ``fit_partial_als``; other keywords go to it.

    ``exclude_seen=False`` keeps airports the passenger already has, as the original
    job does; ``True`` recommends only unseen ones (exactly k where enough remain)."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    as_of = now if as_of is None else as_of
    generated_at = now if generated_at is None else generated_at
    inter = interaction_strength(events, as_of, lookback_days)
    idx = index_interactions(inter, num_partitions)
    idx.indexed.persist(StorageLevel.MEMORY_AND_DISK)
    evaluation, held = None, []
    if evaluate:
        evaluation = evaluation_report(idx.indexed, scorer=als_scorer(**als_params), k=k, hold=held)
    model = fit(idx.indexed, **als_params)
    seen = idx.indexed.select("user_index", "item_index") if exclude_seen else None
    recs = recommend_top_n(model, k, seen=seen, block_bytes=block_bytes).select("user_index", "item_index", "score")
    out = enrich_recommendations(recs, idx.user_map, idx.item_map, lookup, generated_at=generated_at,
                                 zone=zone, item_rows=idx.item_index.size)
    if target:
        published = publish_recommendations(out, target, fmt=target_fmt, mode=target_mode,
                                            num_writers=num_writers, buckets=buckets, **(target_options or {}))
        out = out if published is None else published
    return RecommendationRun(recommendations=out, index=idx, evaluation=evaluation, held=held)


def stand_in_recommendations(events: DataFrame, lookup: DataFrame, as_of, generated_at,
                             lookback_days: int = LOOKBACK_DAYS, k: int = TOP_K,
                             zone: str = SERVING_ZONE) -> DataFrame:
    """Recommendations with a deterministic scorer: each passenger's own k strongest
    airports, score = strength. Same output schema as the ALS job, so serving and
    publishing can be checked against SQL; no index or model is needed."""
    inter = interaction_strength(events, as_of, lookback_days)
    top = top_k_per_group(inter, ["passengerId"],
                          [F.col("strength").desc(), F.col("arrivalAirport").asc()], k)
    return attach_lookup(top.withColumnRenamed("strength", "score"), lookup,
                         generated_at=generated_at, zone=zone)
