"""

Every query reads the given test tables in full (see ``wayfare.sources.fixtures`` for
how they play the event log, the airport lookup and the raw dataset). Parameters are
fixed here so that the Spark plan and its DuckDB twin compute the same thing:

- as-of instant 2024-01-31 00:00 UTC, lookback 14 days (the data spans January 2024);
- a second, earlier run (as-of 2024-01-20, lookback 14 days) and a later one-day run
  build a two-run recommendation history for the serving queries;
- evaluation: seed 42, top-5, 50 candidates.

Queries whose results depend on ALS have no SQL twin (rows-only check).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wayfare
from wayfare.functions.scalar import (
    days_since_epoch,
    epoch_millis_of,
    iso_text_to_utc,
    millis_to_utc,
    status_weight,
)
from wayfare.operators.enrich import enrich_recommendations
from wayfare.operators.evaluate import (
    evaluation_report,
    fair_popularity_metrics,
    hit_metrics,
    holdout_split,
    popular_top_k,
    popularity_metrics,
    popularity_scorer,
    top_k_unseen,
    unseen_candidates,
    als_scorer,
)
from wayfare.operators.indexing import build_label_index, index_interactions
from wayfare.operators.interactions import interaction_strength, recent_events
from wayfare.operators.normalize import clock_from, normalize_events
from wayfare.operators.partial_als import fit_partial_als, implicit_objective
from wayfare.operators.recommend import fit_als
from wayfare.operators.rollup import interaction_strength_from_daily, refresh_daily_strengths, scan_daily_strengths
from wayfare.operators.serving import latest_recommendations, recommendations_on
from wayfare.operators.topk import top_k_per_group
from wayfare.plans.job import run_recommendation_job, stand_in_recommendations
from wayfare.session import checkpoint_root, scratch_path
from wayfare.sinks import (
    append_events,
    compact_events,
    encode_events,
    ensure_event_table,
    publish_events,
    publish_recommendations,
    vacuum_events,
    with_event_day,
)
from wayfare.schemas import ALS_RANK, EVENT_FIELDS, OTHER_STATUS_WEIGHT, RAW_CSV_HEADERS, STATUS_WEIGHTS
from wayfare.sources.fixtures import (
    EVENT_TYPE_STATUS,
    ORDER_STATUS_STATUS,
    events_from_event_log,
    events_from_orders,
    load_table,
    lookup_from_nation,
    raw_rows_from_event_log,
)
from wayfare.sources.readers import (
    event_batches,
    scan_events,
    scan_lookup,
    scan_raw_csv,
    scan_recommendations,
    stream_payloads,
)
from wayfare.streaming.ingest import ingest_stream

try:  # the training-data operators are a separate, optional subpackage
    import corpus_pipeline
    from wayfare.llm import queries as llm_queries
except ImportError as missing:
    # Only their absence is passed over, not a fault inside them.
    if missing.name != "corpus_pipeline" and os.path.exists(os.path.join(os.path.dirname(wayfare.__file__), "llm", "__init__.py")):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

AS_OF = "2024-01-31 00:00:00"
LOOKBACK = 14
RUN_AT = "2024-01-31 00:00:00"          # UTC instant of the later run
EARLY_AS_OF = "2024-01-20 00:00:00"
EARLY_RUN_AT = "2024-01-20 00:00:00"
LATE_LOOKBACK = 1                      # the later run only sees one day: some passengers miss it
SERVE_DAY = "2024-01-31"               # serving-zone calendar day of the later run
ORDERS_AS_OF = "2001-09-01 00:00:00"
ORDERS_LOOKBACK = 2600
PACKED_BEFORE = "2024-01-20"
ROLLUP_SPLIT = "2024-01-22 12:00:00"   # in the middle of a day, which the second refresh rewrites
K = 5
N_CAND = 50
SEED = 42


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

_HELD: list[DataFrame] = []


def _keep(*frames: DataFrame) -> DataFrame:
    """Persist ``frames`` until the next query starts; returns the first."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
        _HELD.append(frame)
    return frames[0]


def _session_defaults(spark: SparkSession) -> None:
    checkpoint_root(spark)
    # Queries return lazy frames over inputs that they persist (interactions, evaluation
    # split); the next query drops those of earlier ones, and nothing else the caller
    # has cached.
    while _HELD:
        _HELD.pop().unpersist()


def _events(spark, d):
    return events_from_event_log(load_table(spark, d, "events"))


def _lookup(spark, d):
    return lookup_from_nation(load_table(spark, d, "nation"), load_table(spark, d, "region"))


def _inter(spark, d):
    return interaction_strength(_events(spark, d), AS_OF, LOOKBACK)


def _indexed(spark, d):
    idx = index_interactions(_inter(spark, d))
    _HELD.append(idx.source)
    _keep(idx.indexed)
    return idx


def _split(spark, d):
    return holdout_split(_indexed(spark, d).indexed, SEED)


def _history(spark, d):
    ev, lk = _events(spark, d), _lookup(spark, d)
    early = stand_in_recommendations(ev, lk, EARLY_AS_OF, EARLY_RUN_AT, LOOKBACK, K)
    late = stand_in_recommendations(ev, lk, AS_OF, RUN_AT, LATE_LOOKBACK, K)
    return early.unionByName(late)


def _normalized(spark, d):
    raw = raw_rows_from_event_log(load_table(spark, d, "events"))
    return normalize_events(raw, clock=clock_from("_ingest_ts"))


def q_status_weight(spark, d):
    e = events_from_event_log(load_table(spark, d, "events"), keep=("event_id",))
    return e.select("event_id", "flightStatus", status_weight("flightStatus").cast("double").alias("weight"))


def q_lookback_filter(spark, d):
    e = events_from_event_log(load_table(spark, d, "events"), keep=("event_id",))
    return recent_events(e, AS_OF, LOOKBACK).select("event_id", "passengerId", "arrivalAirport",
                                                    "flightStatus", "timestamp")


def q_interaction_strength(spark, d):
    return _inter(spark, d)


def _orders_inter(spark, d):
    ev = events_from_orders(load_table(spark, d, "orders"), load_table(spark, d, "lineitem"))
    return interaction_strength(ev, ORDERS_AS_OF, ORDERS_LOOKBACK)


def q_interaction_strength_orders(spark, d):
    return _orders_inter(spark, d)


def q_indexed_interactions_orders(spark, d):
    """E4 on the order-line log: thousands of passengers with many frequency ties."""
    idx = index_interactions(_orders_inter(spark, d))
    _HELD.append(idx.source)
    return idx.indexed


def q_eval_report_orders(spark, d):
    return evaluation_report(_keep(q_indexed_interactions_orders(spark, d)), popularity_scorer, K, N_CAND, SEED,
                             hold=_HELD)


def q_user_index(spark, d):
    return build_label_index(_inter(spark, d), "passengerId", "user_index").table


def q_item_index(spark, d):
    return build_label_index(_inter(spark, d), "arrivalAirport", "item_index").table


def q_indexed_interactions(spark, d):
    return _indexed(spark, d).indexed


def q_distinct_user_map(spark, d):
    return _indexed(spark, d).user_map


def q_enriched_left_lookup(spark, d):
    idx = _indexed(spark, d)
    top = top_k_per_group(idx.indexed, ["user_index"], [F.col("rating").desc(), F.col("item_index").asc()], K)
    recs = top.select("user_index", "item_index", F.col("rating").cast("double").alias("score"))
    return enrich_recommendations(recs, idx.user_map, idx.item_map, _lookup(spark, d),
                                  generated_at=RUN_AT, item_rows=idx.item_index.size)


def q_holdout_test(spark, d):
    return _split(spark, d).test


def q_holdout_train(spark, d):
    return _split(spark, d).train


def q_eligible_test_users(spark, d):
    return _split(spark, d).test.select("user_index")


def q_unseen_candidates(spark, d):
    s = _split(spark, d)
    return unseen_candidates(popularity_scorer(s.train, s.test.select("user_index"), N_CAND), s.train)


def q_topk_per_user(spark, d):
    s = _split(spark, d)
    return top_k_unseen(popularity_scorer(s.train, s.test.select("user_index"), N_CAND), s.train, K)


def q_exploded_recs(spark, d):
    """Nested per-user lists (as the model emits them) flattened back to rows."""
    s = _split(spark, d)
    topk = top_k_unseen(popularity_scorer(s.train, s.test.select("user_index"), N_CAND), s.train, K)
    nested = topk.groupBy("user_index").agg(
        F.sort_array(F.collect_list(F.struct("rank", "item_index"))).alias("recommendations"))
    return nested.select("user_index", F.posexplode("recommendations").alias("pos", "rec")).select(
        "user_index", F.col("pos"), F.col("rec.item_index").alias("item_index"))


def q_popular_topk(spark, d):
    return popular_top_k(_split(spark, d).train, K)


def q_popularity_metrics(spark, d):
    s = _split(spark, d)
    return popularity_metrics(s.test, s.train, K)


def q_fair_popularity_metrics(spark, d):
    """Seen-removed popularity baseline (the like-for-like comparison for the model)."""
    s = _split(spark, d)
    return fair_popularity_metrics(s.test, s.train, K)


def q_model_metrics(spark, d):
    s = _split(spark, d)
    topk = top_k_unseen(popularity_scorer(s.train, s.test.select("user_index"), N_CAND), s.train, K)
    return hit_metrics(s.test, topk, K)


def q_eval_report(spark, d):
    return evaluation_report(_indexed(spark, d).indexed, popularity_scorer, K, N_CAND, SEED, hold=_HELD)


def q_stand_in_recommendations(spark, d):
    return stand_in_recommendations(_events(spark, d), _lookup(spark, d), AS_OF, RUN_AT, LOOKBACK, K)


def q_latest_recommendations(spark, d):
    return latest_recommendations(_history(spark, d))


def q_latest_for_passenger_list(spark, d):
    cust = load_table(spark, d, "customer")
    ids = cust.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").cast("string"))
    return latest_recommendations(_history(spark, d), passengers=ids)


def q_recommendations_on_day(spark, d):
    return recommendations_on(_history(spark, d), SERVE_DAY)


def q_parse_event_time(spark, d):
    ev = load_table(spark, d, "events")
    # ISO text built from the value's own string form (date_format would pass a
    # zone-less value through the session zone).
    base = F.regexp_replace(F.substring(F.col("ts").cast("string"), 1, 19), " ", "T")
    text = (F.when(F.col("event_type") == "purchase", F.concat(base, F.lit("Z")))
            .when(F.col("event_type") == "click", base)
            .when(F.col("event_type") == "error", F.concat(base, F.lit("+03:30")))
            .when(F.col("event_type") == "view", F.to_date("ts").cast("string"))
            .otherwise(F.lit("yesterday")))
    return ev.select("event_id", text.alias("ts_text")).select(
        "event_id", "ts_text", iso_text_to_utc("ts_text").alias("parsed"))


def q_millis_roundtrip(spark, d):
    ev = load_table(spark, d, "events")
    ms = epoch_millis_of("ts")
    return ev.select("event_id", ms.alias("millis")).select(
        "event_id", "millis", millis_to_utc("millis").alias("ts_utc"),
        F.to_date(millis_to_utc("millis")).alias("event_day"),
        days_since_epoch(millis_to_utc("millis")).alias("epoch_day"))


def q_lookup_csv(spark, d):
    """S2 + P4: the airport lookup written as a headerless CSV (id, name, city,
    country, code), read back by position."""
    path = scratch_path(spark, "airports")
    lk = _lookup(spark, d)
    (lk.select(F.col("iata_code").alias("id"), F.lit("x").alias("name"), "city", "country", "iata_code")
     .write.option("header", "false").csv(path))
    return scan_lookup(spark, path)


def q_raw_csv_normalized(spark, d):
    """S3 + E1: the raw dataset written as a CSV with header, read back by header name
    and normalised. The ingest clock is now, so the timestamp column is left out."""
    path = scratch_path(spark, "raw_csv")
    raw_rows_from_event_log(load_table(spark, d, "events")).drop("_ingest_ts") \
        .write.option("header", "true").csv(path)
    return normalize_events(scan_raw_csv(spark, path)).events.drop("timestamp")


def q_raw_csv_line_breaks(spark, d):
    """S3 + E1 with line breaks and quotes inside fields, read by byte ranges in parallel."""
    path = scratch_path(spark, "raw_csv_lines")
    said = F.concat(F.lit('over\ntwo lines, "'), F.col("`Passenger ID`"), F.lit('"\n'))
    (raw_rows_from_event_log(load_table(spark, d, "events")).drop("_ingest_ts").withColumn("Pilot Name", said)
     .write.option("header", "true").option("escape", '"').option("ignoreTrailingWhiteSpace", "false").csv(path))
    return normalize_events(scan_raw_csv(spark, path, multi_line=True, parallel=True)).events.drop("timestamp")


def q_normalized_events(spark, d):
    return _normalized(spark, d).events


def q_rejected_events(spark, d):
    return _normalized(spark, d).rejects


def q_events_by_day(spark, d):
    return (with_event_day(_events(spark, d)).groupBy("event_day")
            .agg(F.count(F.lit(1)).alias("n_events")))


def q_stream_ingest_readback(spark, d):
    """E1 -> K1 -> E2 -> S1: publish normalised events as payload files, ingest them
    with a streaming query (one file per micro-batch, drained by availableNow), read
    the day-partitioned table back."""
    base = scratch_path(spark, "stream")
    publish_events(_normalized(spark, d).events, "text", f"{base}/topic", num_files=4)
    payloads = stream_payloads(spark, "text", f"{base}/topic", max_per_trigger=1)
    qs = ingest_stream(payloads, f"{base}/lake", f"{base}/_checkpoints", f"{base}/quarantine")
    qs.await_all()
    return scan_events(spark, f"{base}/lake")


def q_stream_quarantine_readback(spark, d):
    """payloads made bad in one way by event type; the rest land in the table.
    Returns (outcome, passengerId, n): the reject reason or 'event', and row counts."""
    base = scratch_path(spark, "quarantine")
    payloads = encode_events(_normalized(spark, d).events)
    day = F.expr("CAST(get_json_object(value, '$.departureDate') AS DATE)")
    kind = F.pmod(F.unix_date(day), F.lit(8))
    bad = (F.when(kind == 0, F.regexp_replace("value", '"timestamp":-?[0-9]+', '"timestamp":9223372036854775807'))
           .when(kind == 1, F.concat(F.lit("not json "), "value"))
           .when(kind == 2, F.regexp_replace("value", '"pilotName":"[^"]*",', ""))
           .when(kind == 3, F.regexp_replace("value", '"firstName":"[^"]*"', '"firstName":5'))
           .when(kind == 4, F.regexp_replace("value", '"timestamp":-?[0-9]+', '"timestamp":"2024-01-01"'))
           .when(kind == 5, F.regexp_replace("value", '"firstName":"[^"]*"', '"firstName":5,"extra":{"firstName":"a"}'))
           .when(kind == 6, F.regexp_replace("value", '"firstName":"[^"]*"', '"firstName":5,"xfirstName":"a"'))
           .otherwise(F.col("value")))
    payloads.select(bad.alias("value")).repartition(3).write.text(f"{base}/topic")
    ingest_stream(stream_payloads(spark, "text", f"{base}/topic", max_per_trigger=1), f"{base}/lake",
                  f"{base}/_checkpoints", f"{base}/quarantine").await_all()
    rejects = spark.read.parquet(f"{base}/quarantine").select(
        F.col("reason").alias("outcome"), F.regexp_extract("value", '"passengerId":"([^"]*)"', 1).alias("passengerId"))
    events = scan_events(spark, f"{base}/lake").select(F.lit("event").alias("outcome"), "passengerId")
    return events.unionByName(rejects).groupBy("outcome", "passengerId").agg(F.count(F.lit(1)).alias("n"))


def q_table_scan_by_name(spark, d):
    """One event table, written by the batch path under its folder and under its
    name and by the stream, shows every row by name and by path."""
    base, name = scratch_path(spark, "table"), f"wayfare_events_{uuid.uuid4().hex}"
    events = _normalized(spark, d).events
    ensure_event_table(spark, name, f"{base}/lake")
    append_events(events, f"{base}/lake", files_per_day=2)
    append_events(events, name, table=True)
    publish_events(events, "text", f"{base}/topic", num_files=2)
    ingest_stream(stream_payloads(spark, "text", f"{base}/topic"), f"{base}/lake", f"{base}/_checkpoints").await_all()
    by_name, by_path = (scan_events(spark, source).groupBy("event_day").agg(F.count(F.lit(1)).alias(n))
                        for source, n in ((name, "by_name"), (f"{base}/lake", "by_path")))
    counted = by_name.join(by_path, "event_day", "full").checkpoint()
    spark.sql(f"DROP TABLE {name}")  # the folder stays, the catalog is left as it was
    return counted


def q_compacted_events_by_day(spark, d):
    """A table filled by name, by folder and by a stream; days before the 20th
    are packed, a late batch follows, and what was packed is removed. Per day: rows by name
    and by path, and batches in view."""
    base, name = scratch_path(spark, "packed"), f"wayfare_events_{uuid.uuid4().hex}"
    events = _normalized(spark, d).events
    ensure_event_table(spark, name, f"{base}/lake")
    append_events(events, name, table=True)
    append_events(events, f"{base}/lake", files_per_day=2)
    publish_events(events, "text", f"{base}/topic", num_files=2)
    ingest_stream(stream_payloads(spark, "text", f"{base}/topic"), name, f"{base}/_checkpoints", table=True).await_all()
    compact_events(spark, name, PACKED_BEFORE, table=True)
    append_events(events, f"{base}/lake")
    vacuum_events(spark, name, table=True)
    by_path = scan_events(spark, f"{base}/lake").groupBy("event_day").agg(F.count(F.lit(1)).alias("by_path"))
    by_name = event_batches(spark, name).groupBy("event_day").agg(
        F.sum("n_events").alias("by_name"), F.count(F.lit(1)).alias("n_batches"))
    counted = by_name.join(by_path, "event_day", "full").checkpoint()
    spark.sql(f"DROP TABLE {name}")
    return counted


def q_interaction_strength_rollup(spark, d):
    """E3 from daily partial strengths: the event log is appended in two halves of the month
    and the rollup brought up to date after each; only the cutoff's day is read raw."""
    base = scratch_path(spark, "rollup")
    known = _events(spark, d)
    events = known.select(*[F.col(f) if f in known.columns else F.lit(30 if f == "age" else "").alias(f) for f in EVENT_FIELDS])
    for half in (F.col("timestamp") < ROLLUP_SPLIT, F.col("timestamp") >= ROLLUP_SPLIT):
        append_events(events.filter(half), f"{base}/lake")
        refresh_daily_strengths(spark, f"{base}/lake", f"{base}/daily")
    return interaction_strength_from_daily(scan_events(spark, f"{base}/lake"),
                                           scan_daily_strengths(spark, f"{base}/daily"), AS_OF, LOOKBACK)


def q_batch_append_readback(spark, d):
    """K2/K3 batch path: append normalised events into day partitions, read back."""
    base = scratch_path(spark, "lake")
    append_events(_normalized(spark, d).events, f"{base}/lake", files_per_day=2)
    return scan_events(spark, f"{base}/lake")


def q_lake_interactions(spark, d):
    """E3 on the day-partitioned table: the lookback prunes whole day partitions."""
    base = scratch_path(spark, "lake")
    append_events(_normalized(spark, d).events, f"{base}/lake")
    return interaction_strength(scan_events(spark, f"{base}/lake"), AS_OF, LOOKBACK)


def q_publish_readback(spark, d):
    """K4/S5 on a Parquet target: replace, then read back."""
    target = scratch_path(spark, "recommendations")
    publish_recommendations(_history(spark, d), target, fmt="parquet", mode="replace")
    return scan_recommendations(spark, target)


def _served(spark, d):
    """The history published as two appending runs with the serving layout."""
    target = scratch_path(spark, "served")
    ev, lk = _events(spark, d), _lookup(spark, d)
    for as_of, run_at, days in ((EARLY_AS_OF, EARLY_RUN_AT, LOOKBACK), (AS_OF, RUN_AT, LATE_LOOKBACK)):
        publish_recommendations(stand_in_recommendations(ev, lk, as_of, run_at, days, K), target, mode="append", buckets=16)
    return target


def q_served_passenger_list(spark, d):
    """E9 for a list of passengers on published runs: only their buckets are read."""
    cust = load_table(spark, d, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD").select("c_custkey")
    return latest_recommendations(scan_recommendations(spark, _served(spark, d), passengers=cust))


def q_served_day(spark, d):
    """E10 on published runs: only the day's folders are read."""
    return recommendations_on(scan_recommendations(spark, _served(spark, d), day=SERVE_DAY), SERVE_DAY)


def q_als_recommendations(spark, d):
    return _run(spark, d, lookback_days=LOOKBACK)


def q_als_recommendations_full(spark, d):
    """The daily job with the original 90-day lookback: every event of the table."""
    return _run(spark, d, lookback_days=90)


def q_als_recommendations_orders(spark, d):
    """The daily job on the larger order-line event log (customers x suppliers)."""
    ev = events_from_orders(load_table(spark, d, "orders"), load_table(spark, d, "lineitem"))
    run = run_recommendation_job(ev, _lookup(spark, d), as_of=ORDERS_AS_OF,
                                 lookback_days=ORDERS_LOOKBACK, generated_at=RUN_AT)
    _HELD.extend([run.index.source, run.index.indexed])
    return run.recommendations


def q_als_recommendations_unseen(spark, d):
    """The daily job with already-visited airports excluded (exactly k where possible)."""
    return _run(spark, d, lookback_days=LOOKBACK, exclude_seen=True)


def _recommendation_counts(recs, inter):
    known = inter.select(F.col("arrivalAirport").alias("arrival_airport_code"), F.lit(1).alias("_known")).distinct()
    return (recs.join(known, "arrival_airport_code", "left").groupBy("passenger_id")
            .agg(F.count(F.lit(1)).alias("n_recs"), F.countDistinct("arrival_airport_code").alias("n_airports"),
                 F.count("_known").alias("n_known")))


def q_als_recommendation_counts(spark, d):
    """M6: every passenger gets min(K, airports) distinct airports of the catalogue."""
    return _recommendation_counts(q_als_recommendations(spark, d), _inter(spark, d))


def q_als_recommendation_counts_orders(spark, d):
    return _recommendation_counts(q_als_recommendations_orders(spark, d), _orders_inter(spark, d))


def _unseen_overlap(recs, inter):
    seen = inter.select(F.col("passengerId").alias("passenger_id"),
                        F.col("arrivalAirport").alias("arrival_airport_code"), F.lit(1).alias("_seen"))
    return (recs.join(seen, ["passenger_id", "arrival_airport_code"], "left")
            .groupBy("passenger_id").agg(F.count(F.lit(1)).alias("n_recs"), F.count("_seen").alias("n_seen")))


def q_als_unseen_overlap(spark, d):
    """M8 on the job: no recommended airport is in the passenger's history, and each
    passenger gets min(K, airports never visited)."""
    return _unseen_overlap(q_als_recommendations_unseen(spark, d), _inter(spark, d))


def q_als_unseen_overlap_blocks(spark, d):
    """The same with the catalogue in blocks of ten airports: histories as one bitmap for
    each passenger and block, blocks in falling length, passengers leaving when finished."""
    return _unseen_overlap(_run(spark, d, lookback_days=LOOKBACK, exclude_seen=True, block_bytes=4 * ALS_RANK * 10),
                           _inter(spark, d))


def q_als_eval(spark, d):
    return evaluation_report(_indexed(spark, d).indexed, als_scorer(), K, N_CAND, SEED, hold=_HELD)


def q_als_partial_fit(spark, d):
    """M5 by partial normal equations: every passenger and airport gets factors, the
    objective falls from the first iteration to the last, and ends at most 2 % above that of
    MLlib's fit."""
    indexed = _indexed(spark, d).indexed
    model = fit_partial_als(indexed)
    first, last, other = (implicit_objective(indexed, m) for m in (fit_partial_als(indexed, max_iter=1), model, fit_als(indexed)))
    ids = (model.userFactors.select(F.col("id").alias("u"), F.lit(None).cast("int").alias("i"))
           .unionByName(model.itemFactors.select(F.lit(None).cast("int").alias("u"), F.col("id").alias("i"))))
    return ids.agg(F.count_distinct("u").alias("n_users"), F.count_distinct("i").alias("n_items")).select(
        "n_users", "n_items", F.lit(last < first).alias("falls"), F.lit(last < 1.02 * other).alias("near_mllib"))


def _run(spark, d, **options):
    """The daily job's recommendations; what it persisted goes when the next query starts."""
    run = run_recommendation_job(_events(spark, d), _lookup(spark, d), as_of=AS_OF, generated_at=RUN_AT, **options)
    _HELD.extend([run.index.source, run.index.indexed, *run.held])
    return run.recommendations


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "status_weight": q_status_weight,
    "lookback_filter": q_lookback_filter,
    "interaction_strength": q_interaction_strength,
    "interaction_strength_orders": q_interaction_strength_orders,
    "user_index": q_user_index,
    "item_index": q_item_index,
    "indexed_interactions": q_indexed_interactions,
    "indexed_interactions_orders": q_indexed_interactions_orders,
    "distinct_user_map": q_distinct_user_map,
    "enriched_left_lookup": q_enriched_left_lookup,
    "holdout_test": q_holdout_test,
    "holdout_train": q_holdout_train,
    "eligible_test_users": q_eligible_test_users,
    "unseen_candidates": q_unseen_candidates,
    "topk_per_user": q_topk_per_user,
    "exploded_recs": q_exploded_recs,
    "popular_topk": q_popular_topk,
    "popularity_metrics": q_popularity_metrics,
    "fair_popularity_metrics": q_fair_popularity_metrics,
    "model_metrics": q_model_metrics,
    "eval_report": q_eval_report,
    "eval_report_orders": q_eval_report_orders,
    "stand_in_recommendations": q_stand_in_recommendations,
    "latest_recommendations": q_latest_recommendations,
    "latest_for_passenger_list": q_latest_for_passenger_list,
    "recommendations_on_day": q_recommendations_on_day,
    "parse_event_time": q_parse_event_time,
    "millis_roundtrip": q_millis_roundtrip,
    "lookup_csv": q_lookup_csv,
    "raw_csv_normalized": q_raw_csv_normalized,
    "raw_csv_line_breaks": q_raw_csv_line_breaks,
    "normalized_events": q_normalized_events,
    "rejected_events": q_rejected_events,
    "events_by_day": q_events_by_day,
    "stream_ingest_readback": q_stream_ingest_readback,
    "batch_append_readback": q_batch_append_readback,
    "lake_interactions": q_lake_interactions,
    "publish_readback": q_publish_readback,
    "served_passenger_list": q_served_passenger_list,
    "served_day": q_served_day,
    "als_recommendations": q_als_recommendations,
    "als_recommendations_full": q_als_recommendations_full,
    "als_recommendations_orders": q_als_recommendations_orders,
    "als_recommendations_unseen": q_als_recommendations_unseen,
    "als_recommendation_counts": q_als_recommendation_counts,
    "als_recommendation_counts_orders": q_als_recommendation_counts_orders,
    "als_unseen_overlap": q_als_unseen_overlap,
    "als_unseen_overlap_blocks": q_als_unseen_overlap_blocks,
    "als_partial_fit": q_als_partial_fit,
    "stream_quarantine_readback": q_stream_quarantine_readback,
    "table_scan_by_name": q_table_scan_by_name,
    "compacted_events_by_day": q_compacted_events_by_day,
    "interaction_strength_rollup": q_interaction_strength_rollup,
    "als_eval": q_als_eval,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily recommendation job (events -> interactions -> index -> ALS
    top-5 -> enriched rows) on the smallest test tables."""
    _session_defaults(spark)
    return q_als_recommendations(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _session_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    extra = {} if llm_queries is None else llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: wrap(fn) for name, fn in (_QUERIES | extra).items()}


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

def _case(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


_STATUS = _case("event_type", {k: f"'{v}'" for k, v in EVENT_TYPE_STATUS.items()}, "event_type")
_ORDER_STATUS = _case("o_orderstatus", {k: f"'{v}'" for k, v in ORDER_STATUS_STATUS.items()}, "o_orderstatus")
_WEIGHT = _case("flightStatus", STATUS_WEIGHTS, OTHER_STATUS_WEIGHT)


def _ev_sql() -> str:
    return (f"SELECT event_id, CAST(user_id AS VARCHAR) AS passengerId, "
            f"json_extract_string(props, '$.k') AS arrivalAirport, {_STATUS} AS flightStatus, "
            f"ts AS \"timestamp\" FROM events")


def _cutoff(as_of: str, days: int) -> str:
    return f"(TIMESTAMP '{as_of}' - INTERVAL {days} DAY)"


def _inter_sql(as_of: str = AS_OF, days: int = LOOKBACK, ev: str | None = None) -> str:
    ev = ev or _ev_sql()
    return (f"SELECT passengerId, arrivalAirport, CAST(SUM(w) AS DOUBLE) AS strength FROM ("
            f"SELECT passengerId, arrivalAirport, {_WEIGHT} AS w FROM ({ev}) e "
            f"WHERE \"timestamp\" > {_cutoff(as_of, days)}) x "
            f"GROUP BY passengerId, arrivalAirport HAVING SUM(w) > 0")


def _lookup_sql() -> str:
    return ("SELECT n_name AS city, r_name AS country, CAST(n_nationkey AS VARCHAR) AS iata_code "
            "FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")


def _index_sql(label: str, index: str) -> str:
    return (f"SELECT {label}, CAST(row_number() OVER (ORDER BY freq DESC, {label} ASC) - 1 AS INTEGER) "
            f"AS {index}, freq FROM (SELECT {label}, COUNT(*) AS freq FROM inter "
            f"WHERE {label} IS NOT NULL GROUP BY {label}) f")


def _with_indexed(inter_sql: str | None = None) -> str:
    return (f"WITH inter AS ({inter_sql or _inter_sql()}), "
            f"uidx AS ({_index_sql('passengerId', 'user_index')}), "
            f"iidx AS ({_index_sql('arrivalAirport', 'item_index')}), "
            f"indexed AS (SELECT i.passengerId, i.arrivalAirport, u.user_index, t.item_index, "
            f"CAST(i.strength AS FLOAT) AS rating FROM inter i JOIN uidx u ON i.passengerId = u.passengerId "
            f"JOIN iidx t ON i.arrivalAirport = t.arrivalAirport)")


def _with_split(inter_sql: str | None = None) -> str:
    key = (f"md5(concat_ws('|', '{SEED}', CAST(user_index AS VARCHAR), CAST(item_index AS VARCHAR)))")
    return (_with_indexed(inter_sql) + ", "
            f"pick AS (SELECT user_index, item_index AS true_item FROM (SELECT user_index, item_index, "
            f"row_number() OVER (PARTITION BY user_index ORDER BY {key} DESC, item_index ASC) AS rn "
            f"FROM indexed) z WHERE rn = 1), "
            f"train AS (SELECT i.* FROM indexed i WHERE NOT EXISTS (SELECT 1 FROM pick p "
            f"WHERE p.user_index = i.user_index AND p.true_item = i.item_index)), "
            f"test AS (SELECT * FROM pick WHERE user_index IN (SELECT user_index FROM train)), "
            f"pop AS (SELECT item_index, SUM(CAST(rating AS DOUBLE)) AS pop FROM train GROUP BY item_index), "
            f"poptop AS (SELECT item_index, pop, CAST(row_number() OVER (ORDER BY pop DESC, item_index ASC) "
            f"AS INTEGER) AS rank FROM pop ORDER BY pop DESC, item_index ASC LIMIT {K}), "
            f"candtop AS (SELECT item_index, pop AS score FROM pop ORDER BY pop DESC, item_index ASC "
            f"LIMIT {N_CAND}), "
            f"cands AS (SELECT t.user_index, c.item_index, c.score FROM test t CROSS JOIN candtop c), "
            f"unseen AS (SELECT c.* FROM cands c WHERE NOT EXISTS (SELECT 1 FROM train s "
            f"WHERE s.user_index = c.user_index AND s.item_index = c.item_index)), "
            f"topk AS (SELECT user_index, item_index, rank FROM (SELECT user_index, item_index, "
            f"CAST(row_number() OVER (PARTITION BY user_index ORDER BY score DESC, item_index ASC) AS INTEGER) "
            f"AS rank FROM unseen) r WHERE rank <= {K})")


def _rr_units() -> int:
    import math
    return math.lcm(*range(1, K + 1))


def _metric_sql(rank: str, prefix: str) -> str:
    u = _rr_units()
    return (f"CAST(SUM(CASE WHEN {rank} IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) "
            f"AS {prefix}_hit_rate, "
            f"CAST(SUM(CASE WHEN {rank} IS NOT NULL THEN {u} // {rank} ELSE 0 END) AS DOUBLE) / "
            f"(CAST(COUNT(*) AS DOUBLE) * {float(u)}) AS {prefix}_mrr")


def _stand_in_sql(as_of: str, days: int, run_at: str) -> str:
    return (f"SELECT t.passengerId AS passenger_id, t.arrivalAirport AS arrival_airport_code, "
            f"l.city AS arrival_city, l.country AS arrival_country, t.strength AS score, "
            f"((TIMESTAMP '{run_at}' AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tehran') AS generated_at "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY passengerId ORDER BY strength DESC, "
            f"arrivalAirport ASC) AS rk FROM ({_inter_sql(as_of, days)}) i) t "
            f"LEFT JOIN ({_lookup_sql()}) l ON t.arrivalAirport = l.iata_code WHERE t.rk <= {K}")


def _history_sql() -> str:
    return (f"hist AS ({_stand_in_sql(EARLY_AS_OF, LOOKBACK, EARLY_RUN_AT)} UNION ALL "
            f"{_stand_in_sql(AS_OF, LATE_LOOKBACK, RUN_AT)})")


def _response_sql(rows: str) -> str:
    return (f"SELECT passenger_id AS passengerId, arrival_airport_code AS airportCode, arrival_city AS city, "
            f"arrival_country AS country, generated_at AS generatedAt, CAST(row_number() OVER ("
            f"PARTITION BY passenger_id ORDER BY score DESC, generated_at DESC, arrival_airport_code ASC) "
            f"AS INTEGER) AS position FROM ({rows}) s WHERE arrival_city IS NOT NULL")


def _raw_sql() -> str:
    uid = "CAST(user_id AS VARCHAR)"
    k = "json_extract_string(props, '$.k')"
    return (f"SELECT {uid} AS passengerId, 'first-' || {uid} AS firstName, 'last-' || {uid} AS lastName, "
            f"'' AS gender, CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) "
            f"ELSE CAST(CAST(FLOOR(value) AS BIGINT) AS VARCHAR) END AS age, '' AS nationality, "
            f"'airport-' || {k} AS airportName, '' AS airportCountryCode, '' AS countryName, "
            f"'' AS airportContinent, '' AS continents, CAST(CAST(ts AS DATE) AS VARCHAR) AS departureDate, "
            f"{k} AS arrivalAirport, '' AS pilotName, {_STATUS} AS flightStatus, "
            f"date_trunc('millisecond', ts) AS ingest_ts FROM events")


_FIELDS = EVENT_FIELDS[:-1]
_HEADERS = RAW_CSV_HEADERS


def _norm_with() -> str:
    nulls = " ".join(f"WHEN {f} IS NULL THEN 'null:{f}'" for f in _FIELDS)
    age_ok = "CASE WHEN regexp_full_match(age, '[+-]?[0-9]+') THEN TRY_CAST(age AS INTEGER) END"
    return (f"WITH raw AS ({_raw_sql()}), staged AS (SELECT *, {age_ok} AS age_int, "
            f"CASE {nulls} WHEN ({age_ok}) IS NULL THEN 'age' END AS reason FROM raw)")


def _normalized_sql(extra: str = "") -> str:
    cols = ", ".join("age_int AS age" if f == "age" else f for f in _FIELDS)
    return (_norm_with() + f" SELECT {cols}, ingest_ts AS \"timestamp\"{extra} FROM staged WHERE reason IS NULL")


def _unseen_topk_sql(select: str) -> str:
    return _with_split() + " " + select


_ORDERS_EV = ("SELECT CAST(o_custkey AS VARCHAR) AS passengerId, CAST(l_suppkey AS VARCHAR) AS arrivalAirport, "
              f"{_ORDER_STATUS} AS flightStatus, o_orderdate AS \"timestamp\" "
              "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def _eval_report_sql(inter_sql: str | None = None) -> str:
    metrics_join = ("FROM test t LEFT JOIN topk k ON t.user_index = k.user_index AND t.true_item = k.item_index "
                    "LEFT JOIN (SELECT item_index AS pop_item, rank AS pop_rank FROM poptop) p "
                    "ON t.true_item = p.pop_item")
    return (_with_split(inter_sql) + ", rep AS (SELECT COUNT(*) AS users_evaluated, "
            + _metric_sql("k.rank", "model") + ", " + _metric_sql("p.pop_rank", "baseline")
            + " " + metrics_join + ") "
            "SELECT *, model_hit_rate > baseline_hit_rate AS model_beats_baseline FROM rep "
            "WHERE users_evaluated > 0 AND (SELECT COUNT(*) FROM indexed) >= 10")


def _recommendation_counts_sql(inter: str) -> str:
    n = f"LEAST({K}, items.n)"
    return (f"WITH inter AS ({inter}), items AS (SELECT COUNT(DISTINCT arrivalAirport) AS n FROM inter) "
            f"SELECT DISTINCT passengerId AS passenger_id, {n} AS n_recs, {n} AS n_airports, {n} AS n_known "
            f"FROM inter, items")


def oracle_sql() -> dict[str, str]:
    ev = _ev_sql()
    sql = {
        "status_weight": (f"SELECT event_id, flightStatus, CAST({_WEIGHT} AS DOUBLE) AS weight FROM ({ev}) e"),
        "lookback_filter": (f"SELECT event_id, passengerId, arrivalAirport, flightStatus, \"timestamp\" "
                            f"FROM ({ev}) e WHERE \"timestamp\" > {_cutoff(AS_OF, LOOKBACK)}"),
        "interaction_strength": _inter_sql(),
        "interaction_strength_orders": _inter_sql(ORDERS_AS_OF, ORDERS_LOOKBACK, _ORDERS_EV),
        "user_index": f"WITH inter AS ({_inter_sql()}) {_index_sql('passengerId', 'user_index')}",
        "item_index": f"WITH inter AS ({_inter_sql()}) {_index_sql('arrivalAirport', 'item_index')}",
        "indexed_interactions": _with_indexed() + " SELECT * FROM indexed",
        "distinct_user_map": _with_indexed() + " SELECT DISTINCT user_index, passengerId FROM indexed",
        "enriched_left_lookup": (
            _with_indexed() + ", "
            f"top AS (SELECT user_index, item_index, CAST(rating AS DOUBLE) AS score FROM (SELECT *, "
            f"row_number() OVER (PARTITION BY user_index ORDER BY rating DESC, item_index ASC) AS rk "
            f"FROM indexed) z WHERE rk <= {K}) "
            f"SELECT um.passengerId AS passenger_id, im.arrivalAirport AS arrival_airport_code, "
            f"l.city AS arrival_city, l.country AS arrival_country, t.score AS score, "
            f"((TIMESTAMP '{RUN_AT}' AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tehran') AS generated_at "
            f"FROM top t JOIN (SELECT DISTINCT user_index, passengerId FROM indexed) um "
            f"ON t.user_index = um.user_index "
            f"JOIN (SELECT DISTINCT item_index, arrivalAirport FROM indexed) im ON t.item_index = im.item_index "
            f"LEFT JOIN ({_lookup_sql()}) l ON im.arrivalAirport = l.iata_code"),
        "holdout_test": _with_split() + " SELECT user_index, true_item FROM test",
        "holdout_train": _with_split() + " SELECT * FROM train",
        "eligible_test_users": _with_split() + " SELECT user_index FROM test",
        "unseen_candidates": _with_split() + " SELECT user_index, item_index, score FROM unseen",
        "topk_per_user": _with_split() + " SELECT user_index, item_index, rank FROM topk",
        "exploded_recs": (_with_split() + " SELECT user_index, CAST(rank - 1 AS INTEGER) AS pos, item_index "
                          "FROM topk"),
        "popular_topk": _with_split() + " SELECT item_index, pop, rank FROM poptop",
        "popularity_metrics": (_with_split() + " SELECT COUNT(*) AS users_evaluated, "
                               + _metric_sql("p.rank", "baseline")
                               + " FROM test t LEFT JOIN poptop p ON t.true_item = p.item_index"),
        "fair_popularity_metrics": (
            _with_split() + ", allpop AS (SELECT item_index, row_number() OVER (ORDER BY pop DESC, item_index ASC) "
            "AS r FROM pop), fairlist AS (SELECT user_index, item_index, row_number() OVER (PARTITION BY "
            "user_index ORDER BY r) AS fr FROM (SELECT t.user_index, a.item_index, a.r FROM test t CROSS JOIN "
            "allpop a WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_index = t.user_index "
            "AND s.item_index = a.item_index)) x) "
            "SELECT COUNT(*) AS users_evaluated, " + _metric_sql("f.fr", "fair_baseline")
            + f" FROM test t LEFT JOIN (SELECT * FROM fairlist WHERE fr <= {K}) f "
            "ON t.user_index = f.user_index AND t.true_item = f.item_index"),
        "model_metrics": (_with_split() + " SELECT COUNT(*) AS users_evaluated, " + _metric_sql("k.rank", "model")
                          + " FROM test t LEFT JOIN topk k ON t.user_index = k.user_index "
                            "AND t.true_item = k.item_index"),
        "eval_report": _eval_report_sql(),
        "eval_report_orders": _eval_report_sql(_inter_sql(ORDERS_AS_OF, ORDERS_LOOKBACK, _ORDERS_EV)),
        "indexed_interactions_orders": (_with_indexed(_inter_sql(ORDERS_AS_OF, ORDERS_LOOKBACK, _ORDERS_EV))
                                        + " SELECT * FROM indexed"),
        "stand_in_recommendations": _stand_in_sql(AS_OF, LOOKBACK, RUN_AT),
        "latest_recommendations": (
            f"WITH {_history_sql()}, newest AS (SELECT passenger_id, MAX(generated_at) AS generated_at "
            f"FROM hist GROUP BY passenger_id) "
            + _response_sql("SELECT h.* FROM hist h JOIN newest n ON h.passenger_id = n.passenger_id "
                            "AND h.generated_at = n.generated_at")),
        "latest_for_passenger_list": (
            f"WITH {_history_sql()}, sel AS (SELECT * FROM hist WHERE passenger_id IN (SELECT "
            f"CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'HOUSEHOLD')), "
            f"newest AS (SELECT passenger_id, MAX(generated_at) AS generated_at FROM sel GROUP BY passenger_id) "
            + _response_sql("SELECT h.* FROM sel h JOIN newest n ON h.passenger_id = n.passenger_id "
                            "AND h.generated_at = n.generated_at")),
        "recommendations_on_day": (
            f"WITH {_history_sql()} "
            + _response_sql(f"SELECT * FROM hist WHERE generated_at >= CAST(DATE '{SERVE_DAY}' AS TIMESTAMP) "
                            f"AND generated_at < CAST(DATE '{SERVE_DAY}' AS TIMESTAMP) + INTERVAL 1 DAY")),
        "parse_event_time": (
            "WITH t AS (SELECT event_id, CASE event_type "
            "WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' "
            "WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') "
            "WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:30' "
            "WHEN 'view' THEN strftime(ts, '%Y-%m-%d') ELSE 'yesterday' END AS ts_text FROM events) "
            "SELECT event_id, ts_text, CASE "
            "WHEN regexp_full_match(upper(ts_text), '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,9})?)?"
            "(Z|[+-]\\d{2}:\\d{2}(:\\d{2})?)') "
            "THEN (TRY_CAST(upper(ts_text) AS TIMESTAMPTZ) AT TIME ZONE 'UTC') "
            "WHEN regexp_full_match(upper(ts_text), '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}(:\\d{2}(\\.\\d{1,9})?)?') "
            "THEN TRY_CAST(upper(ts_text) AS TIMESTAMP) END AS parsed FROM t"),
        "millis_roundtrip": (
            "SELECT event_id, epoch_us(ts) // 1000 AS millis, make_timestamp((epoch_us(ts) // 1000) * 1000) "
            "AS ts_utc, CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS DATE) AS event_day, "
            "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch_day FROM events"),
        "normalized_events": _normalized_sql(),
        "lookup_csv": _lookup_sql(),
        "raw_csv_normalized": (_norm_with() + " SELECT "
                               + ", ".join("age_int AS age" if f == "age" else f for f in _FIELDS)
                               + " FROM staged WHERE reason IS NULL"),
        "rejected_events": (_norm_with() + " SELECT "
                            + ", ".join(f"{f} AS \"{h}\"" for f, h in zip(_FIELDS, _HEADERS))
                            + ", reason FROM staged WHERE reason IS NOT NULL"),
        "events_by_day": "SELECT CAST(ts AS DATE) AS event_day, COUNT(*) AS n_events FROM events GROUP BY 1",
        "stream_ingest_readback": _normalized_sql(", CAST(ingest_ts AS DATE) AS event_day"),
        "batch_append_readback": _normalized_sql(", CAST(ingest_ts AS DATE) AS event_day"),
        "lake_interactions": _inter_sql(ev=_normalized_sql()),
        "als_recommendation_counts": _recommendation_counts_sql(_inter_sql()),
        "als_recommendation_counts_orders": _recommendation_counts_sql(
            _inter_sql(ORDERS_AS_OF, ORDERS_LOOKBACK, _ORDERS_EV)),
        "als_unseen_overlap": (
            f"WITH inter AS ({_inter_sql()}), own AS (SELECT passengerId, COUNT(*) AS n FROM inter GROUP BY 1), "
            f"items AS (SELECT COUNT(DISTINCT arrivalAirport) AS n FROM inter) "
            f"SELECT passengerId AS passenger_id, LEAST({K}, items.n - own.n) AS n_recs, "
            f"CAST(0 AS BIGINT) AS n_seen FROM own, items WHERE items.n > own.n"),
        "stream_quarantine_readback": (
            _norm_with() + ", k AS (SELECT passengerId, date_diff('day', DATE '1970-01-01', "
            "CAST(departureDate AS DATE)) % 8 AS kind FROM staged WHERE reason IS NULL) "
            "SELECT CASE WHEN kind IN (1, 2, 3, 5, 6) THEN 'decode' WHEN kind IN (0, 4) THEN 'timestamp' ELSE 'event' END "
            "AS outcome, passengerId, COUNT(*) AS n FROM k GROUP BY 1, 2"),
        "table_scan_by_name": (
            _norm_with() + " SELECT CAST(ingest_ts AS DATE) AS event_day, 3 * COUNT(*) AS by_name, "
            "3 * COUNT(*) AS by_path FROM staged WHERE reason IS NULL GROUP BY 1"),
        "compacted_events_by_day": (
            _norm_with() + " SELECT CAST(ingest_ts AS DATE) AS event_day, 4 * COUNT(*) AS by_name, 4 * COUNT(*) AS by_path, "
            f"CASE WHEN CAST(ingest_ts AS DATE) < DATE '{PACKED_BEFORE}' THEN 2 ELSE 4 END AS n_batches "
            "FROM staged WHERE reason IS NULL GROUP BY 1, 4"),
        "interaction_strength_rollup": _inter_sql(),
        "publish_readback": f"WITH {_history_sql()} SELECT * FROM hist",
    }
    sql["raw_csv_line_breaks"] = sql["raw_csv_normalized"].replace(
        "'' AS pilotName", "'over' || chr(10) || 'two lines, \"' || CAST(user_id AS VARCHAR) || '\"' || chr(10) AS pilotName")
    sql["als_partial_fit"] = (f"SELECT COUNT(DISTINCT passengerId) AS n_users, COUNT(DISTINCT arrivalAirport) AS n_items, "
                              f"TRUE AS falls, TRUE AS near_mllib FROM ({_inter_sql()}) i")
    sql["served_day"] = sql["recommendations_on_day"]
    sql["served_passenger_list"] = sql["latest_for_passenger_list"]
    sql["als_unseen_overlap_blocks"] = sql["als_unseen_overlap"]
    if llm_queries is not None:
        sql |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
