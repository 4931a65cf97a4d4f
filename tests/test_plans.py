"""Plan tests: the shapes that keep these queries cheap at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from wayfare.operators.topk import top_k_per_group
from wayfare.plans.inspect import physical_plan

from conftest import SF_SMALL

NO_PLAN_CHECK = {"stream_ingest_readback", "batch_append_readback", "lake_interactions", "publish_readback",
                 "lookup_csv", "raw_csv_normalized",
                 "als_recommendations", "als_recommendations_unseen", "als_recommendations_full",
                 "als_recommendations_orders", "als_eval", "als_recommendation_counts",
                 "als_recommendation_counts_orders", "als_unseen_overlap", "stream_quarantine_readback",
                 "table_scan_by_name"}


def test_top_k_uses_window_group_limit(spark):
    df = spark.createDataFrame([(u, i, float(i)) for u in range(5) for i in range(20)], "u int, i int, s double")
    plan = physical_plan(top_k_per_group(df, ["u"], [F.col("s").desc(), F.col("i")], 3))
    assert "WindowGroupLimit" in plan


def test_scan_prunes_columns_and_pushes_cutoff(spark):
    plan = physical_plan(ent.queries()["interaction_strength"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-17T00:00)]" in plan
    assert "partial_sum" in plan


def test_latest_reads_the_history_once(spark):
    from wayfare.operators.serving import latest_recommendations
    history = ent._history(spark, SF_SMALL)
    plan, once = physical_plan(latest_recommendations(history)), physical_plan(history)
    assert plan.count("FileScan") == once.count("FileScan") and "WindowGroupLimit" in plan


def test_unseen_candidates_read_the_persisted_index(spark):
    plan = physical_plan(ent.queries()["unseen_candidates"](spark, SF_SMALL))
    assert "InMemoryTableScan" in plan and "FileScan parquet" not in plan.split("InMemoryRelation")[0]


@pytest.mark.parametrize("name", sorted(set(ent._QUERIES) - NO_PLAN_CHECK))
def test_no_python_rows_no_cartesian(spark, name):
    plan = physical_plan(ent.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
