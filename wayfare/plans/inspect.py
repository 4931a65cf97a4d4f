"""Plan inspection used by tests and the benchmark to keep plans honest."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The formatted physical plan as text (no job is run)."""
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def plan_contains(df: DataFrame, *needles: str) -> dict[str, bool]:
    text = physical_plan(df)
    return {n: n in text for n in needles}
