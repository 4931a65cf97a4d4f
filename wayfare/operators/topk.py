"""Top-k operators (T1, T2, W2, W3) with deterministic tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """T2/W2 + F5: ``row_number() <= k`` per group.

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle and a final
    one after it, so every map task forwards at most k rows per group: a hot group
    cannot pile up in one task."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def global_top_k(df: DataFrame, order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """T1 + W3: the k first rows of a global order, numbered 1..k.

    ``orderBy().limit(k)`` runs as a per-task top-k plus one merge of at most
    k x tasks rows. The row number is then taken over those k rows only."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
