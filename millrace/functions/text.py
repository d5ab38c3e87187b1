"""Tokenisation and top-k helpers shared by retrieval, routing and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed tokenisation rule: lower-case, split on anything that is not a letter or digit.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Whole-text word tokens (array<string>, empty strings removed; native, code-generated)."""
    return F.array_remove(F.split(F.lower(text), TOKEN_SPLIT), "")


def top_k(df: DataFrame, group_cols: list, order_cols: list, k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``1..k`` per group by a total order.

    ``row_number() <= k`` directly above the window is planned by Spark as a
    partial ``WindowGroupLimit`` before the shuffle plus a final one after it,
    so a group holding a third of all rows is cut to k rows per map task
    before it is shuffled.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
