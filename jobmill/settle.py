"""Evaluate derived columns once, however many filters use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results later filters do not compute again.

    The optimizer pushes a filter below a projection by copying the expressions it needs,
    so a rule pack behind a filter runs twice, and one behind three filters many times.
    It does not push a filter below a generator. A generator that yields exactly one row
    keeps the values where they were computed, without a shuffle.
    """
    out = df.withColumns(columns)
    names = list(columns)
    others = [c for c in out.columns if c not in columns]
    return out.select(*others, F.inline(F.array(F.struct(*names))))
