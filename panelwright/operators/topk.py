"""Rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ranked(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Greatest first; members break ties so the order is total."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def top(df: DataFrame, k: int, measure: str, *ties: str) -> DataFrame:
    """The k greatest: each task keeps k rows, only those are merged."""
    return ranked(df, measure, *ties).limit(k)


def only_members(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Rows of the given members; sizes decide how they meet. After a top-k, which is a limit, the plan knows that they are few."""
    return df.join(members.select(key), key, "left_semi")


def first_members(df: DataFrame, key: str, k: int) -> DataFrame:
    """First k members in alphabetical order."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key).limit(k)
