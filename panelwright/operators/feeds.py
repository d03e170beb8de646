"""Unions and reshaping of feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_feeds(feeds: dict[str, DataFrame], tag: str = "SRC_DSC") -> DataFrame:
    """UNION ALL of feeds, each row tagged with its feed."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def union_aligned(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def feed_periods(feeds: list[DataFrame], period: str = "PER_DSC") -> DataFrame:
    """Distinct periods over several feeds (each feed is reduced before the union)."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(period).distinct() for f in feeds]).distinct()


def add_member(df: DataFrame, constants: dict[str, Column], audit: list[str], source: DataFrame | None = None) -> DataFrame:
    """Append one row of constants that carries the greatest audit values of ``source`` (default ``df``)."""
    greatest = (df if source is None else source).agg(*[F.max(c).alias(c) for c in audit])
    cells = [
        (constants[f.name] if f.name in constants else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ]
    return df.unionByName(greatest.select(*cells))


def wide_to_tall(df: DataFrame, ids: list[str], measures: dict[str, Column], flag: str, value: str) -> DataFrame:
    """One row per (row, measure) in a single pass; NULL measures give no row."""
    entries = F.array(*[F.struct(F.lit(n).alias(flag), c.alias(value)) for n, c in measures.items()])
    return df.select(*ids, F.inline(F.filter(entries, lambda e: e[value].isNotNull())))


def long_form(df: DataFrame, ids: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Columns to labelled rows, NULLs kept."""
    renamed = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return renamed.unpivot(ids, list(columns.values()), name, value)
