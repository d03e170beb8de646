"""Lookups that never drop or multiply a fact row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import NOT_ASSIGNED_CODE, code_or_default, col, norm

#: A table of more rows is not broadcast to be looked up in.
BROADCAST_ROWS = 100_000


def without_large_broadcast(table: DataFrame) -> DataFrame:
    """A kept table to look up in; one of many rows is exchanged with the rows that look up, never broadcast.

    Spark tells by the bytes of the files and the share of the columns that are read. Columns of few values take next to
    nothing in a file, so that millions of members may count as a few megabytes; a broadcast holds every one of them as a row,
    at the driver and at each executor. So rows are counted, by the footers of the files.
    """
    return table.hint("merge") if table.count() > BROADCAST_ROWS else table


def map_slice(mapping: DataFrame, sources: list[str] | str, label: str, code: str) -> DataFrame:
    """Code per normalised label of the given sources, one row per label.

    A mapping lists each label of a source once; should it not, the greatest
    code is used, so that the lookup cannot multiply fact rows.
    """
    wanted = [sources] if isinstance(sources, str) else list(sources)
    return (
        mapping.filter(F.col("SRC_DSC").isin(wanted))
        .select(norm("SRC_DSC").alias("_src"), norm(label).alias("_label"), F.col(code).alias("_code"))
        .filter("_label is not null")
        .groupBy("_src", "_label")
        .agg(F.max("_code").alias("_code"))
    )


def map_code(
    df: DataFrame,
    mapping: DataFrame,
    source: str,
    key: Column | str,
    label: str,
    code: str,
    out: str | None = None,
    default: int | None = NOT_ASSIGNED_CODE,
) -> DataFrame:
    """Left lookup ``key → code`` in one source's slice, with a fallback code."""
    codes = map_slice(mapping, source, label, code).drop("_src")
    joined = df.withColumn("_key", norm(col(key))).join(codes, F.col("_key") == F.col("_label"), "left")
    return joined.withColumn(out or code, code_or_default("_code", default)).drop("_key", "_label", "_code")


def constant_code(
    mapping: DataFrame, source: str, label_value: str, label: str, code: str, default: int | None = NOT_ASSIGNED_CODE
) -> Column:
    """Code of one fixed label as a scalar.

    Panels that map every row to the same label need no join at all: joining
    would put every fact row under a single key.
    """
    hit = mapping.filter((F.col("SRC_DSC") == source) & (norm(label) == label_value.strip().upper()))
    return code_or_default(hit.select(F.max(code)).scalar(), default)


def map_code_pair(
    df: DataFrame,
    mapping: DataFrame,
    sources: list[str],
    feed: str,
    key: Column | str,
    label: str,
    code: str,
    out: str | None = None,
    default: int | None = None,
) -> DataFrame:
    """Lookup on (feed, key) where several feeds share one mapping; no fallback unless asked."""
    codes = map_slice(mapping, sources, label, code)
    joined = df.withColumns({"_feed": norm(feed), "_key": norm(col(key).cast("string"))}).join(
        codes, (F.col("_feed") == F.col("_src")) & (F.col("_key") == F.col("_label")), "left"
    )
    return joined.withColumn(out or code, code_or_default("_code", default)).drop(
        "_feed", "_key", "_src", "_label", "_code"
    )
