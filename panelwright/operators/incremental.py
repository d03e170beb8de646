"""Incremental load: newer-than-watermark slice, period reload, append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Fixed value: the watermark of an empty target.
EPOCH = dt.datetime(1900, 1, 1)


def _stamp(value: dt.datetime, kind: DataType) -> Column:
    """A stamp literal of the column's own type: a cast on the column would keep the filter from the scan."""
    if isinstance(kind, TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value)


def high_watermark(target: DataFrame | None, stamp: str = "LOA_DAT") -> Column:
    """Greatest load stamp of the target as a scalar; the epoch when there is none."""
    if target is None:
        return F.lit(EPOCH)
    return F.coalesce(target.select(F.max(stamp)).scalar(), _stamp(EPOCH, target.schema[stamp].dataType))


def watermark_value(target: DataFrame | None, stamp: str = "LOA_DAT") -> dt.datetime:
    """The watermark read now. A load uses one value for all its steps."""
    if target is None:
        return EPOCH
    return target.agg(F.max(stamp)).first()[0] or EPOCH


def newer_than(staging: DataFrame, watermark: Column | dt.datetime, stamp: str = "LOA_DAT") -> DataFrame:
    """Rows loaded after the watermark (strictly). A literal reaches the Parquet scan."""
    if not isinstance(watermark, Column):
        watermark = _stamp(watermark, staging.schema[stamp].dataType)
    return staging.filter(F.col(stamp) > watermark)


def up_to(staging: DataFrame, stamp_value: dt.datetime, stamp: str = "LOA_DAT") -> DataFrame:
    """Rows loaded up to a stamp, so that files which arrive during a load wait for the next one."""
    return staging.filter(F.col(stamp) <= _stamp(stamp_value, staging.schema[stamp].dataType))


def incremental_slice(staging: DataFrame, target: DataFrame | None, stamp: str = "LOA_DAT") -> DataFrame:
    return newer_than(staging, high_watermark(target, stamp), stamp)


def reload_periods(
    target: DataFrame, batch: DataFrame, period: str = "PER_DSC", periods: DataFrame | None = None
) -> DataFrame:
    """The target without the reloaded periods, plus the batch.

    ``periods`` may name more periods than the batch holds (a delivery whose
    rows of a period were all filtered out still replaces that period). Rows
    without a period are never replaced.

    The period list is distinct, hence bounded by the months in the data.
    """
    replaced = (batch if periods is None else periods).select(period).distinct()
    kept = target.join(replaced, period, "left_anti").select(target.columns)
    return kept.unionByName(batch)


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append-only load, aligned by name."""
    return target.unionByName(batch.select(*target.columns))
