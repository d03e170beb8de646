"""A row for every member and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def month_bounds(months: DataFrame, pidx: str = "pidx") -> tuple[Column, Column]:
    """First and last month as scalars."""
    low = months.select(F.min(pidx)).scalar()
    high = months.select(F.max(pidx)).scalar()
    return low, high


def dense_months(
    monthly: DataFrame, dims: list[str], values: list[str], pidx: str = "pidx", calendar: DataFrame | None = None
) -> DataFrame:
    """Fill the missing months of every member with 0.

    The months run over the ``calendar``, or without one over those of the
    frame, which is then read twice. Rows without a month are in no month.

    One aggregate collects a member's months (never more than the calendar has)
    and lays them out over the month sequence: a single shuffle, no join of a
    members × months grid.
    """
    monthly = monthly.filter(F.col(pidx).isNotNull())
    low, high = month_bounds(monthly if calendar is None else calendar, pidx)
    per_member = monthly.groupBy(*dims).agg(
        F.map_from_entries(F.collect_list(F.struct(pidx, F.struct(*values)))).alias("_by_month")
    )
    spread = per_member.select(*dims, "_by_month", F.explode(F.sequence(low, high)).alias(pidx))
    filled = {v: F.coalesce(F.col("_by_month")[F.col(pidx)][v], F.lit(0)).alias(v) for v in values}
    return spread.select(*dims, pidx, *filled.values())
